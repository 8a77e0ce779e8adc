"""The operators as queries over the given tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bitslices, decontaminate, jaccard, language, lm, packing, pii, secrets, shards, suffixes, toxicity, trie
from .tables import read


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read(spark, sf_dir, "documents"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(read(spark, sf_dir, "documents"))


def op4_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return bitslices.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(read(spark, sf_dir, "documents"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "n_seeds")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(read(spark, sf_dir, "documents"), with_text=True, passage=51)
    # A removed run may end within a character; what is left of that becomes U+FFFD.
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), "n_shared_words")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(read(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(read(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_lm_score, op3_secrets, op4_bit_sliced_top_k, op5_language, op6_jaccard,
                                   op7_decontaminate, op8_suffix_dedup, op9_packing, op10_sharding, op11_alignment, op12_prefix_trie, op13_toxicity)}

ORACLES = {
    "op4_bit_sliced_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, rank, vec_id, coalesce(score, 0) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 20
""",
    "op6_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) * 10 >= 8 * (a.n + b.n - count(*))),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u),
c AS (SELECT u, min(v) AS class_id FROM reach GROUP BY u),
l AS (SELECT u, count(*) AS n FROM pairs GROUP BY u)
SELECT d.doc_id, c.class_id, coalesce(l.n, 0)::BIGINT AS n_links
FROM documents d JOIN c ON c.u = d.doc_id LEFT JOIN l ON l.u = d.doc_id
""",
}
