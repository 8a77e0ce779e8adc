"""The pipeline's stages on a small corpus, and its packed result against plain counts."""

from __future__ import annotations

import random

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from .conftest import prose


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    texts = [prose(rng, 80) for _ in range(40)]
    item = prose(rng, 40)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, texts[0]), (101, texts[1] + " tail"), (102, "12345 !!"), (103, None), (104, texts[2] + " " + item), (105, prose(rng, 30) + " mail x@y.org")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns or n == len(corpus_pipeline.STAGES) - 1, name
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    every = {i for i, _ in rows}
    assert seen[0] == every - {102, 103}
    assert seen[1] == seen[0] - {100, 101}
    assert seen[2] == seen[1] - {104} == seen[3] == seen[4]
    got = corpus_pipeline.run(spark, str(tmp_path))
    words = {i: len(t.split()) + 1 for i, t in rows if i in seen[4]}
    assert {r.doc_id: r.length for r in got.collect()} == words


def test_a_worker_gets_long_rows_some_at_a_time(spark, tmp_path, monkeypatch):
    """12 MB of long texts in one partition: no batch that a stage hands to a Python worker holds much
    over 2 MB, and no row is lost. A whole run leaves the session's limits as they were."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([len(batch)], pa.int64()), "size": pa.array([batch.nbytes], pa.int64())})

    own = {"language": "keep_identified", "jaccard": "keep_one", "decontaminate": "drop_contaminated", "pii": "redact", "packing": "pack_documents"}
    for module, name in own.items():
        monkeypatch.setattr(getattr(corpus_pipeline, module), name, lambda docs, *_: docs.mapInArrow(sizes, "rows long, size long"))
    spark.createDataFrame([(0, "item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(600, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4000).alias("text"))
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(limit, "64m")
            got = stage(spark, docs, str(tmp_path)).collect()
            assert sum(r.rows for r in got) == 600 and max(r.size for r in got) < 5 << 19, name
        spark.conf.set(limit, "64m")
        monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:1])
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        corpus_pipeline.run(spark, str(tmp_path))
        assert spark.conf.get(limit) in ("64m", "67108864b", "67108864")
    finally:
        spark.conf.set(limit, before)
