"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import fold
from .text import mix, runs, slices

_UNSEEN = 0xFFFFFFFF
#: Bytes of texts whose n-grams are counted at once; a byte takes about a hundred while they are.
SLICE = 1 << 17
#: Rows of a batch that are filtered and returned at once.
ROWS = 1024
_folded = np.zeros(0, np.uint32)


def _letters(points: np.ndarray) -> np.ndarray:
    """Small letters as code points, 0 for anything else."""
    global _folded
    if not len(_folded):
        _folded = np.full(0x110000, _UNSEEN, np.uint32)
    out = _folded[points]
    new = np.unique(points[out == _UNSEEN])
    if len(new):
        for p in new:
            c = chr(p)
            _folded[p] = ord(c.lower()[0]) if c.isalpha() else 0
        out = _folded[points]
    return out


def gram_counts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, gram, count) of the 1- to 3-grams of letters, sorted by document
    and gram. What lies between two words counts as one blank; no gram is all blank
    or has a blank in its middle."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    at = leads[offs]
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.uint64), np.diff(at))
    if len(doc) != len(points):  # not UTF-8: one text after another
        parts = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                 for a, b in zip(offs[:-1], offs[1:], strict=True)]
        points = np.concatenate(parts)
        doc = np.repeat(np.arange(len(parts), dtype=np.uint64), [len(p) for p in parts])
    c = _letters(points)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0) | (doc[1:] != doc[:-1])
    c, doc = c[keep].astype(np.uint64), doc[keep]
    keys = []
    for n in (1, 2, 3):
        if len(c) < n:
            break
        m = len(c) - n + 1
        code = c[:m].copy()
        for k in range(1, n):
            code = (code << np.uint64(21)) | c[k:m + k]
        good = doc[:m] == doc[n - 1:]
        good &= (c[1:m + 1] != 0) if n == 3 else (code != 0)
        keys.append((doc[:m][good] << np.uint64(32)) | (mix(code[good] * np.uint64(4) + np.uint64(n)) >> np.uint64(32)))
    both = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    both.sort()
    first, count = runs(both)
    key = both[first]
    return (key >> np.uint64(32)).astype(np.int64), key & np.uint64(0xFFFFFFFF), count


def ranked(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, gram, rank from 0) of each document's `depth` most frequent grams; ties by gram."""
    if len(count) and count.max() > 0xFFFF:  # a very long text
        order = np.lexsort((gram, -count, doc))
        doc, gram = doc[order], gram[order]
    else:
        key = (doc.astype(np.uint64) << np.uint64(48)) | ((np.uint64(0xFFFF) - count.astype(np.uint64)) << np.uint64(32)) | gram
        key.sort()
        doc, gram = (key >> np.uint64(48)).astype(np.int64), key & np.uint64(0xFFFFFFFF)
    first, length = runs(doc)
    rank = np.arange(len(doc)) - np.repeat(first, length)
    keep = rank < depth
    return doc[keep], gram[keep], rank[keep]


def learn_profiles(labelled: DataFrame, depth: int = 400) -> pd.DataFrame:
    """(lang, gram, rank): the most frequent n-grams of all texts of each non-null
    label. Counts are summed in each task and again by key; `depth` rows of each
    language reach the driver, whatever the corpus."""
    def count(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = pd.Series(batch.column(1).to_pylist(), dtype=object)
            for i, j, data, offs in slices(batch.column(0), SLICE):
                doc, gram, n = gram_counts(data, offs)
                code, names = pd.factorize(langs[i:j])
                key = (code[doc].astype(np.uint64) << np.uint64(32)) | gram
                both, at = np.unique(key, return_inverse=True)
                sums = np.bincount(at, n, len(both))
                for k, name in enumerate(names):
                    mine = (both >> np.uint64(32)) == k
                    old = held.get(name, (np.zeros(0, np.uint64), np.zeros(0)))
                    merged, where = np.unique(np.concatenate((old[0], both[mine] & np.uint64(0xFFFFFFFF))), return_inverse=True)
                    held[name] = merged, np.bincount(where, np.concatenate((old[1], sums[mine])), len(merged))
        for name, (grams, sums) in held.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(grams), pa.string()), "gram": grams.astype(np.int64), "n": sums.astype(np.int64)})

    counts = (labelled.where("lang is not null").select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counts.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < depth)
            .select("lang", "gram", "rank").toPandas())


def _predictor(spark: SparkSession, profiles: pd.DataFrame, depth: int):
    """A function of a column of texts that runs in tasks: the label of each, `und` with
    score 0 where it has none, and its score."""
    langs = sorted(profiles["lang"].unique())
    grams = np.unique(profiles["gram"].to_numpy().astype(np.uint64))
    places = np.full((len(langs), len(grams) + 1), -1, np.int32)
    for k, lang in enumerate(langs):
        own = profiles[profiles["lang"] == lang]
        places[k, np.searchsorted(grams, own["gram"].to_numpy().astype(np.uint64))] = own["rank"]
    known = spark.sparkContext.broadcast((langs, grams, places))

    def predict(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        langs, grams, places = known.value
        pred, scores = np.full(len(texts), len(langs)), np.zeros(len(texts))
        for i, j, data, offs in slices(texts, SLICE):
            if not len(langs):
                break
            doc, gram, rank = ranked(*gram_counts(data, offs), depth)
            at = np.searchsorted(grams, gram)
            at[grams[np.minimum(at, len(grams) - 1)] != gram] = len(grams)
            far = np.stack([np.bincount(doc, np.where(places[k][at] < 0, depth, np.abs(places[k][at] - rank)), j - i)
                            for k in range(len(langs))])
            n = np.bincount(doc, minlength=j - i)
            best = far.argmin(axis=0)
            some = n > 0
            pred[i:j][some] = best[some]
            scores[i:j][some] = 1 - far.min(axis=0)[some] / (n[some] * depth)
        return np.array([*langs, "und"], object)[pred], scores

    return predict


def identify(docs: DataFrame, profiles: pd.DataFrame, depth: int = 400, key: str = "doc_id") -> DataFrame:
    """The key column, lang_pred, score: the label whose profile is least out of place with
    the text's own most frequent n-grams; 1 - distance / largest distance. Ties go
    to the first label in order. `und` with score 0: null text, no letter, or no
    profile. Only the key and text are read; the text alone decides."""
    predict = _predictor(docs.sparkSession, profiles, depth)

    def run(batches):
        for batch in batches:
            pred, scores = predict(batch.column(1))
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "lang_pred": pa.array(pred, pa.string()), "score": scores})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, lang_pred string, score double")


def identify_documents(docs: DataFrame, depth: int = 400) -> DataFrame:
    """Predicts every document; profiles come from the documents whose crc32(doc_id)
    modulo 5 is not 0, the rest is held out.

    Null, empty or letterless text: `und`, 0. Null lang: not learned from. Null
    doc_id: folds as empty text. Repeated rows: a result each. Empty table: no
    rows. Other columns are not read.
    """
    profiles = learn_profiles(docs.where(fold("doc_id", 5) != 0), depth)
    return (identify(docs, profiles, depth)
            .select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"))


def keep_identified(docs: DataFrame, least: float = 0.2, depth: int = 400) -> DataFrame:
    """The documents, all columns, whose text has a language: prediction is not
    `und` and the score reaches `least`. Keeps repeated rows. Rows pass through a
    task once, and leave it some at a time."""
    profiles = learn_profiles(docs.where(fold("doc_id", 5) != 0), depth)
    predict = _predictor(docs.sparkSession, profiles, depth)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                part = batch.slice(i, ROWS)
                pred, scores = predict(part.column(at))
                yield part.filter(pa.array((pred != "und") & (scores >= least)))

    return docs.mapInArrow(run, docs.schema)
