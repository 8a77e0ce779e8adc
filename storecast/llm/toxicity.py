"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import fold, staged
from .text import code_points, slices

SIZES = (3, 4, 5, 6)
_UNSEEN = 0xFFFFFFFF
_folded = np.zeros(0, np.uint32)
#: A longer text is read in pieces of this many code points that overlap.
PIECE, OVERLAP = 1 << 20, 1 << 12


def _characters(points: np.ndarray) -> np.ndarray:
    """Letters (small) and digits as code points, 0 for anything else."""
    global _folded
    if not len(_folded):
        _folded = np.full(0x110000, _UNSEEN, np.uint32)
    out = _folded[points]
    new = np.unique(points[out == _UNSEEN])
    if len(new):
        for p in new:
            c = chr(p)
            _folded[p] = ord(c.lower()[0]) if c.isalnum() else 0
        out = _folded[points]
    return out


def subwords(points: np.ndarray, offs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) in text order: the character n-grams of 3 to 6 within each
    word, whose two ends count as a character, hashed into 2**bits buckets."""
    n_docs = len(offs) - 1
    ends = np.insert(_characters(points).astype(np.uint64), offs, 0)  # a blank around each document
    doc = np.insert(np.repeat(np.arange(n_docs), np.diff(offs)), offs, np.arange(n_docs + 1))
    keep = np.ones(len(ends), bool)
    keep[1:] = (ends[1:] != 0) | (ends[:-1] != 0) | (doc[1:] != doc[:-1])
    c, doc = ends[keep], doc[keep]
    m = len(c) - SIZES[0] + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate((c, np.zeros(SIZES[-1], np.uint64)))
    grams, good = np.zeros((m, len(SIZES)), np.uint32), np.zeros((m, len(SIZES)), bool)
    name = padded[:m] * np.uint64(0x100000001B3) + padded[1:m + 1]
    inner = padded[1:m + 1] != 0
    for n in range(SIZES[0], SIZES[-1] + 1):
        name = name * np.uint64(0x100000001B3) + padded[n - 1:m + n - 1]
        if n > SIZES[0]:
            inner = inner & (padded[n - 2:m + n - 2] != 0)
        spread = (name ^ (name >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        grams[:, n - SIZES[0]] = (spread * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)
        good[:, n - SIZES[0]] = inner & (np.arange(m) + n <= len(c))
    return np.repeat(doc[1:m + 1], good.sum(axis=1)), grams[good].astype(np.int64)


def windows(doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first feature, end) of runs of `width` features of a document,
    half a width apart; a document of fewer features is one window, without any none."""
    first = np.searchsorted(doc, np.arange(n_docs))
    size = np.searchsorted(doc, np.arange(n_docs), "right") - first
    step = width // 2
    count = np.where(size > width, -(-(size - width) // step) + 1, size > 0)
    owner = np.repeat(np.arange(n_docs), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    last = (first + size)[owner]
    start = np.maximum(np.minimum(first[owner] + at * step, last - width), first[owner])
    return owner, start, np.minimum(start + width, last)


def means(weight: np.ndarray, bucket: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mean weight of the features of each window."""
    sums = np.concatenate(([0.0], np.cumsum(weight[bucket], dtype=np.float64)))
    return (sums[end] - sums[start]) / np.maximum(end - start, 1)


def fit(texts: list[str], toxic: np.ndarray, *, bits: int = 18, dim: int = 16, width: int = 48,
        epochs: int = 20, rate: float = 0.3, batch: int = 64, least: int = 3, seed: int = 7) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias): embeddings and softmax are trained together on each
    text's worst window, by Adagrad. A window's logit is its mean embedding times the
    difference of the two softmax rows, so the product of both is all that scoring needs.
    Buckets that fewer than `least` texts hold stay without weight."""
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim))
    rows, bias = rng.normal(0, 0.1, (2, dim)), np.zeros(2)
    seen, seen_rows, seen_bias = np.full(1 << bits, 1e-8), np.full((2, dim), 1e-8), np.full(2, 1e-8)
    parts, held = [], np.zeros(1 << bits, np.int64)
    for i in range(0, len(texts), 128):
        some = texts[i:i + 128]
        doc, grams = subwords(np.frombuffer("".join(some).encode("utf-32-le", "replace"), np.uint32),
                              np.concatenate(([0], np.cumsum([len(t) for t in some]))).astype(np.int64), bits)
        held += np.bincount(np.unique(doc * (1 << bits) + grams) % (1 << bits), minlength=1 << bits)
        parts.append((grams.astype(np.int32), *windows(doc, len(some), width)))
    bucket = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int32)])
    shift = np.cumsum([0, *[len(p[0]) for p in parts]])
    owner = np.concatenate([p[1] + 128 * k for k, p in enumerate(parts)] or [np.zeros(0, np.int64)])
    start = np.concatenate([p[2] + shift[k] for k, p in enumerate(parts)] or [np.zeros(0, np.int64)])
    end = np.concatenate([p[3] + shift[k] for k, p in enumerate(parts)] or [np.zeros(0, np.int64)])
    common = held >= least
    embed[~common] = 0
    some = np.unique(owner)
    if not len(some):
        rate_of_ones = float(np.mean(toxic)) if len(toxic) else 0.0
        return np.zeros(1 << bits, np.float32), float(np.log((rate_of_ones + 1e-3) / (1 - rate_of_ones + 1e-3)))
    first = np.searchsorted(owner, some)
    for epoch in range(epochs):
        lead = rows[1] - rows[0]
        weight = embed @ lead
        far = np.concatenate([means(weight, p[0], p[2], p[3]) for p in parts])
        if epoch:  # the first window of the largest logit
            top = np.maximum.reduceat(far, first)
            at = np.flatnonzero(far == np.repeat(top, np.diff(np.append(first, len(owner)))))
            pick = at[np.unique(owner[at], return_index=True)[1]]
        else:  # nothing is known yet: any window
            pick = rng.integers(first, np.append(first[1:], len(owner)))
        for part in np.array_split(rng.permutation(len(pick)), max(1, len(pick) // batch)):
            w = pick[part]
            size = end[w] - start[w]
            which = np.repeat(np.arange(len(w)), size)
            inside = bucket[np.repeat(start[w] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            used, at = np.unique(inside, return_inverse=True)
            lead = rows[1] - rows[0]
            logit = np.bincount(which, (embed[used] @ lead)[at], len(w)) / size + bias[1] - bias[0]
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic[owner[w]]
            share = np.bincount(at, (error / size)[which], len(used)) * common[used]
            grad = share @ embed[used]
            seen[used] += (share ** 2) * (lead @ lead)
            embed[used] -= rate * (share / np.sqrt(seen[used]))[:, None] * lead
            both = np.stack((-grad, grad))
            seen_rows += both ** 2
            rows -= rate * 0.1 * both / np.sqrt(seen_rows)
            tilt = np.array([-error.sum(), error.sum()])
            seen_bias += tilt ** 2
            bias -= rate * 0.1 * tilt / np.sqrt(seen_bias)
    return (embed @ (rows[1] - rows[0])).astype(np.float32), float(bias[1] - bias[0])


def sample_of(docs: DataFrame, labels: DataFrame, *, most: int = 2048, longest: int = 8192) -> DataFrame:
    """(text, toxic): at most `most` distinct texts of each label, of at most `longest`
    bytes, from rows whose crc32(doc_id) modulo 5 is not 0; the bound on what is learned
    from. Texts are chosen in the order of a fingerprint of theirs, so copies count
    once and the choice does not depend on how the tables are split. A text is toxic
    if any of its labels says so. Fingerprints are shuffled, texts only when chosen."""
    marks = (labels.where((fold("doc_id", 5) != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("__toxic")))
    rows = (docs.where((fold("doc_id", 5) != 0) & F.col("text").isNotNull() & (F.octet_length("text") <= longest))
            .select("doc_id", F.xxhash64("text").alias("__print"), "text"))
    known = rows.select("doc_id", "__print").join(marks, "doc_id").groupBy("__print").agg(F.max("__toxic").alias("toxic"))
    known = staged(known, "toxic-prints")
    parts = [known.where(F.col("toxic") == t).orderBy("__print").limit(most) for t in (0, 1)]
    chosen = F.broadcast(staged(parts[0].unionByName(parts[1]), "toxic-chosen"))  # 2 * `most` rows
    return rows.join(chosen, "__print").groupBy("__print").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("__print")


def learn(sample: DataFrame, **settings) -> tuple[np.ndarray, float]:
    """`fit` on a sample of bounded size, in one task; the weights reach the driver."""
    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        rows = pd.concat(got).sort_values("text", kind="stable") if got else pd.DataFrame({"text": [], "toxic": []})
        weight, bias = fit(rows["text"].tolist(), rows["toxic"].to_numpy(np.float64), **settings)
        yield pd.DataFrame({"weight": [weight.tobytes()], "bias": [bias]})

    row = sample.repartition(1).mapInPandas(train, "weight binary, bias double").first()
    if row is None:  # no row, no task
        return fit([], np.zeros(0), **settings)
    return np.frombuffer(row["weight"], np.float32), row["bias"]


def score(docs: DataFrame, weight: np.ndarray, bias: float, *, width: int = 48, key: str = "doc_id") -> DataFrame:
    """The key column and score: the softmax probability of the text's worst window. Only
    the key and text are read."""
    bits = len(weight).bit_length() - 1
    known = docs.sparkSession.sparkContext.broadcast((weight.tobytes(), bias))

    def worst(points, offs, weight):
        doc, bucket = subwords(points, offs, bits)
        owner, start, end = windows(doc, len(offs) - 1, width)
        out = np.full(len(offs) - 1, -np.inf)
        if len(owner):
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            out[owner[first]] = np.maximum.reduceat(means(weight, bucket, start, end), first)
        return out

    def predict(batches):
        weight = np.frombuffer(known.value[0], np.float32).astype(np.float64)
        for batch in batches:
            far = np.full(len(batch), -np.inf)
            for i, j, data, offs in slices(batch.column(1), 1 << 18):
                points, at = code_points(data, offs)
                if len(points) <= PIECE:
                    far[i:j] = worst(points, at, weight)
                else:  # one very long text
                    far[i] = max(worst(p, np.array([0, len(p)]), weight)[0] for p in
                                 (points[s:s + PIECE] for s in range(0, len(points), PIECE - OVERLAP)))
            far[np.isneginf(far)] = 0.0  # no word: nothing but the bias
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "score": 1 / (1 + np.exp(-np.clip(far + known.value[1], -500, 500)))})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(predict, f"{key} {kind}, score double")


def score_documents(docs: DataFrame, labels: DataFrame, *, most: int = 2048, longest: int = 8192,
                    width: int = 48, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, whole texts. Labels are learned
    only from rows whose crc32(doc_id) modulo 5 is not 0; text alone decides a score.

    Null, empty or wordless text: the score of no evidence, which is the bias alone. Very
    long texts: every window counts; beyond about a million characters they are read in
    overlapping pieces. Null doc_id: folds as empty text, has no label. Null labels: not
    learned from. Repeated rows: a result each, learned from once. No labels or one
    class alone: scores near that class's share. Empty table: no rows. Other columns
    are not read.
    """
    weight, bias = learn(sample_of(docs, labels, most=most, longest=longest), width=width, **settings)
    out = score(docs, weight, bias, width=width)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
