"""Jaccard join of word n-gram sets with Bayesian candidate pruning."""

from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import components, staged
from .text import SPACE, bit_table, grams, hashed_words, marked, mix, slices

HASHES, BAND_ROWS = 128, 4
#: Bytes of texts whose shingles are made at once.
SLICE = 1 << 18
#: Hash values compared before each pruning step.
STEPS = (16, 32, 64, 128)
_rng = np.random.default_rng(5)
_MULT = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For each step n the least number m of equal values with which the posterior
    probability of a Jaccard index of `threshold` or more, under a uniform prior,
    reaches the tolerance: P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in STEPS:
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def shingle_sets(data: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle), distinct and sorted; shingles are 48-bit names of n words
    in small letters, or of the whole text where it has fewer words."""
    doc, name = hashed_words(data, offs, ~SPACE)
    own, _, gram = grams(doc, name, n)
    count = np.bincount(doc, minlength=len(offs) - 1)
    for d in np.flatnonzero((count > 0) & (count < n)):
        at = int(np.searchsorted(doc, d))
        whole = np.zeros(1, np.uint64)
        for k in range(at, at + count[d]):
            whole = mix(whole * np.uint64(3) + name[k:k + 1])
        own, gram = np.append(own, d), np.append(gram, mix(whole))
    key = np.unique((own.astype(np.uint64) << np.uint64(48)) | (gram >> np.uint64(16)))
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1)


def set_names(shingle: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 16-byte name of each set, free of order: [sets, 2]."""
    return np.stack([mix(np.add.reduceat(mix(shingle + np.uint64(c)), first) + size.astype(np.uint64)) for c in (11, 77)], axis=1)


def sketches(shingle: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values [sets, HASHES], 32 bits each."""
    spread = mix(shingle)
    out = np.empty((len(first), HASHES), np.uint32)
    for h in range(HASHES):
        out[:, h] = np.minimum.reduceat(((spread * _MULT[h]) >> np.uint64(32)).astype(np.uint32), first)
    return out


def _read_sets(n: int, known=None):
    """Rows (doc_id, k, rid, size, sketch) of all documents; or, with a bit table,
    (rid, sketch, shingles) of those whose set it marks."""
    def run(batches):
        for batch in batches:
            rid = np.zeros((len(batch), 2), np.uint64)
            some, size = np.zeros(len(batch), bool), np.zeros(len(batch), np.int32)
            sketch, sets = [], []
            for i, j, data, offs in slices(batch.column(2), SLICE):
                doc, shingle = shingle_sets(data, offs, n)
                own, first = np.unique(doc, return_index=True)
                if not len(own):
                    continue
                count = np.diff(np.append(first, len(doc)))
                names = set_names(shingle, first, count)
                take = np.ones(len(own), bool) if known is None else marked(known.value, names[:, 0])
                rid[i + own], size[i + own] = names, count
                some[i + own[take]] = True
                if not take.any():
                    continue
                if known is None:
                    sketch += [x.tobytes() for x in sketches(shingle, first)]
                else:
                    keep = np.repeat(take, count)
                    shingle, count = shingle[keep], count[take]
                    first = np.cumsum(count) - count
                    sketch += [x.tobytes() for x in sketches(shingle, first)]
                    sets += [x.tobytes() for x in np.split(shingle, first[1:])]
            at = pa.array(np.flatnonzero(some))
            rids = pa.array([x.astype(">u8").tobytes() for x in rid[some]], pa.binary())
            if known is not None:
                if len(at):
                    yield pa.RecordBatch.from_pydict({"rid": rids, "sketch": pa.array(sketch, pa.binary()), "shingles": pa.array(sets, pa.binary())})
                continue
            full_rid, full_sketch = np.full(len(batch), None, object), np.full(len(batch), None, object)
            full_rid[some], full_sketch[some] = rids.to_pylist(), sketch
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "k": batch.column(1), "rid": pa.array(full_rid, pa.binary()),
                                              "size": size, "sketch": pa.array(full_sketch, pa.binary())})
    return run


def band_keys(reps: DataFrame) -> DataFrame:
    """(rid, key): one key for each band of BAND_ROWS values."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            sketch = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in batch.column(1)]).astype(np.uint64)
            bands = HASHES // BAND_ROWS
            key = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(sketch), axis=0)
            for r in range(BAND_ROWS):
                key = mix(key * np.uint64(5) + sketch[:, r::BAND_ROWS])
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), bands))),
                                              "key": key.reshape(-1).view(np.int64)})
    return reps.select("rid", "sketch").mapInArrow(run, "rid binary, key long")


def unpruned(a: np.ndarray, b: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two sketch blocks that no pruning step drops; with `same`, each pair once."""
    count = np.zeros((len(a), len(b)), np.uint8)
    for h in range(STEPS[0]):
        count += a[:, h, None] == b[None, :, h]
    live = count >= least[0]
    if same:
        live = np.triu(live, 1)
    p, q = np.nonzero(live)
    matches = count[p, q].astype(np.int64)
    for k in range(1, len(STEPS)):
        for at in range(0, len(p), 1 << 16):
            part = slice(at, at + (1 << 16))
            matches[part] += (a[p[part], STEPS[k - 1]:STEPS[k]] == b[q[part], STEPS[k - 1]:STEPS[k]]).sum(axis=1)
        keep = matches >= least[k]
        p, q, matches = p[keep], q[keep], matches[keep]
    return p, q


def exact_overlap(a: list[np.ndarray], b: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a[p] and b[q]: pair by pair, or, where most rows
    meet most others, by products of 0/1 matrices over slices of the vocabulary."""
    if len(p) <= 4 * (len(a) + len(b)):
        return np.array([len(np.intersect1d(a[i], b[j], assume_unique=True)) for i, j in zip(p, q, strict=True)], np.int64)
    words, at = np.unique(np.concatenate(a + b), return_inverse=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in a + b])
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    out = np.zeros((len(a), len(b)), np.int64)
    wide = 4096
    for low in range(0, len(words), wide):
        part = slice(np.searchsorted(at, low), np.searchsorted(at, low + wide))
        has = np.zeros((len(a) + len(b), wide), np.float32)
        has[row[part], at[part] - low] = 1
        out += (has[:len(a)] @ has[len(a):].T).astype(np.int64)
    return out[p, q]


def forest(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The least row that each of n rows is connected to."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, p, label[q])
        np.minimum.at(new, q, label[p])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def in_blocks(members: DataFrame, block: int, pack: int) -> DataFrame:
    """Adds root, i, j, b and g to members (node, root, ...). A component of at most
    2 * block rows is one block; a larger one is cut into blocks, and each pair of
    blocks i <= j is a group of its own that holds the rows of b = i and b = j. Small
    components share groups of about `pack` rows."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    with_size = members.join(sizes, "root")
    n_small = members.count()
    parts = F.when(F.col("m") <= 2 * block, F.lit(1)).otherwise(F.ceil(F.col("m") / block).cast("int"))
    cut = (with_size.withColumn("nb", parts).withColumn("b", F.pmod(F.xxhash64("rid"), F.col("nb").cast("long")).cast("int"))
           .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
           .withColumn("i", F.least("b", "t")).withColumn("j", F.greatest("b", "t")))
    small = F.pmod(F.xxhash64("root"), F.lit(max(1, n_small // pack)).cast("long"))
    return (cut.withColumn("g", F.when(F.col("nb") == 1, small).otherwise(F.xxhash64("root", "i", "j")))
            .drop("t", "m", "nb"))


def _block_pairs(frame: pd.DataFrame, least: list[int]):
    """For each pair of blocks in a group: its rows, and the pairs that are left."""
    for _, part in frame.groupby(["root", "i", "j"], sort=False):
        i, j = part["i"].iloc[0], part["j"].iloc[0]
        sketch = np.stack([np.frombuffer(x, np.uint32) for x in part["sketch"]])
        if i == j:
            p, q = unpruned(sketch, sketch, True, least)
        else:
            one, two = np.flatnonzero(part["b"] == i), np.flatnonzero(part["b"] == j)
            p, q = unpruned(sketch[one], sketch[two], False, least)
            p, q = one[p], two[q]
        yield part, p, q


def similar_groups(docs: DataFrame, threshold: float = 0.8, n: int = 5, tolerance: float = 1e-7, block: int = 512) -> DataFrame:
    """doc_id, k, class_id and n_links of every document: its class under links of
    Jaccard index >= `threshold` between the sets of word n-grams, named by the
    least doc_id, and the number of other documents it is linked to itself.

    Documents of equal sets are one representative with a number of copies. Those
    that share a band of MinHash values fall into one candidate component; within
    it sketches are compared a few values at a time and a pair is dropped once the
    posterior probability of reaching the threshold is below `tolerance`; what is
    left forms tighter components, and there every remaining pair is counted
    exactly. 32 bands of 4 values miss a pair at the threshold with probability
    5e-8. Large components are compared in pairs of blocks; no pair is a row: tasks
    give out sums of links and a spanning forest.

    Texts of fewer than n words: one shingle, the whole text. Null and empty texts:
    a class each, no link. Null doc_id: kept; a class of null ids only has a null
    name. Repeated rows: copies. Empty table: no rows. Other columns are not read.
    """
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")
    base = docs.select("doc_id", key.alias("k"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    rows = staged(base.mapInArrow(_read_sets(n), f"doc_id {kind}, k long, rid binary, size int, sketch binary"), "jaccard-rows")
    reps = staged(rows.where("rid is not null").groupBy("rid").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.first("sketch").alias("sketch")), "jaccard-reps")
    least = least_matches(threshold, tolerance)
    ratio = Fraction(str(threshold))

    bands = band_keys(reps)
    buckets = bands.groupBy("key").agg(F.min("rid").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    loose = components(bands.join(buckets, "key").where("rid != hub").select("rid", "hub").distinct(), "rid", "hub")

    def prune(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, p, q in _block_pairs(frame, least):
            label = forest(len(part), p, q)
            rid = part["rid"].to_numpy()
            apart = label != np.arange(len(part))
            out.append(pd.DataFrame({"u": rid[apart], "v": rid[label[apart]]}))
        return pd.concat(out)

    members = loose.withColumnRenamed("node", "rid").join(reps.select("rid", "sketch"), "rid")
    left = in_blocks(staged(members, "jaccard-loose"), block, 2048).groupBy("g").applyInPandas(prune, "u binary, v binary")
    tight = components(left)

    known = bit_table(tight.select(_first_long(F.col("node")).alias("h")), "h")
    sets = (base.mapInArrow(_read_sets(n, known), "rid binary, sketch binary, shingles binary")
            .groupBy("rid").agg(F.first("sketch").alias("sketch"), F.first("shingles").alias("shingles")))
    full = staged(tight.withColumnRenamed("node", "rid").join(sets, "rid").join(reps.select("rid", "copies"), "rid"), "jaccard-sets")

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, p, q in _block_pairs(frame, least):
            sets = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
            size = np.array([len(x) for x in sets])
            if part["i"].iloc[0] == part["j"].iloc[0]:
                both = exact_overlap(sets, sets, p, q)
            else:
                side = (part["b"] == part["i"]).to_numpy()
                one, two = np.flatnonzero(side), np.flatnonzero(~side)
                both = exact_overlap([sets[x] for x in one], [sets[x] for x in two], np.searchsorted(one, p), np.searchsorted(two, q))
            good = both * ratio.denominator >= (size[p] + size[q] - both) * ratio.numerator
            p, q = p[good], q[good]
            copies = part["copies"].to_numpy()
            links = np.bincount(p, copies[q], len(part)) + np.bincount(q, copies[p], len(part))
            label = forest(len(part), p, q)
            rid = part["rid"].to_numpy()
            out.append(pd.DataFrame({"rid": rid, "links": links.astype(np.int64), "v": rid[label]})[links > 0])
        return pd.concat(out)

    found = staged(in_blocks(full, block, 256).groupBy("g").applyInPandas(verify, "rid binary, links long, v binary"), "jaccard-links")
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    classes = components(found.select("rid", "v").distinct(), "rid", "v").select(F.col("node").alias("rid"), "root")
    named = (reps.select("rid", "copies", "least_id").join(classes, "rid", "left").join(links, "rid", "left")
             .select("rid", F.coalesce("root", "rid").alias("root"), "least_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    heads = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    info = named.join(heads, "root").select("rid", "class_id", "n_links", "root")
    return rows.select("doc_id", "k", "rid").join(info, "rid", "left").select(
        "doc_id", "k", F.when(F.col("rid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root")


def _first_long(column):
    """The first 8 bytes of a binary as a long."""
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, -10).cast("long")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, one of each class: the least doc_id, of repeated
    rows one. Texts without words are classes of their own and stay."""
    marks = staged(similar_groups(docs, **options), "jaccard-classes")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")
    heads = marks.where("root is not null").groupBy("root").agg(F.min(order).alias("head")).select(F.col("head.k").alias("k"))
    keys = (heads.unionByName(marks.where("root is null").select("k"))).distinct()
    counts = marks.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("root").isNull()).alias("free"))
    keys = keys.join(counts, "k").select(F.col("k").alias("__k"), ((F.col("rows") > 1) & ~F.col("free")).alias("__more"))
    kept = docs.withColumn("__k", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")).join(keys, "__k")
    alone = kept.where(~F.col("__more"))
    return alone.unionByName(kept.where("__more").dropDuplicates(["__k"])).select(*docs.columns)
