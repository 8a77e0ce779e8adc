"""Benchmark decontamination: n-gram seeds, then local alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged
from .text import ALNUM, bit_table, grams, hashed_words, marked, mix, slices

def item_words(items: DataFrame) -> DataFrame:
    """(item, item_id, words): a hash of each distinct row, and the names of its words, 8 bytes each."""
    def read(batches):
        for batch in batches:
            out = []
            for i, j, data, offs in slices(batch.column(2)):
                doc, name = hashed_words(data, offs, ALNUM)
                out += [x.tobytes() for x in np.split(name, np.searchsorted(doc, np.arange(1, j - i)))]
            yield pa.RecordBatch.from_pydict({"item": batch.column(0), "item_id": batch.column(1), "words": pa.array(out, pa.binary())})
    kind = dict(items.dtypes)["item_id"]
    own = F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item")
    return items.select(own, "item_id", "text").dropDuplicates(["item"]).mapInArrow(read, f"item long, item_id {kind}, words binary")


def item_grams(words: DataFrame, n: int) -> DataFrame:
    """(item, gram): each item's distinct runs of n words. All of them are seeds: one
    that is common in the corpus may be the only one that an edited copy still holds."""
    def read(batches):
        for batch in batches:
            names = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(1)]
            doc = np.repeat(np.arange(len(names)), [len(x) for x in names])
            doc, _, gram = grams(doc, np.concatenate(names) if names else np.zeros(0, np.uint64), n)
            yield pa.RecordBatch.from_pydict({"item": batch.column(0).take(pa.array(doc)), "gram": gram.view(np.int64)})
    return words.select("item", "words").mapInArrow(read, "item long, gram long").distinct()


def seeded_passages(docs: DataFrame, seeds: DataFrame, n: int, reach: int) -> DataFrame:
    """(k, doc_id, at, words, found): the stretches of documents within `reach` words
    of a seed, and the seeds in them; overlapping stretches are one."""
    known = bit_table(seeds, "gram")

    def find(batches):
        for batch in batches:
            out: dict[str, list] = {"row": [], "at": [], "words": [], "found": []}
            for i, _, data, offs in slices(batch.column(2)):
                doc, name = hashed_words(data, offs, ALNUM)
                own, first, gram = grams(doc, name, n)
                on = marked(known.value, gram)
                if not on.any():
                    continue
                own, first, gram = own[on], first[on], gram[on]
                start = np.searchsorted(doc, own, "left")
                low = np.maximum(first - reach, start)
                high = np.minimum(first + n + reach, np.searchsorted(doc, own, "right"))
                new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (low[1:] > high[:-1]))))
                for a, b in zip(new, np.append(new[1:], len(own)), strict=True):
                    out["row"].append(i + own[a])
                    out["at"].append(int(low[a] - start[a]))
                    out["words"].append(name[low[a]:high[b - 1]].tobytes())
                    out["found"].append(np.unique(gram[a:b]).view(np.int64).tolist())
            if out["row"]:
                rows = pa.array(np.array(out["row"]))
                yield pa.RecordBatch.from_pydict({
                    "k": batch.column(0).take(rows), "doc_id": batch.column(1).take(rows), "at": pa.array(out["at"], pa.int32()),
                    "words": pa.array(out["words"], pa.binary()), "found": pa.array(out["found"], pa.list_(pa.int64()))})

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("k", "doc_id", "text").mapInArrow(find, f"k long, doc_id {kind}, at int, words binary, found array<long>")


def align(passages: list[np.ndarray], items: list[np.ndarray], match: int = 2, mismatch: int = -1, gap: int = -1) -> np.ndarray:
    """Smith-Waterman scores of pairs of word sequences, all pairs at a time. A
    row's gaps come from a running maximum, as the gap cost is linear."""
    wide, deep = max(map(len, passages), default=0), max(map(len, items), default=0)
    if not wide or not deep:
        return np.zeros(len(passages), np.int64)
    p, q = np.zeros((len(passages), wide), np.uint64), np.zeros((len(items), deep), np.uint64)
    p_on, q_on = np.zeros(p.shape, bool), np.zeros(q.shape, bool)
    for k, (a, b) in enumerate(zip(passages, items, strict=True)):
        p[k, :len(a)], p_on[k, :len(a)], q[k, :len(b)], q_on[k, :len(b)] = a, True, b, True
    slope = (np.arange(wide) * -gap).astype(np.int32)
    last, best = np.zeros((len(passages), wide + 1), np.int32), np.zeros(len(passages), np.int32)
    for j in range(deep):
        same = (p == q[:, j:j + 1]) & p_on & q_on[:, j:j + 1]
        now = np.maximum(last[:, :-1] + np.where(same, match, mismatch), last[:, 1:] + gap)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        last[:, 1:] = np.where(q_on[:, j:j + 1], now, 0)
        best = np.maximum(best, last.max(axis=1))
    return best


def likely(passages, items, threshold: float) -> np.ndarray:
    """Marks of pairs that can reach the threshold: an alignment matches at most those
    words of the item that occur in the passage."""
    def joined(column):
        size = column.str.len().to_numpy() // 8
        pair = np.repeat(np.arange(len(column)), size)
        return pair, np.frombuffer(b"".join(column), np.uint64) ^ mix(pair.astype(np.uint64) + np.uint64(1)), size

    _, held, _ = joined(passages)
    pair, name, size = joined(items)
    return np.bincount(pair[np.isin(name, held)], minlength=len(size)) >= threshold * size


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5, n: int = 3) -> DataFrame:
    """(k, doc_id, item_id, score, n_seeds) of documents that hold a copy, whole,
    edited or in part, of a test item. score: the alignment's score over that of an
    exact copy; rows reach `threshold`.

    One pass over the corpus finds the passages around the items' n-grams: every one,
    rare or not, so a copy is aligned if it shares a single run of n words with the
    item; an edited copy that has no such run left is not found. Workers hold a bit
    table of 2 MB; exact joins on the gram follow it, so a benchmark of any size gives
    the same rows. Pairs with too few words in common are not aligned.

    Words are runs of letters and digits in small letters. Null or empty texts and
    items with fewer than n words match nothing. Null doc_id: kept; `k` tells rows
    apart, equal rows share it. Items are told apart by id and text; a null item_id is
    kept, and of items with one id the best counts. Empty tables: no rows. Other columns are not read.
    """
    base = docs.select("doc_id", F.lower("text").alias("text"), F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("k"))
    words = staged(item_words(items.select("item_id", F.lower("text").alias("text"))), "item-words")
    longest = int(words.agg(F.max(F.length("words"))).first()[0] or 0) // 8
    seeds = staged(item_grams(words, n), "seeds")
    passages = staged(seeded_passages(base, seeds, n, longest + longest // 4 + 1)
                      .withColumn("pid", F.xxhash64("k", "at")), "passages")
    pairs = (passages.select("pid", F.explode("found").alias("gram")).join(seeds, "gram")
             .groupBy("pid", "item").agg(F.count_distinct("gram").alias("n_seeds")))
    both = (pairs.join(passages.select("pid", "k", "doc_id", F.col("words").alias("passage")).dropDuplicates(["pid"]), "pid")
            .join(words, "item").select("k", "doc_id", "item", "n_seeds", "passage", "words"))

    def score(frames):
        for frame in frames:
            frame = frame[likely(frame["passage"], frame["words"], threshold)]
            size = frame["passage"].str.len().to_numpy() // 8
            order = np.argsort(size, kind="stable")
            out = np.zeros(len(frame))
            at = 0
            while at < len(order):  # pairs of like length together, a bounded matrix at a time
                end = at + 1
                while end < len(order) and (end - at) * size[order[end]] < 200_000:
                    end += 1
                rows = order[at:end]
                a = [np.frombuffer(x, np.uint64) for x in frame["passage"].iloc[rows]]
                b = [np.frombuffer(x, np.uint64) for x in frame["words"].iloc[rows]]
                out[rows] = align(a, b) / np.array([max(1, 2 * len(x)) for x in b])
                at = end
            res = frame[["k", "doc_id", "item", "n_seeds"]].copy()
            res["score"] = out
            yield res[out >= threshold]

    kind = dict(both.dtypes)["doc_id"]
    scored = (both.mapInPandas(score, f"k long, doc_id {kind}, item long, n_seeds long, score double")
              .join(words.select("item", "item_id"), "item"))
    return scored.groupBy("k", "doc_id", "item_id").agg(F.max("score").alias("score"), F.max("n_seeds").alias("n_seeds"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, all columns, that hold no copy of a test item."""
    bad = contaminated(docs, items, **options).select(F.col("k").alias("__leak")).distinct()
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")
    return docs.join(bad, key == F.col("__leak"), "left_anti")
