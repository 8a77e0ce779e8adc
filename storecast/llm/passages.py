"""Runs of words that several documents share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import dropped, staged
from .text import SPACE, Prints, bit_table, marked, slices, slide, words

#: Starts of strings of words that may share an anchor.
WINDOW = 32


def segments(doc: np.ndarray, prints: Prints, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, end of starts, anchor) of runs of starts of strings of `least` words within a text,
    each start in one run. A start's anchor is the least gram among the WINDOW ones inside
    its string, so it depends on the words of that string alone."""
    size = least - WINDOW + 1
    if len(doc) < least:
        return (np.zeros(0, np.int64),) * 3
    at = np.arange(len(doc) - size + 1)
    gram = prints.of(at, at + size)
    low = slide(gram & np.uint64(0xFFFFFFFF00000000) | at.astype(np.uint64), WINDOW, np.minimum)
    start = np.flatnonzero(doc[:len(low)] == doc[least - 1:])
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(start) else start
    return start[new], start[np.append(new[1:], len(start)) - 1] + 1 if len(new) else new, anchor[new]


def _named(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, Prints]:
    doc, start, end = words(data, offs, ~SPACE)
    return doc, Prints(Prints(data).of(start, end))


def _anchors(least: int):
    """(x, f): the anchors of the strings of `least` words of each text."""
    def run(batches):
        for batch in batches:
            x = batch.column(0).to_numpy()
            for i, _, data, offs in slices(batch.column(1)):
                doc, prints = _named(data, offs)
                low, _, anchor = segments(doc, prints, least)
                if len(low):
                    yield pa.RecordBatch.from_pydict({"x": x[i + doc[low]], "f": prints.of(anchor, anchor + least - WINDOW + 1).view(np.int64)})
    return run


def _segments(least: int, table):
    """(k, x, total, at, f, c, s): the starts from word `at` of a text share the anchor named f, which the table
    marks; c names all words of their strings and the place of the anchor, s each string. Without a mark, s is
    empty and only the first of a text comes out."""
    def run(batches):
        for batch in batches:
            k, x = (batch.column(j).to_numpy() for j in (0, 1))
            for i, _, data, offs in slices(batch.column(2)):
                doc, prints = _named(data, offs)
                low, end, anchor = segments(doc, prints, least)
                f = prints.of(anchor, anchor + least - WINDOW + 1)
                own = doc[low]
                first, last = np.searchsorted(doc, own), np.searchsorted(doc, own, "right")
                on = marked(table.value, f)
                keep = on | (low == first)
                if not keep.any():
                    continue
                low, end, anchor, f, own, first, last, on = (v[keep] for v in (low, end, anchor, f, own, first, last, on))
                c = prints.of(low, end + least - 1) * np.uint64(0x9FB21C651E98DF25) + (anchor - low).astype(np.uint64)
                n = (end - low) * on
                edge = np.concatenate(([0], np.cumsum(n)))
                start = np.arange(edge[-1]) + np.repeat(low - edge[:-1], n)
                yield pa.RecordBatch.from_pydict({
                    "k": k[i + own], "x": x[i + own], "total": (last - first).astype(np.int32), "at": (low - first).astype(np.int32),
                    "f": f.view(np.int64), "c": c.view(np.int64),
                    "s": pa.ListArray.from_arrays(edge.astype(np.int32), prints.of(start, start + least).view(np.int64))})
    return run


def _covered(batches):
    """(x, n_words): how many words the spans of a text cover."""
    for batch in batches:
        out = []
        for spans in batch.column("spans"):
            low, high = (spans.values.field(x).to_numpy() for x in ("lo", "hi"))
            order = np.argsort(low, kind="stable")
            high = np.maximum.accumulate(high[order])
            out.append(int((high - np.maximum(low[order], np.concatenate(([0], high[:-1])))).clip(0).sum()))
        yield pa.RecordBatch.from_pydict({"x": batch.column("x"), "n_words": pa.array(out, pa.int64())})


def shared_words(base: DataFrame, least: int = 51, table_bits: int = 27) -> DataFrame:
    """(k, n_words): the words of a text that strings of `least` words cover which also stand in the
    text of another k; texts without any do not come out. base: (k, text as binary); rows of one k are one document.

    Words are runs of bytes other than ASCII blanks; they are equal if their bytes are, whatever blanks part them.
    A text (named x) of several k is shared as a whole. Starts of one anchor go together: segments of equal words in several texts are settled as a whole; where equal and
    unequal segments share an anchor, single strings are, of one segment of each kind.
    """
    if least <= WINDOW:
        raise ValueError(f"least must be over {WINDOW}")
    several = F.col("first") != F.col("last")
    between = (F.min("x").alias("first"), F.max("x").alias("last"))
    base = base.select("k", F.xxhash64("text").alias("x"), "text")
    met = base.select("x", "text").mapInArrow(_anchors(least), "x long, f long").groupBy("f").agg(*between).where(several)
    found = staged(base.mapInArrow(_segments(least, bit_table(met, "f", table_bits)), "k long, x long, total int, at int, f long, c long, s array<long>"), "passage-found")
    some = found.where(F.size("s") > 0)
    kinds = staged(some.groupBy("c").agg(F.min("f").alias("f"), *between, F.any_value("s").alias("s")), "passage-kinds")
    whole = (some.select("x", "at", "c", F.size("s").alias("n")).join(kinds.where(several).select("c"), "c", "left_semi")
             .select("x", F.col("at").alias("lo"), (F.col("at") + F.col("n") + least - 1).alias("hi")))
    mixed = (kinds.groupBy("f").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max(~several).alias("open"))
             .where(several & F.col("open")).select("f"))
    strings = staged(kinds.join(mixed, "f", "left_semi").select("c", "first", "last", F.posexplode("s").alias("d", "s")), "passage-strings")
    twice = strings.groupBy("s").agg(F.min("first").alias("first"), F.max("last").alias("last")).where(several).select("s")
    bounds = strings.where(~several).join(twice, "s", "left_semi").groupBy("c").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    parts = some.select("x", "at", "c").join(bounds, "c").select("x", (F.col("at") + F.col("low")).alias("lo"), (F.col("at") + F.col("high") + least).alias("hi"))
    spans = whole.unionByName(parts).groupBy("x").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    heads = found.where("at = 0").select("k", "x", "total")
    copies = heads.groupBy("x").agg(F.min("k").alias("first"), F.max("k").alias("last"))
    per_text = copies.join(spans.mapInArrow(_covered, "x long, n_words long"), "x", "left").where(several | F.col("n_words").isNotNull())
    out = staged(heads.join(per_text, "x").select("k", F.when(several, F.col("total").cast("long")).otherwise(F.col("n_words")).alias("n_words")).distinct(), "passage-words")
    dropped(found, kinds, strings)
    return out
