"""Removal of repeated byte strings by distributed prefix doubling."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passages import shared_words
from .tables import dropped, staged
from .text import Prints, bit_table, marked, mix, slices, slide

GRAM, WINDOW, STEP = 16, 128, 16
#: Prefix lengths whose ranks the anchors go through before whole strings are compared.
FIRST, SECOND = 128, 256


def anchors(data: np.ndarray, offs: np.ndarray, prints: Prints, least: int) -> np.ndarray:
    """Positions that equal strings share: in each run of WINDOW starts the places
    of least 16-byte gram, for every start of a string of `least` bytes within a
    text. Whether a place is one depends on the bytes of that string alone."""
    n = len(data)
    if n < least:
        return np.zeros(0, np.int64)
    raw = (prints.sums[GRAM:] - prints.sums[:-GRAM]) * prints.back[:n + 1 - GRAM] * np.uint64(0x9E3779B97F4A7C15)
    gram = (raw >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = slide(gram, WINDOW, np.minimum)
    open_at = np.zeros(len(low) + 1, np.int32)
    size = np.diff(offs)
    long = size >= least
    np.add.at(open_at, offs[:-1][long], 1)
    np.add.at(open_at, offs[1:][long] - least + 1, -1)
    low[np.cumsum(open_at)[:len(low)] == 0] = 0
    edge = np.zeros(WINDOW - 1, np.uint32)
    reach = slide(np.concatenate((edge, low, edge)), WINDOW, np.maximum)
    return np.flatnonzero(gram == reach)


def _ranks(least: int, tables: list):
    """(r): the rank of the first FIRST bytes at each anchor; with one bit table the
    rank of SECOND bytes, at the anchors whose shorter rank it marks."""
    def run(batches):
        for batch in batches:
            for _, _, data, offs in slices(batch.column(0)):
                prints = Prints(data)
                at = anchors(data, offs, prints, least)
                rank = prints.of(at, at + FIRST)
                if tables:
                    on = marked(tables[0].value, rank)
                    rank = _pair(rank[on], prints.of(at[on] + FIRST, at[on] + SECOND))
                if len(rank):
                    yield pa.RecordBatch.from_pydict({"r": rank.view(np.int64)})
    return run


def _pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The rank of a string whose halves have these ranks."""
    return mix(one * np.uint64(0x9FB21C651E98DF25) + two)


def _marked_texts(least: int, tables: list):
    """(k, text, at): the texts with anchors that both tables mark, and those anchors."""
    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, _, data, offs in slices(batch.column(1)):
                prints = Prints(data)
                at = anchors(data, offs, prints, least)
                rank = prints.of(at, at + FIRST)
                on = marked(tables[0].value, rank)
                at, rank = at[on], rank[on]
                at = at[marked(tables[1].value, _pair(rank, prints.of(at + FIRST, at + SECOND)))]
                doc = np.searchsorted(offs, at, "right") - 1
                own, first = np.unique(doc, return_index=True)
                rows += (i + own).tolist()
                found += [(x - offs[d]).astype(np.int32) for d, x in zip(own, np.split(at, first[1:]), strict=True)] if len(own) else []
            if rows:
                take = pa.array(rows)
                yield pa.RecordBatch.from_pydict({"k": batch.column(0).take(take), "text": batch.column(1).take(take),
                                                  "at": pa.array(found, pa.list_(pa.int32()))})
    return run


def _per_text(make, names: list[str]):
    """Runs make(data, prints, row) over each (k, text, ...) row of a subset table."""
    def run(batches):
        for batch in batches:
            columns = {c: batch.column(c) for c in names}
            texts = batch.column("text")
            out = None
            for row in range(len(batch)):
                data = np.frombuffer(texts[row].as_buffer(), np.uint8)
                got = make(data, Prints(data), {c: columns[c][row].as_py() for c in names})
                if out is None:
                    out = {c: [] for c in got}
                for c, v in got.items():
                    out[c].append(v)
                if len(out["k"]) >= 256:
                    yield pa.RecordBatch.from_pydict({c: np.concatenate(v) for c, v in out.items()})
                    out = None
            if out is not None:
                yield pa.RecordBatch.from_pydict({c: np.concatenate(v) for c, v in out.items()})
    return run


def _fill(value: int, n: int) -> np.ndarray:
    return np.full(n, value, np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def repeat_spans(base: DataFrame, least: int = 400, table_bits: int = 27) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): the texts (k, text) that may hold repeats, and (k, spans)
    with an array of (lo, hi) whose union is what strings of `least` bytes that also start elsewhere cover;
    lo and hi may lie outside of the text. base: (k, text as binary); rows of one k
    are copies of one another.

    Prefix doubling over position and rank pairs: an anchor starts with the rank of
    its first 128 bytes; those of a unique rank leave, the others get the rank of
    the pair (own rank, rank 128 bytes on). Ranks are 64-bit names: a round is one
    shuffle of ranks, and the ranks that occur twice go to the workers as a bit
    table of fixed size (2**table_bits bits). An anchor that the table marks by
    mistake is found to be unique later. For the survivors the rest of the length is
    settled exactly by the same step over longer strings: whole surroundings of an
    anchor, of which equal ones are settled together; then, where equal and unequal
    surroundings meet, 385-byte strings that 16 neighbouring starts share, and in
    the end single starts.
    """
    reach = WINDOW - 1
    tables: list = []
    for _ in (FIRST, SECOND):
        again = base.select("text").mapInArrow(_ranks(least, list(tables)), "r long").groupBy("r").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        tables.append(bit_table(again, "r", table_bits))
    texts = staged(base.mapInArrow(_marked_texts(least, tables), "k long, text binary, at array<int>"), "repeat-texts")

    def surroundings(data, prints, row):
        a = np.array(row["at"], np.int64)
        lo, hi = np.maximum(a - reach, 0), np.minimum(a + least, len(data))
        name = prints.of(lo, hi) * np.uint64(0x9FB21C651E98DF25) + (a - lo).astype(np.uint64)
        return {"k": _fill(row["k"], len(a)), "a": a, "f": _signed(prints.of(a, a + SECOND)), "c": _signed(name)}

    around = staged(texts.mapInArrow(_per_text(surroundings, ["k", "at"]), "k long, a long, f long, c long")
                    .select("k", F.col("a").cast("int").alias("a"), "f", "c"), "repeat-around")
    kinds = staged(around.groupBy("c").agg(F.min("f").alias("f"), F.count(F.lit(1)).alias("cw"), F.min("k").alias("k"), F.min_by("a", F.struct("k", "a")).alias("a")), "repeat-kinds")
    closed = (around.select("k", "a", "c").join(kinds.where("cw > 1").select("c"), "c", "left_semi")
              .select("k", (F.col("a") - reach).alias("lo"), (F.col("a") + least).alias("hi")))
    mixed = kinds.groupBy("f").agg(F.count(F.lit(1)).alias("nc"), F.min("cw").alias("low")).where("nc > 1 and low = 1").select("f")
    taking = kinds.join(mixed, "f", "left_semi").select("k", "a", F.least("cw", F.lit(2)).cast("int").alias("cw"))

    def ranges(data, prints, row):
        a, cw = (np.array([x[n] for x in row["own"]], np.int64) for n in ("a", "cw"))
        g = np.tile(np.arange(WINDOW // STEP), len(a))
        a, cw = (np.repeat(x, WINDOW // STEP) for x in (a, cw))
        low, high = np.maximum(g * STEP, a + least - len(data)), np.minimum(g * STEP + STEP - 1, a)
        on = low <= high
        a, cw, g, low, high = (x[on] for x in (a, cw, g, low, high))
        start = a - g * STEP
        inner = mix(prints.of(start, start + least - STEP + 1) + g.astype(np.uint64))
        outer = mix(prints.of(a - high, a - low + least) + (low * 1024 + high).astype(np.uint64))
        return {"k": _fill(row["k"], len(a)), "at": (a << 17) | (low << 9) | (high << 1) | (cw > 1), "i": _signed(inner), "u": _signed(outer)}

    # at: position, least and largest distance of a start before it, and whether it counts twice.
    own = taking.groupBy("k").agg(F.collect_list(F.struct("a", "cw")).alias("own"))
    parts = staged(texts.select("k", "text").join(own, "k").mapInArrow(_per_text(ranges, ["k", "own"]), "k long, at long, i long, u long"), "repeat-ranges")
    twin = F.col("at").bitwiseAND(1)
    outer = staged(parts.groupBy("u").agg(F.min("i").alias("i"), F.sum(twin + 1).alias("uw"), F.min("k").alias("k"), F.min_by("at", F.struct("k", "at")).alias("at")), "repeat-outer")
    several = outer.groupBy("i").agg(F.count(F.lit(1)).alias("nu"), F.min("uw").alias("least")).where("nu > 1 and least = 1").select("i")
    single = outer.join(several, "i", "left_semi").select("u", "k", "at")

    def starts(data, prints, row):
        at, u = (np.array([x[n] for x in row["own"]], np.int64) for n in ("at", "u"))
        a, low, high = at >> 17, (at >> 9) & 255, (at >> 1) & 255
        n = high - low + 1
        a, u, low = (np.repeat(x, n) for x in (a, u, low))
        d = low + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        return {"k": _fill(row["k"], len(a)), "u": u, "d": d, "s": _signed(mix(prints.of(a - d, a - d + least) + d.astype(np.uint64)))}

    asked = single.groupBy("k").agg(F.collect_list(F.struct("at", "u")).alias("own"))
    tested = staged(texts.select("k", "text").join(asked, "k").mapInArrow(
        _per_text(starts, ["k", "own"]), "k long, u long, d long, s long").select("u", F.col("d").cast("int").alias("d"), "s"), "repeat-starts")
    twice = tested.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s")
    met = tested.join(twice, "s", "left_semi").groupBy("u").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    low, high = F.shiftright("at", 9).bitwiseAND(255).cast("int"), F.shiftright("at", 1).bitwiseAND(255).cast("int")
    sure = outer.where("uw > 1").select("u", low.alias("low"), high.alias("high"))
    bounds = staged(sure.unionByName(met).groupBy("u").agg(F.min("low").alias("dmin"), F.max("high").alias("dmax")), "repeat-bounds")
    dropped(tested, outer)
    a = F.shiftright("at", 17)
    opened = (parts.where(twin == 0).select("k", a.cast("int").alias("a"), "u").join(bounds, "u")
              .select("k", (F.col("a") - F.col("dmax")).alias("lo"), (F.col("a") - F.col("dmin") + least).alias("hi")))
    spans = staged(closed.unionByName(opened).groupBy("k").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "repeat-spans")
    dropped(around, kinds, parts, bounds)
    return texts, spans


def _cut(with_text: bool):
    def run(batches):
        for batch in batches:
            out = {"k": batch.column("k"), "n_removed": [], "n_spans": [], "kept_sha256": []}
            kept_texts = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = text.as_py()
                at = np.array([(s["lo"], s["hi"]) for s in spans.as_py()], np.int64).clip(0, len(data))
                at = at[np.argsort(at[:, 0], kind="stable")]
                end = np.maximum.accumulate(at[:, 1])
                new = np.flatnonzero(np.concatenate(([True], at[1:, 0] > end[:-1])))
                low, high = at[new, 0], end[np.append(new[1:], len(end)) - 1]
                kept = b"".join(data[a:b] for a, b in zip(np.append(0, high), np.append(low, len(data)), strict=True))
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(new))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            if with_text:
                out["kept"] = pa.array(kept_texts, pa.binary())
            yield pa.RecordBatch.from_pydict(out)
    return run


def remove_repeats(docs: DataFrame, least: int = 400, with_text: bool = False, passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on demand, the kept bytes and n_shared_words.

    Each byte goes that a string of `least` bytes covers which also starts anywhere
    else, in this or another text; copies all count as elsewhere, no first one is
    spared. Matches never cross texts. least: 384 or more.

    passage: n_shared_words counts the words that runs of this many words cover which also stand in another
    document, however few bytes they have; it removes nothing. Documents differ by id or text.

    Null text: as empty. Null doc_id: kept. Repeated rows: copies of one another,
    a result each. Empty table: no rows. Other columns are not read.
    """
    if least < WINDOW + SECOND:
        raise ValueError(f"least must be at least {WINDOW + SECOND}")
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    whole = docs.select("doc_id", key.alias("k"), raw.alias("text"))
    shared = shared_words(whole.select("k", "text"), passage) if passage else None
    texts, spans = repeat_spans(whole.select("k", "text"), least)
    columns = "k long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    cut = texts.select("k", "text").join(spans, "k").mapInArrow(_cut(with_text), columns).dropDuplicates(["k"])
    base = whole.select("doc_id", "k", F.length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"), *["text"] * with_text)
    more = []
    if shared is not None:
        base = base.join(shared, "k", "left")
        more = [F.coalesce("n_words", F.lit(0)).cast("long").alias("n_shared_words")]
    return base.join(cut, "k", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *([F.coalesce("kept", "text").alias("kept")] if with_text else []), *more)
