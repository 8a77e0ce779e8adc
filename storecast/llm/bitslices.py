"""Exact top-k inner products over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged

#: Vectors with a quantised component of this size or more are wide: they are held
#: in 8 bytes instead of 4 and lie in blocks of their own, which have more slices.
WIDE = 1 << 24


def slice_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slices, lows) of an integer block [rows, dims]: slices[d, s] is the bitmap
    over rows of bit s of value - lows[d]; one word holds 64 rows."""
    rows, dims = values.shape
    lows = values.min(axis=0)
    offset = (values - lows).astype(np.uint64)
    width = max(1, int(offset.max()).bit_length()) if offset.size else 1
    packed = np.zeros((dims, width, -(-rows // 64) * 8), np.uint8)
    for s in range(width):
        bits = ((offset >> np.uint64(s)) & np.uint64(1)).astype(bool).T
        packed[:, s, :-(-rows // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return packed.view(np.uint64), lows


def sliced_scores(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Bit slices [queries, words], least significant first, of the sums of
    |q_d| * u_d, with u_d complemented where q_d is negative: the inner product
    plus a constant of the query. Addends of equal weight go through full adders
    three at a time, by bitmap arithmetic alone."""
    dims, width, n_words = slices.shape
    size = np.abs(query).astype(np.uint64)
    flip = np.where(query < 0, ~np.uint64(0), np.uint64(0))
    bits = max(1, int(size.max()).bit_length()) if size.size else 1
    top = width + bits + dims.bit_length() + 1
    held: list[list[np.ndarray]] = [[] for _ in range(top + 1)]

    def add(weight: int, addend: np.ndarray) -> None:
        while True:
            column = held[weight]
            column.append(addend)
            if len(column) < 3:
                return
            c, b, a = column.pop(), column.pop(), column.pop()
            either = a ^ b
            column.append(either ^ c)
            np.bitwise_and(either, c, out=either)
            np.bitwise_and(a, b, out=a)
            np.bitwise_or(a, either, out=a)
            weight, addend = weight + 1, a

    for d in range(dims):
        for s in range(width):
            row = slices[d, s][None, :] ^ flip[:, d][:, None]
            for b in range(bits):
                on = (size[:, d] >> np.uint64(b)) & np.uint64(1)
                if on.any():
                    add(s + b, row & (np.uint64(0) - on)[:, None])
    out = []
    carry = np.zeros((len(query), n_words), np.uint64)
    for weight in range(top + 1):  # at most two addends and a carry are left in a column
        total, over = carry, np.zeros_like(carry)
        for x in held[weight]:
            over ^= total & x  # two carries never fall together: a + b + c <= 3
            total = total ^ x
        out.append(total)
        carry = over
    return out


def select_rows(score: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """[queries, rows] marks: of each query's allowed rows every one above the boundary
    and every one on it, found from the most significant slice downward; all where
    there are no more than k."""
    n_queries, rows = allowed.shape
    packed = np.zeros((n_queries, score[0].shape[1] * 8), np.uint8)
    packed[:, :-(-rows // 8)] = np.packbits(allowed, axis=1, bitorder="little")
    equal = packed.view(np.uint64)
    sure = np.zeros_like(equal)
    for bits in reversed(score):
        ones = equal & bits
        count = np.bitwise_count(sure | ones).sum(axis=1)[:, None]
        equal, sure = (np.where(count >= k, ones, equal & ~bits),
                       np.where(count >= k, sure, sure | ones))
    marked = np.unpackbits((sure | equal).view(np.uint8), axis=1, bitorder="little")
    return marked[:, :rows].astype(bool)


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs of rows. Sums wrap around at 64 bits, so one that
    fits is right whatever its addends; one that does not is an error, as in SQL."""
    out = np.einsum("ij,ij->i", left, right)
    if left.size and np.abs(left.astype(float)).max() * np.abs(right.astype(float)).max() * left.shape[1] >= 2.0**62:
        rough = np.einsum("ij,ij->i", np.abs(left.astype(float)), np.abs(right.astype(float)))
        for i in np.flatnonzero(rough >= 2.0**62):
            if sum(a * b for a, b in zip(left[i].tolist(), right[i].tolist(), strict=True)) != int(out[i]):
                raise OverflowError("an inner product does not fit 64 bits")
    return out


def top_rows(ids: np.ndarray, values: np.ndarray, slices: np.ndarray, query_ids: np.ndarray,
             queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, exact score) of each query's k best rows in a block; rows
    with the query's own id are masked out before the selection."""
    marks = select_rows(sliced_scores(slices, queries), query_ids[:, None] != ids[None, :], k)
    q, r = np.nonzero(marks)
    exact = inner(queries[q], values[r])
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    first = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - first < k
    return query_ids[q[keep]], ids[r[keep]], exact[keep]


def _blocks(size: int, sliced: bool):
    """Packs the vectors of a task into blocks of at most `size` rows of one length, wide or not."""
    def pack(frames):
        import numpy as np
        held: dict[tuple[int, bool], list] = {}

        def block(kind):
            part, (dims, wide) = held.pop(kind), kind
            ids = np.array([i for i, _ in part], np.int64)
            values = np.array([v for _, v in part], np.int64).reshape(len(part), dims)
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], values[order]
            slices, _ = slice_block(values) if sliced and dims else (np.zeros(0, np.uint64), None)
            return pd.DataFrame({"dims": [dims], "n": [len(ids)], "ids": [ids.tobytes()],
                                 "vals": [values.astype(np.int64 if wide else np.int32).tobytes()], "bits": [slices.tobytes()]})

        for frame in frames:
            for i, v in zip(frame["vec_id"], frame["q"], strict=True):
                kind = len(v), any(x >= WIDE or x <= -WIDE for x in v)
                held.setdefault(kind, []).append((i, v))
                if len(held[kind]) == size:
                    yield block(kind)
        for kind in list(held):
            yield block(kind)
    return pack


def _unpacked(vals: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(vals, np.int64 if len(vals) == 8 * n * dims else np.int32).astype(np.int64).reshape(n, dims)


BLOCK = "dims int, n int, ids binary, vals binary, bits binary"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, rows_per_block: int = 8192,
          queries_per_block: int = 256, scale: float = 64.0) -> DataFrame:
    """Each query's k best rows by the inner product of floor(scale * x): query_id,
    rank, vec_id, score; ties to the smaller vec_id; a query's own id is left out.

    Both inputs have vec_id and embedding. The index is a table of row blocks,
    each with its bit slices; blocks of queries meet each block once, and only k
    rows of a query leave a block. Work is queries x rows by contract; memory of
    a task is one block of each side.

    Null vectors, null or non-finite components, components that are no 64-bit integer
    after scaling, and null ids take no part. A score among a block's best that does
    not fit 64 bits is an error. Vectors of different lengths are
    not compared; empty ones score 0. A repeated row is a candidate each time and one query.
    """

    def quantised(df):
        whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)))
        bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * F.lit(scale)) >= F.lit(2.0**63)))
        return df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
            F.col("vec_id").cast("long").alias("vec_id"), whole.alias("q"))

    rows, asked = quantised(vectors), quantised(queries).dropDuplicates(["vec_id", "q"])
    n = rows.count()
    parts = max(1, min(-(-n // 1024), max(-(-n // rows_per_block), 6)))
    index = staged(rows.repartition(parts, F.xxhash64("vec_id", F.monotonically_increasing_id()))
                   .mapInPandas(_blocks(rows_per_block, True), BLOCK), "bitslices")
    questions = staged(asked.coalesce(max(1, n // 1_000_000)).mapInPandas(_blocks(queries_per_block, False), BLOCK)
                       .withColumn("qb", F.monotonically_increasing_id()), "queries")
    numbers = questions.select("dims", "qb")  # a row for each block of queries
    pairs = (index.join(numbers, "dims")
             .join(questions.select("qb", F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("vals").alias("qvals")), "qb")
             .repartition(max(12, parts), F.xxhash64("qb", "ids")))

    def meet(frames):
        import numpy as np
        for frame in frames:
            for r in frame.itertuples():
                ids, qids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.qids, np.int64)
                values, query = _unpacked(r.vals, r.n, r.dims), _unpacked(r.qvals, r.qn, r.dims)
                words = -(-r.n // 64)
                bits = np.frombuffer(r.bits, np.uint64)
                slices = bits.reshape(r.dims, -1, words) if r.dims else np.zeros((0, 1, words), np.uint64)
                for at in range(0, r.qn, 64):
                    found = top_rows(ids, values, slices, qids[at:at + 64], query[at:at + 64], k)
                    yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    found = pairs.mapInPandas(meet, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
