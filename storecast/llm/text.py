"""Vectorised text helpers for Arrow batches: slices, words and fingerprints.

Texts are handled as UTF-8 bytes in bounded slices, so a task's memory follows
the longest single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 15
_MULT = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII capitals to small letters; other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters and digits; every byte of a non-ASCII character counts as one.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about `limit` bytes;
    null is empty. A longer text comes alone and whole."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = pc.fill_null(column.cast(pa.large_string()).cast(pa.large_binary()), b"")
    n = len(arr)
    if not n:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(i + SLICE_ROWS, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def code_points(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets in code points) of UTF-8 texts; bytes that are not UTF-8
    become U+FFFD."""
    try:
        text = data.tobytes().decode("utf-8")
    except UnicodeDecodeError:  # one text after another
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)]
        return (np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32),
                np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64))
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), leads[offs]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _grown(kind: str, base: int, n: int) -> np.ndarray:
    """Powers of `base` modulo 2**64, at least n + 1 of them."""
    have = _powers.get(kind)
    if have is None or len(have) <= n:
        size = max(n + 1, SLICE_BYTES + 2)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 23:  # a very long text's table is not kept
            _powers[kind] = have
    return have


class Prints:
    """Fingerprints of any ranges of an array of bytes or of 64-bit names, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.back = _grown("back", pow(_MULT, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_TABLE[data] if data.dtype == np.uint8 else data) * _grown("forth", _MULT, n)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit names: equal bytes, equal names."""
        size = (np.asarray(end) - np.asarray(start)).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + size)


def slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i : i + width] for every i; `width` is a power of two. Shorter by width - 1."""
    step = 1
    while step < width:
        x = op(x[:-step], x[step:])
        step *= 2
    return x


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the maximal runs of bytes that `inside` marks; no
    run crosses the border of a document."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    on = inside[data]
    before, after = np.zeros(len(on), bool), np.zeros(len(on), bool)
    before[1:], after[:-1] = on[:-1], on[1:]
    cut = offs[(offs > 0) & (offs < len(data))]
    before[cut], after[cut - 1] = False, False
    start, end = np.flatnonzero(on & ~before), np.flatnonzero(on & ~after) + 1
    return np.searchsorted(offs, start, "right") - 1, start, end


def hashed_words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, name of the word in small letters) in text order."""
    doc, start, end = words(data, offs, inside)
    return doc, Prints(LOWER[data]).of(start, end)


def grams(doc: np.ndarray, name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, index of the first word, name) of each run of n words of a document."""
    if len(name) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(len(name) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(3) + name[k:len(name) - n + 1 + k])
    keep = np.flatnonzero(doc[:len(out)] == doc[n - 1:])
    return doc[keep], keep, out[keep]


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of each run of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return first, np.diff(np.append(first, len(keys)))



def bit_table(rows, column: str, bits: int = 24):
    """A broadcast of fixed size, 2**bits bits, that marks the upper bits of the names
    in a long column. Names that are not marked do not occur. Made in pieces of 4 KB."""
    def piece(frame: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << 15, bool)
        marks[frame["s"].to_numpy() & 0x7FFF] = True
        return pd.DataFrame({"c": [int(frame["s"].iloc[0]) >> 15], "b": [np.packbits(marks, bitorder="little").tobytes()]})

    spots = rows.select(F.shiftrightunsigned(column, 64 - bits).cast("int").alias("s")).distinct()
    table = np.zeros(1 << (bits - 3), np.uint8)
    for row in spots.groupBy(F.shiftright("s", 15)).applyInPandas(piece, "c int, b binary").toLocalIterator():
        table[row["c"] << 12:(row["c"] + 1) << 12] = np.frombuffer(row["b"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(table.tobytes())


def marked(table: bytes, names: np.ndarray) -> np.ndarray:
    spot = (names >> np.uint64(62 - len(table).bit_length())).astype(np.int64)
    return (np.frombuffer(table, np.uint8)[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1
