"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged

#: Permitted sequence lengths in tokens.
CAPACITIES = (512, 1024, 2048, 4096)


def sequence_cost(capacity: float, fixed: float = 64.0, square: float = 16384.0) -> float:
    """What a sequence costs to train on: a fixed part, its tokens, its attention."""
    return fixed + capacity + capacity * capacity / square


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, capacity of the bin) of each piece. Longest first, a piece goes
    to the open bin that it fills best. Where none has room, the capacity of least
    cost per token is opened among those that hold the piece; the room beside it
    counts as used as far as there are tokens left to place. In the end each bin
    shrinks to the least permitted length that holds its contents."""
    sizes = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    left = int(lengths.sum())
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    for i in order:
        n = int(lengths[i])
        left -= n
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        else:
            fits = [c for c in sizes if c >= n]
            room = min(fits, key=lambda c: (sequence_cost(c) / (n + min(c - n, left)), c))
            b = len(used)
            used.append(0)
        where[i], offset[i] = b, used[b]
        used[b] += n
        room -= n
        if room:
            held = by_room.setdefault(room, [])
            if not held:
                insort(rooms, room)
            held.append(b)
    final = np.array(sizes)[np.searchsorted(sizes, used)] if used else np.zeros(0, np.int64)
    return where, offset, final[where] if len(where) else np.zeros(0, np.int64)


def token_count(text) -> F.Column:
    """Words between white space, and one end token."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \t\n\x0b\f\r]+")
    return (F.size(F.filter(parts, lambda w: w != "")) + 1).cast("int")


def pack_documents(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, group_tokens: int = 1 << 23) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, bin_id, offset, capacity, used.

    Documents longer than the largest capacity are cut into pieces of that length
    and a rest; all others are one piece; no token is lost. Pieces are dealt by
    row number into groups of about `group_tokens`, packed one group to a task, so
    a task's work is bounded and only the last bins of a group stay part empty.

    Null or empty text: one end token. Null doc_id: kept. Repeated rows: packed
    each. Empty table: no rows. Other columns are not read.
    """
    top = max(capacities)
    rows = docs.select("doc_id", token_count(F.col("text")).alias("n"), F.monotonically_increasing_id().alias("rid"))
    pieces = staged(rows.select(
        "doc_id", "rid", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / top).cast("int"))).alias("piece"))
        .select("doc_id", "rid", "piece", (F.col("piece") * top).alias("start"),
                F.least(F.lit(top), F.col("n") - F.col("piece") * top).alias("length")), "pieces")
    total = int(pieces.agg(F.sum(F.col("length").cast("long"))).first()[0] or 0)
    groups = max(1, -(-total // group_tokens))
    kind = dict(docs.dtypes)["doc_id"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["rid", "piece"], kind="stable").reset_index(drop=True)
        where, offset, capacity = pack(frame["length"].to_numpy(np.int64), capacities)
        used = np.bincount(where, frame["length"])
        return pd.DataFrame({
            "doc_id": frame["doc_id"], "piece": frame["piece"], "start": frame["start"], "length": frame["length"],
            "bin_id": frame["g"].astype(np.int64) * (1 << 32) + where, "offset": offset, "capacity": capacity, "used": used[where].astype(np.int64)})

    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("rid", "piece"), F.lit(groups)).cast("int"))
    return dealt.groupBy("g").applyInPandas(
        run, f"doc_id {kind}, piece int, start int, length int, bin_id long, offset int, capacity int, used int")
