"""A walk over the itemsets of weighted baskets, by a bitmap of baskets for each item.

Equal baskets are one bit with a weight, whose binary digits are bitmaps too, so a count is a
few ANDs. Tasks walk the tree of itemsets, and hand on what a round leaves open.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Bits of the basket bitmaps that may be broadcast, and itemsets a task visits a round.
BITMAP_BITS, BUDGET = 1 << 30, 1 << 16
_FOUND = "items array<int>, named array<string>, n bigint, core int, done boolean"


def bitmaps(distinct: DataFrame) -> tuple[list[str], list[int], list[int], int]:
    """(items by name, a bitmap of baskets for each, bitmaps of the weights' binary digits,
    number of bits, padding included). Each task packs its own baskets; their pieces follow one another."""
    def packed(frames):
        for frame in frames:
            bits: dict[str, int] = {}
            for k, (items, w) in enumerate(zip(frame["items"], frame["w"], strict=True)):
                for mark in (*items, *(f"\0{b}" for b in range(int(w).bit_length()) if w >> b & 1)):
                    bits[mark] = bits.get(mark, 0) | 1 << k
            size = -(-len(frame) // 8)
            yield pd.DataFrame([(len(frame), list(bits), [v.to_bytes(size, "little") for v in bits.values()])],
                               columns=["n", "marks", "bits"])

    whole: dict[str, list[tuple[int, bytes]]] = {}
    n_bits = 0
    for r in distinct.mapInPandas(packed, "n int, marks array<string>, bits array<binary>").toLocalIterator():
        for mark, piece in zip(r["marks"], r["bits"], strict=True):
            whole.setdefault(mark, []).append((n_bits, piece))
        n_bits += -(-r["n"] // 8) * 8

    def number(mark: str) -> int:
        out = bytearray(n_bits // 8)
        for at, piece in whole.get(mark, ()):
            out[at // 8:at // 8 + len(piece)] = piece
        return int.from_bytes(out, "little")

    items = sorted(m for m in whole if not m.startswith("\0"))
    digits = 1 + max((int(m[1:]) for m in whole if m.startswith("\0")), default=-1)
    return items, [number(i) for i in items], [number(f"\0{b}") for b in range(digits)], n_bits


def walk(todo: list[tuple[frozenset, int]], maps: list[int], slices: list[int], every: int, least: int,
         budget: int, closed: bool, most: int | None):
    """(itemset, n, core, done) from the branches in `todo`, depth first; closed itemsets only, or
    all of at most `most` items. One branch leads to each: the extension by an item above
    the core, for closed ones if the closure adds nothing below that item. After `budget`
    itemsets the open branches come out with done = False."""
    seen = 0
    while todo:
        if seen >= budget:
            for items, core in todo:
                yield items, 0, core, False
            return
        items, core = todo.pop()
        baskets = reduce(lambda a, i: a & maps[i], items, every)
        yield items, sum((baskets & s).bit_count() << b for b, s in enumerate(slices)), core, True
        seen += 1
        if most is not None and len(items) >= most:
            continue
        for j in range(core + 1, len(maps)):
            if j in items:
                continue
            inside = baskets & maps[j]
            if sum((inside & s).bit_count() << b for b, s in enumerate(slices)) < least:
                continue
            if not closed:
                todo.append((items | {j}, j))
                continue
            closure = [k for k, m in enumerate(maps) if inside & m == inside]
            if all(k in items for k in closure if k < j):
                todo.append((frozenset(closure), j))


def fits(distinct: DataFrame) -> bool:
    """Whether the bitmaps of these baskets stay within BITMAP_BITS."""
    n, items = distinct.count(), distinct.select(F.explode("items").alias("i")).distinct().count()
    return n * items <= BITMAP_BITS


def walked(distinct: DataFrame, least: int, n_baskets: int, *, closed: bool, most: int | None = None) -> DataFrame:
    """(items, size, n, support) of the itemsets in at least `least` of the weighted baskets. Rounds over a table of open branches; what a round finds is written. A task that has
    visited its budget hands its open branches on, so no branch is one task's burden."""
    spark = distinct.sparkSession
    names, maps, slices, _ = bitmaps(distinct)
    every = reduce(lambda a, b: a | b, slices, 0)  # every basket has a weight
    known = spark.sparkContext.broadcast((names, maps, slices, every))

    columns = [c.split()[0] for c in _FOUND.split(", ")]

    def expand(budget: int):
        def run(frames):
            names, maps, slices, every = known.value
            todo = [(frozenset(map(int, s)), int(c)) for f in frames for s, c in zip(f["items"], f["core"])]
            rows = []
            for found, n, core, done in walk(todo, maps, slices, every, least, budget, closed, most):
                rows.append((sorted(found), sorted(names[i] for i in found) if done else None, n, core, done))
                if len(rows) == 10000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)
        return run

    root = [i for i, m in enumerate(maps) if m == every] if closed else []
    todo = spark.createDataFrame([(root, None, 0, -1, False)], _FOUND)
    found, budget, tasks = [], 1 << 10, 4 * spark.sparkContext.defaultParallelism
    while True:
        step = materialize(todo.select("items", "core").mapInPandas(expand(budget), _FOUND), "itemset-walk")
        found.append(step)
        n_open = step.where("not done").count()
        if not n_open:
            break
        todo = step.where("not done").repartition(min(tasks, n_open), F.xxhash64("items", "core"))
        budget = BUDGET
    every_set = reduce(DataFrame.unionByName, found).where("done and size(items) > 0")
    return every_set.select(F.col("named").alias("items"), F.size("items").alias("size"), "n",
                            (F.col("n") / n_baskets).alias("support"))
