"""Closed itemsets against all subsets of small baskets."""

from __future__ import annotations

import itertools
import random

import pytest

from storecast.operators import closed, itemwalk, rules

SCHEMA = "Store int, Date int, Dept int"


def frame(spark, baskets):
    rows = [(1, k, i) for k, b in enumerate(baskets) for i in b]
    rows += [(1, None, 3), (None, 2, 3), (2, 5, None), *rows[:5]]  # missing keys, repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def plain(baskets, share):
    """{itemset: count} of frequent ones, and the closed among them."""
    baskets = [frozenset(map(str, b)) for b in baskets if b]
    least = rules._least_count(share, len(baskets))
    items = sorted(set().union(*baskets))
    counts = {}
    for size in range(1, len(items) + 1):
        for s in itertools.combinations(items, size):
            n = sum(frozenset(s) <= b for b in baskets)
            if n >= least:
                counts[s] = n
    shut = {s: n for s, n in counts.items()
            if not any(counts.get(tuple(sorted({*s, x}))) == n for x in items if x not in s)}
    return counts, shut, len(baskets)


def dense(seed, n_items, n):
    rng = random.Random(seed)
    return [[i for i in range(n_items) if rng.random() < 0.75] for _ in range(n)] * 2


@pytest.mark.parametrize("engine", ["bitmaps", "filter"])
@pytest.mark.parametrize("baskets,share", [(dense(1, 8, 30), 0.1), (dense(2, 6, 7), 0.011), ([[1, 2, 3]] * 4, 0.5),
                                           ([[1], [2], [3]], 0.9), ([[7]], 1.0)])
def test_closed_itemsets(spark, baskets, share, engine, monkeypatch):
    monkeypatch.setattr(itemwalk, "BUDGET", 5)  # several rounds
    got = closed.closed_itemsets(frame(spark, baskets), min_support=share, engine=engine).collect()
    _, shut, n = plain(baskets, share)
    assert {tuple(r["items"]): r["n"] for r in got} == shut and len(got) == len(shut)
    assert all(r["size"] == len(r["items"]) and abs(r["support"] - r["n"] / n) < 1e-12 for r in got)


def test_all_counts_and_rules_follow(spark):
    baskets = dense(3, 7, 25)
    counts, shut, n = plain(baskets, 0.1)
    table = closed.closed_itemsets(frame(spark, baskets), min_support=0.1).persist()
    asked = spark.createDataFrame([(list(s),) for s in counts] + [(["0", "99"],)], "items array<string>")
    got = {tuple(r["items"]): r["n"] for r in closed.supports_of(asked, table).collect()}
    assert got == {**counts, ("0", "99"): None}
    rows = closed.closed_rules(table, min_confidence=0.7, min_lift=1.0).collect()
    want = {}
    for s, k in shut.items():
        for c in s if len(s) > 1 else ():
            a = tuple(x for x in s if x != c)
            conf, lift = k / counts[a], k / counts[a] / (counts[(c,)] / n)
            if conf >= 0.7 and lift >= 1.0:
                want[a, (c,)] = (k / n, conf, lift)
    assert {(tuple(r[0]), tuple(r[1])): pytest.approx(tuple(r[2:])) for r in rows} == want and want


@pytest.mark.parametrize("most", [1, 3, None])
def test_walked_itemsets_are_all_frequent_ones(spark, most, monkeypatch):
    monkeypatch.setattr(itemwalk, "BUDGET", 7)
    baskets = dense(5, 7, 20)
    counts, _, _ = plain(baskets, 0.2)
    got = rules.frequent_itemsets(frame(spark, baskets), min_support=0.2, max_len=most, engine="bitmaps").collect()
    assert {tuple(r["items"]): r["n"] for r in got} == {s: n for s, n in counts.items() if most is None or len(s) <= most}
    assert len(got) == len({tuple(r["items"]) for r in got})


def test_no_baskets(spark):
    assert closed.closed_itemsets(frame(spark, [[1]]).limit(0)).count() == 0
    with pytest.raises(ValueError, match="engine"):
        closed.closed_itemsets(frame(spark, [[1]]), engine="guess")
