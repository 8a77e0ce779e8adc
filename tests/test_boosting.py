"""Boosted rounds against plain sums of their trees; runs that stop and go on."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from storecast.operators import boosting
from storecast.operators.boosting import LABEL, SO_FAR, VALID, BoostParams, BoostState, boost

N = 6
PARAMS = BoostParams(rounds=10, depth=3, rate=0.3, patience=0, block=4, columns=0.5)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(1500):
        x = [rng.uniform(-1, 1) for _ in range(N)]
        data.append((*x, 3 * x[0] + (2 if x[1] > 0 else -1) * x[2] + rng.gauss(0, 0.05), i % 5 == 0))
    df = spark.createDataFrame(data, [*(f"x{i}" for i in range(N)), LABEL, VALID])
    ready = VectorAssembler(inputCols=[f"x{i}" for i in range(N)], outputCol="v").transform(df)
    return ready.select("v", LABEL, VALID).repartition(3, LABEL).persist()


def values(errors):
    return [tuple(r) for r in errors.orderBy("round").collect()]


@pytest.fixture(scope="module")
def grown(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grown"))
    model, errors = boost(rows, path, PARAMS, features="v", size=N)
    return path, model, values(errors)


def test_rounds_are_sums_of_trees(spark, rows, grown):
    path, model, errors = grown
    assert [r[0] for r in errors] == list(range(11)) and model.getNumTrees == 11
    assert all((r[1], r[3]) == (1200, 300) for r in errors)
    table = [(r["v"], r[LABEL], r[VALID]) for r in rows.collect()]
    sums = [0.0] * len(table)
    for k, tree in enumerate(model.trees):
        sums = [s + (1.0 if k == 0 else 0.3) * tree.predict(v) for s, (v, _, _) in zip(sums, table)]
        for column, valid in ((2, False), (4, True)):
            miss = [(y - s) ** 2 for s, (_, y, f) in zip(sums, table) if f == valid]
            assert math.isclose(errors[k][column], sum(miss) / len(miss), rel_tol=1e-9)
    assert errors[10][4] < errors[0][4] / 4  # the mean alone at first
    carried = sorted(r[SO_FAR] for r in BoostState(spark, path).rows(10).collect())
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(carried, sorted(sums)))
    apart = boosting.carried_difference(BoostState(spark, path), 10, "v").first()
    assert tuple(apart) == (1500, 1200, 10, 0)


def test_a_tree_sees_its_own_columns(grown):
    used = []
    for tree in grown[1].trees[1:]:
        importances = tree.featureImportances
        used.append({int(i) for i in importances.indices})
        assert len(used[-1]) <= 3 and tree.depth <= 3
    assert len({frozenset(u) for u in used}) > 1 and set().union(*used) > {0, 1}


def test_an_interrupted_run_goes_on(spark, rows, grown, tmp_path, monkeypatch):
    """The run dies while it writes its second block; the next one starts after the first."""
    finish = boosting._finish

    def dies(state, done, trees, *rest):
        if done == 8:
            rest[3].select("v", LABEL, VALID, SO_FAR).limit(3).write.parquet(f"{state.folder(8)}/rows")
            raise RuntimeError("lost")
        finish(state, done, trees, *rest)

    monkeypatch.setattr(boosting, "_finish", dies)
    with pytest.raises(RuntimeError, match="lost"):
        boost(rows, str(tmp_path), PARAMS, features="v", size=N)
    monkeypatch.setattr(boosting, "_finish", finish)
    state = BoostState(spark, str(tmp_path))
    assert state.finished(4, 10) == 4 and state.rounds(4).count() == 5
    again, errors = boost(rows.limit(0), str(tmp_path), PARAMS, features="v", size=N)
    whole = grown[2]
    assert [r[0] for r in values(errors)] == [r[0] for r in whole] and again.getNumTrees == 11
    assert all(math.isclose(a[2], b[2], rel_tol=0.2) for a, b in zip(values(errors), whole))
    assert boosting.carried_difference(state, 10, "v").first()["n_apart"] == 0
    # A finished run is not grown on.
    assert values(boost(rows.limit(0), str(tmp_path), PARAMS, features="v", size=N)[1]) == values(errors)


def test_patience_cuts_without_a_refit(rows, tmp_path):
    greedy = BoostParams(rounds=60, depth=5, rate=1.0, patience=3, block=4)
    model, errors = boost(rows, str(tmp_path), greedy, features="v", size=N)
    valid = [r[4] for r in values(errors)[1:]]
    best, stalled = boosting.first_stall(valid, 3)
    assert stalled and model.getNumTrees == best + 1 and best <= len(valid) < 60
    assert len(valid) - (best + 3) < 4  # at most a block too many
    assert boosting.first_stall([5, 4, 4.5, 4.2, 3], 2) == (2, True)
    assert boosting.first_stall([5, 4, 4.5, 3], 2) == (4, False)
    assert boosting.first_stall([3, 2, 1], 5) == (3, False)


def test_no_validation_rows_grow_all(rows, tmp_path):
    few = BoostParams(rounds=3, depth=2, patience=2, block=2)
    model, errors = boost(rows.withColumn(VALID, F.lit(False)), str(tmp_path), few, features="v", size=N)
    assert model.getNumTrees == 4 and [r[4] for r in values(errors)] == [None] * 4
