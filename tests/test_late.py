"""Late rows taken into lag and z-scores against a rebuild."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from storecast import schemas
from storecast.operators import anomaly, features, late
from storecast.operators.ordered import CHUNK

KEY = ["Store", "Dept", "Date"]


def made(seed=1):
    rng = random.Random(seed)
    rows = []
    for store in range(3):
        for dept in range(4):
            for w in range(rng.choice([1, 3, 60, 170])):
                if rng.random() < 0.9:
                    value = None if rng.random() < 0.05 else 1e6 * (store == 2) + rng.choice([10.0, 12.0, 11.5, 400.0])
                    rows.append((store, dept, dt.date(2010, 2, 5) + dt.timedelta(7 * w), value, False))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.SALES).repartition(3)


def same(got, rows):
    """Row by row equal to lag and flags made from all rows at once."""
    want = features.add_sales_lag(anomaly.flag_anomalies(rows), unique=True)
    left = {tuple(r[k] for k in KEY): r for r in got.collect()}
    right = {tuple(r[k] for k in KEY): r for r in want.collect()}
    assert set(left) == set(right) and len(left) == got.count()
    for k, w in right.items():
        g = left[k]
        assert (g["Weekly_Sales"], g["Sales_Lag_1"], g["Is_Anomaly"]) == (w["Weekly_Sales"], w["Sales_Lag_1"], w["Is_Anomaly"]), k
        assert g["Sales_ZScore"] == (None if w["Sales_ZScore"] is None else pytest.approx(w["Sales_ZScore"], abs=1e-6)), k


def test_start_equals_the_plain_operators(spark):
    rows = frame(spark, made())
    got, states = late.start(rows)
    same(late.flagged(got, states), rows)


@pytest.mark.parametrize("pick", ["last weeks", "scattered", "a new series", "corrections"])
def test_state_and_late_rows_equal_a_rebuild(spark, pick):
    rng, every = random.Random(4), made(2)
    if pick == "last weeks":
        coming = [r for r in every if r[2] >= dt.date(2012, 12, 1)]
    elif pick == "scattered":
        coming = [r for r in every if rng.random() < 0.05]
    elif pick == "a new series":
        coming = [r for r in every if r[:2] in ((1, 1), (2, 3))]
    else:
        coming = [(*r[:3], 77.0, True) for r in every if rng.random() < 0.03]
    keys = {r[:3] for r in coming}
    before = every if pick == "corrections" else [r for r in every if r[:3] not in keys]
    rows, states = (t.persist() for t in late.start(frame(spark, before)))
    changed, replaced, now = late.absorb(rows, states, frame(spark, coming))
    final = [r for r in before if r[:3] not in keys] + coming
    whole = late.replace_chunks(rows, changed, replaced)
    same(late.flagged(whole, now), frame(spark, final))
    # Only the touched chunks and the next of each series are read again.
    spots = {(r["Store"], r["Dept"], r[CHUNK]) for r in replaced.collect()}
    assert {(s, d, t.year) for s, d, t in keys} <= spots and len(spots) <= 2 * len({(s, d, t.year) for s, d, t in keys})
    assert changed.count() == sum((r[0], r[1], r[2].year) in spots for r in final)


def test_nothing_late(spark):
    rows, states = late.start(frame(spark, made(3)))
    changed, replaced, now = late.absorb(rows, states, frame(spark, made(3)).limit(0))
    assert changed.count() == replaced.count() == 0 and now.count() == states.count()
