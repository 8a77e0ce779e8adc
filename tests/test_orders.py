"""Unit-root statistics and the stepwise order search on series of known orders."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from storecast.operators import seasonal
from storecast.operators.seasonal import SeasonalParams, _choose_differences, _rank_orders, kpss_level, seasonal_strength

QUARTERS = SeasonalParams(seasonal_period=4)


def made(d, D, seed, n=240, m=4):
    """A series that is stationary after `d` plain and `D` seasonal differences."""
    rng = np.random.default_rng(seed)
    y = rng.normal(0, 1, n)
    for _ in range(D):
        # Integrated by season around large seasonal means.
        out = np.concatenate([rng.normal(0, 60, m), np.zeros(n)])
        for t in range(n):
            out[t + m] = out[t] + 0.2 * y[t]
        y = out[m:]
    for _ in range(d):
        y = np.cumsum(y)
    return y


def plain_kpss(y):
    n, mean = len(y), sum(y) / len(y)
    e = [v - mean for v in y]
    lags = int(4 * (n / 100) ** 0.25)
    spread = sum(v * v for v in e) / n
    for j in range(1, lags + 1):
        spread += 2 / n * (1 - j / (lags + 1)) * sum(e[t] * e[t - j] for t in range(j, n))
    total, s = 0.0, 0.0
    for v in e:
        s += v
        total += s * s
    return total / (n * n * spread)


def test_kpss_is_its_definition():
    for seed in range(5):
        y = made(seed % 3, 0, seed, n=60 + 37 * seed)
        assert kpss_level(y) == pytest.approx(plain_kpss(list(y)))
    assert kpss_level(np.zeros(0)) == kpss_level(np.full(9, 3.0)) == 0.0


def test_strength_of_seasons():
    rng = np.random.default_rng(1)
    cycle = np.tile([1.0, 5.0, -2.0, 0.0], 60)
    assert seasonal_strength(cycle, 4) == pytest.approx(1.0)
    assert seasonal_strength(cycle + np.arange(240) * 0.7, 4) == pytest.approx(1.0)  # a trend is no season
    assert seasonal_strength(np.arange(240.0), 4) == 0.0
    assert seasonal_strength(rng.normal(0, 1, 7), 4) == 0.0  # too short
    noise = [seasonal_strength(rng.normal(0, 1, 52 * 3 + 10), 52) for _ in range(40)]
    assert max(noise) < 0.64 and np.mean(noise) < 0.25  # few seasons of noise do not look like one


@pytest.mark.parametrize("d,D", [(0, 0), (1, 0), (2, 0), (0, 1)])
def test_known_differences(d, D):
    right = [_choose_differences(made(d, D, seed), QUARTERS) == (d, D) for seed in range(30)]
    assert np.mean(right) >= 0.8


def test_a_trend_needs_one_difference_and_limits_hold():
    rng = np.random.default_rng(3)
    assert _choose_differences(np.arange(200) * 0.5 + rng.normal(0, 1, 200), QUARTERS) == (1, 0)
    walk = made(2, 1, 5)
    assert _choose_differences(walk, SeasonalParams(seasonal_period=4, max_d=1, max_D=0))[0] == 1
    assert _choose_differences(np.arange(8.0), QUARTERS) == (0, 0)


def test_steps_find_what_the_grid_finds():
    rng = np.random.default_rng(4)
    same, tried = [], []
    for seed in range(20):
        e = rng.normal(0, 1, 300)
        y = np.zeros(300)
        for t in range(2, 300):
            y[t] = 0.6 * y[t - 1] - 0.3 * y[t - 2] * (seed % 2) + e[t] + 0.5 * e[t - 1] * (seed % 3 == 0)
        steps, start = _rank_orders(y, QUARTERS)
        grid, at = _rank_orders(y, SeasonalParams(seasonal_period=4, stepwise=False))
        assert start == at and len(grid) == 36
        known = {r[0]: r[3] for r in grid}
        assert all(known[r[0]] == r[3] for r in steps)
        best = min(steps, key=lambda r: (r[3], r[0]))
        # No neighbour of the order found is better.
        assert all(known[o] >= best[3] for o in seasonal._steps(best[0]) if o in known)
        same.append(best[3] <= min(known.values()) + 2)
        tried.append(len(steps))
    assert np.mean(same) >= 0.8 and max(tried) < 30 and np.mean(tried) < 22


def test_statistics_of_each_series(spark):
    start = dt.date(2010, 1, 1)
    rows = [(s, start + dt.timedelta(days=7 * t), float(v)) for s, y in
            {1: made(0, 0, 1), 2: made(1, 0, 2), 3: made(0, 1, 3), 4: np.zeros(3)}.items() for t, v in enumerate(y)]
    df = spark.createDataFrame(rows, "Store int, Date date, y double").repartition(5)
    got = {r["Store"]: r for r in seasonal.unit_root_statistics(df, by=["Store"], config=QUARTERS).collect()}
    assert {s: (r["d"], r["sd"]) for s, r in got.items()} == {1: (0, 0), 2: (1, 0), 3: (0, 1), 4: (0, 0)}
    assert got[2]["kpss"] == pytest.approx(plain_kpss(list(made(1, 0, 2)))) and got[4]["n"] == 3
    orders = {r["Store"]: r for r in seasonal.best_orders(seasonal.search_orders(df, by=["Store"], config=QUARTERS), by=["Store"]).collect()}
    assert all((orders[s]["d"], orders[s]["sd"]) == (got[s]["d"], got[s]["sd"]) for s in (1, 2, 3))
    assert seasonal.unit_root_statistics(df.limit(0), by=["Store"]).count() == 0
