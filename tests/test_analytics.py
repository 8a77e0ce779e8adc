"""Anomalies, exploration, metrics, segmentation, seasonal fits and rules."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import W1, W2, day, rows
from storecast import schemas
from storecast.operators import anomaly, explore, metrics, rules, seasonal, segment
from storecast.operators.features import engineer_features
from storecast.operators.master import build_master


# ---- anomalies and exploration -------------------------------------------

def spiky(spark):
    data = [(1, 1, day("2010-01-01"), 10.0 + i % 2, i == 40) for i in range(40)]
    return spark.createDataFrame(data + [(1, 1, W1, 500.0, True), (2, 2, W2, 1.0, False)],
                                 schemas.SALES)


def test_flags_are_strict_and_null_safe(spark):
    df = anomaly.flag_anomalies(spiky(spark))
    hit = df.where("Is_Anomaly").collect()
    assert len(hit) == 1 and hit[0]["Weekly_Sales"] == 500.0
    alone = df.where("Store = 2").first()
    assert alone["Sales_ZScore"] is None and alone["Is_Anomaly"] is False
    z = df.where("Is_Anomaly").first()["Sales_ZScore"]
    assert anomaly.flag_anomalies(spiky(spark), threshold=z).where("Is_Anomaly").count() == 0
    flat = spark.createDataFrame([(1, 1, W1, 5.0, False), (1, 1, W2, 5.0, False)], schemas.SALES)
    assert [r["Sales_ZScore"] for r in anomaly.flag_anomalies(flat).collect()] == [0.0, 0.0]


def test_fit_on_training_rows(spark):
    df = spiky(spark)
    got = anomaly.flag_anomalies(df, fit_on=df.where("Weekly_Sales < 100")).where("Is_Anomaly")
    assert got.first()["Sales_ZScore"] > 100


def test_summary_and_triage(spark):
    df = anomaly.flag_anomalies(spiky(spark))
    s = anomaly.anomaly_summary(df).first()
    assert tuple(s) == (1, pytest.approx(1 / 42), 1.0)
    assert tuple(anomaly.anomaly_summary(df.limit(0)).first()) == (0, 0.0, 0.0)
    verdicts = dict((r["Date"], r["verdict"]) for r in anomaly.anomaly_triage(df).collect())
    assert verdicts[W1] == "calendar_event" and verdicts[W2] == "none"


def test_drilldown_reads_one_series(spark):
    df = anomaly.flag_anomalies(spiky(spark))
    assert anomaly.anomaly_drilldown(df, entity=1, item=1, only_anomalies=True).count() == 1
    assert anomaly.anomaly_drilldown(df, entity=2, item=2).count() == 1


def test_exploration(spark, sales, stores, features):
    m = engineer_features(build_master(sales, stores, features))
    assert rows(explore.store_ranking(m), "Store") == [
        (1, pytest.approx(140 / 3)), (2, pytest.approx(100 / 3))]
    wide = explore.seasonality(m, wide=[2010]).where("Week = 5").first()
    assert wide["2010"] == pytest.approx(43.0)
    lift = explore.holiday_lift(m).where("Week = 6").first()
    assert lift["lift"] == pytest.approx(34 / 43)
    h = explore.histogram(m, ["Temperature", "CPI"], bins=2)
    assert sum(r["n"] for r in h.where("column_name = 'CPI'").collect()) == 6
    assert explore.histogram(m.withColumn("x", F.lit(3.0)), ["x"]).first()["n"] == 6
    assert explore.histogram(m.limit(0)).count() == 0
    prof = {r["column_name"]: r for r in explore.table_profile(m).collect()}
    assert prof["CPI"]["n_present"] == 6 and prof["Store"]["data_type"] == "int"
    assert explore.head(m, 2, order=["Store", "Dept", "Date"]).count() == 2


def test_histogram_leaves_out_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert sum(r["n"] for r in explore.histogram(df, ["x"]).collect()) == 2


# ---- metrics -------------------------------------------------------------

def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0), (None, 1.0)], "y double, f double")
    m = metrics.regression_metrics(df, actual="y", forecast="f").first()
    assert m["n"] == 3 and m["r2"] == pytest.approx(1 - 10 / 8)
    assert m["mae"] == pytest.approx(4 / 3) and m["rmse"] == pytest.approx(math.sqrt(10 / 3))
    assert m["mape"] == pytest.approx((1 + 0 + 0.6) / 3 * 100)
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, f double")
    assert metrics.regression_metrics(flat, actual="y", forecast="f").first()["r2"] == 1.0
    off = flat.withColumn("f", F.lit(3.0))
    assert metrics.regression_metrics(off, actual="y", forecast="f").first()["r2"] == 0.0


def test_forecast_errors_floor_and_null(spark):
    df = spark.createDataFrame([(0.5, 1.5), (10.0, 5.0), (None, 1.0)], "y double, f double")
    got = [r["abs_pct_error"] for r in metrics.forecast_errors(df, actual="y", forecast="f").collect()]
    assert got == [100.0, 50.0, None]


def test_compare_runs_without_the_metric(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, 5.0), ("c", 3, None), ("d", 4, 4.0)],
                               "run_id string, created_at int, rmse double")
    got = rows(metrics.compare_runs(df).select("run_id", "previous", "champion", "promote"), "run_id")
    assert got == [("a", None, None, False), ("b", None, None, True), ("c", 5.0, 5.0, False),
                   ("d", 5.0, 5.0, True)]


def test_compare_runs(spark):
    df = spark.createDataFrame([("a", "1", 5.0), ("b", "2", 6.0), ("c", "3", 4.0)],
                               "run_id string, created_at string, rmse double")
    got = rows(metrics.compare_runs(df).select("run_id", "previous", "champion", "promote"), "run_id")
    assert got == [("a", None, None, True), ("b", 5.0, 5.0, False), ("c", 6.0, 5.0, True)]


def test_macro_drift(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(100)], "CPI double")
    same = metrics.macro_drift(ref, ref, ["CPI"]).first()
    assert same["psi"] == pytest.approx(0.0) and same["ref_mean"] == same["cur_mean"]
    moved = metrics.macro_drift(ref, ref.selectExpr("CPI + 50 AS CPI"), ["CPI"]).first()
    assert moved["psi"] > 1


def test_quantile_drift(spark):
    """Against quantiles and shares counted one by one; merged sketches beyond k stay close."""
    rng = np.random.default_rng(5)
    old, new = rng.lognormal(0, 2, 3000), rng.lognormal(0.4, 2, 2000)
    data = [(int(i % 4), float(v)) for i, v in enumerate(old)] + [(4, float(v)) for v in new] + [(0, None), (4, float("nan"))]
    df = spark.createDataFrame(data, "period int, x double").withColumn("flat", F.lit(1.0))

    def got(k):
        table = metrics.value_sketches(df, ["x", "flat"], by=["period"], k=k)
        return {r["column_name"]: r for r in metrics.quantile_drift(table, F.col("period") < 4, F.col("period") == 4, k=k).collect()}

    borders = np.sort(old)[np.ceil(np.arange(1, 10) / 10 * len(old)).astype(int) - 1]
    p, q = (np.bincount(np.searchsorted(borders, v), minlength=10) / len(v) for v in (old, new))
    want = float(((q - p) * np.log(q / p)).sum())
    exact = got(8000)
    assert exact["x"]["psi"] == pytest.approx(want) and exact["x"]["n_bins"] == 10
    assert (exact["x"]["ref_n"], exact["x"]["cur_n"]) == (3000, 2000) and exact["x"]["ref_mean"] == pytest.approx(old.mean())
    assert exact["flat"]["n_bins"] == 2 and exact["flat"]["psi"] == pytest.approx(0.0)
    assert got(400)["x"]["psi"] == pytest.approx(want, abs=0.05)
    none = metrics.value_sketches(df.limit(0), ["x"], by=["period"])
    assert metrics.quantile_drift(none, F.col("period") < 4, F.col("period") == 4).count() == 0


# ---- segmentation --------------------------------------------------------

def profiles(spark, n=24):
    data = [(i, 1000.0 * (i % 4 + 1) + i * 3, 30000 + 40000 * (i % 4) + 100 * i,
             float((i * 7) % 11), 5.0 + (i % 3)) for i in range(n)]
    return spark.createDataFrame(
        data, "Store int, Weekly_Sales double, Size int, Total_MD_Value double, Unemployment double")


def test_profiles_golden(sales, stores, features):
    m = engineer_features(build_master(sales, stores, features))
    got = rows(segment.store_profiles(m), "Store")
    assert got[0] == (1, pytest.approx(140 / 3), 90000, 3.0, 6.0)
    assert got[1] == (2, pytest.approx(100 / 3), 61000, pytest.approx(8 / 3), 9.0)


def _psi(x, lam):
    if x >= 0:
        return math.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam
    return -math.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam)


@pytest.mark.parametrize("lam", [-1.5, 0.0, 0.7, 2.0])
def test_yeo_johnson_values(spark, lam):
    xs = [-3.5, -0.1, 0.0, 0.4, 8.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r["x"] for r in segment.apply_yeo_johnson(df, {"x": lam}).collect()]
    assert got == pytest.approx([_psi(x, lam) for x in xs])


def test_yeo_johnson_fit_beats_every_other_lambda(spark):
    rng = np.random.default_rng(3)
    pos, mixed = np.exp(rng.normal(size=200)), rng.normal(size=200) * 2 - 0.5
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(pos, mixed)], "a double, b double")
    found = segment.fit_yeo_johnson(df, ["a", "b"])
    for name, xs in (("a", pos), ("b", mixed)):
        def loglik(lam):
            t = np.array([_psi(x, lam) for x in xs])
            return -len(xs) / 2 * math.log(t.var()) + (lam - 1) * np.sum(np.sign(xs) * np.log1p(np.abs(xs)))
        best = loglik(found[name])
        assert all(best >= loglik(found[name] + d) - 1e-6 for d in (-0.5, -0.01, 0.01, 0.5))


def test_yeo_johnson_constant_column(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert segment.fit_yeo_johnson(df, ["x"]) == {"x": 1.0}


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = segment.fit_scaler(df, ["a", "b"])
    assert sc == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    got = [tuple(r) for r in segment.apply_scaler(df, sc).collect()]
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_segmentation(spark):
    m = profiles(spark).withColumns({"Dept": F.lit(1), "Date": F.lit("2010-02-05").cast("date")})
    cfg = segment.SegmentParams(restarts=2, elbow_max_k=4)
    r = segment.fit_segmentation(m, cfg)
    got = rows(r.profiles.select("Store", "Cluster"), "Store")
    assert len(got) == 24 and {c for _, c in got} == {0, 1, 2, 3}
    means = [x["avg_weekly_sales"] for x in
             segment.cluster_summary(r.profiles).orderBy("Cluster").collect()]
    assert means == sorted(means)
    assert len(r.wcss) == 4 and all(a >= b - 1e-9 for a, b in itertools.pairwise(r.wcss))
    assert -1 <= r.silhouette <= 1 and 0 < r.pca_variance_explained <= 1 + 1e-9
    for axis in r.model.loadings:
        assert max(axis, key=abs) > 0
    again = segment.fit_segmentation(m, cfg, elbow=False, score=False)
    assert rows(again.profiles.select("Store", "Cluster"), "Store") == got
    back = segment.SegmentModel.from_json(r.model.to_json())
    assert rows(back.assign(back.project(profiles(spark))).select("Store", "Cluster"), "Store") == got
    unseen = spark.createDataFrame([(99, 1)], "Store int, x int")
    assert segment.attach_clusters(unseen, r.profiles).first()["Cluster"] is None


def test_fewer_stores_than_clusters(spark):
    m = profiles(spark, 2)
    r = segment.fit_segmentation(m, segment.SegmentParams(restarts=1, elbow_max_k=3))
    assert r.profiles.count() == 2 and r.silhouette is None


def _silhouette(xs, labels, power):
    n, total = len(xs), 0.0
    for i in range(n):
        def mean(c):
            d = [sum((a - b) ** 2 for a, b in zip(xs[i], xs[j])) ** power
                 for j in range(n) if labels[j] == c and j != i]
            return sum(d) / len(d) if d else None
        a = mean(labels[i])
        b = min(mean(c) for c in set(labels) if c != labels[i])
        total += 0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b)
    return total / n


@pytest.mark.parametrize("metric,power", [("euclidean", 0.5), ("squared_euclidean", 1.0)])
def test_silhouette_against_all_pairs(spark, metric, power):
    rng = np.random.default_rng(1)
    xs = rng.normal(size=(40, 2)) + np.repeat([[0, 0], [3, 1], [0, 4], [9, 9]], 10, axis=0)
    labels = [i // 10 for i in range(39)] + [7]
    df = spark.createDataFrame([(float(a), float(b), c) for (a, b), c in zip(xs, labels)],
                               "a double, b double, Cluster int")
    unlabelled = spark.createDataFrame([(0.0, 0.0, None)], df.schema)
    got = segment.silhouette(df.union(unlabelled), ["a", "b"], metric=metric).first()
    assert got["silhouette"] == pytest.approx(_silhouette(xs.tolist(), labels, power))
    assert (got["metric"], got["n_points"], got["n_clusters"]) == (metric, 40, 5)
    one = df.withColumn("Cluster", F.lit(1))
    assert segment.silhouette(one, ["a", "b"]).first()["silhouette"] is None


# ---- seasonal ------------------------------------------------------------

def test_weekly_totals_and_gaps(spark, sales):
    assert rows(seasonal.weekly_totals(sales), "Date") == [(W1, 172.0), (W2, 68.0)]
    odd = spark.createDataFrame([(1, 1, W1, None, False), (None, 1, W1, 4.0, False),
                                 (1, 1, day("2010-02-26"), 3.0, False)], schemas.SALES)
    w = seasonal.weekly_totals(odd, by=["Store"])
    assert rows(w, "Date") == [(1, W1, 0.0), (1, day("2010-02-26"), 3.0)]
    assert [r[2] for r in rows(seasonal.densify(w, by=["Store"]), "Date")] == [0.0, 0.0, 0.0, 3.0]


def series(spark, n=260, stores=2):
    rng = np.random.default_rng(5)
    out = []
    for s in range(stores):
        x, prev = [], 0.0
        for i in range(n):
            prev = 0.7 * prev + rng.normal()
            x.append(100 + 30 * s * math.sin(2 * math.pi * i / 52) + prev)
        out += [(s, day("2010-01-01").toordinal() + 7 * i, v) for i, v in enumerate(x)]
    df = spark.createDataFrame(out, "Store int, o int, y double")
    return df.select("Store", F.expr("date_add(DATE'0001-01-01', o - 1)").alias("Date"), "y")


def test_order_search_and_fit(spark):
    df = series(spark)
    every = seasonal.search_orders(df, by=["Store"], config=seasonal.SeasonalParams(stepwise=False))
    assert every.groupBy("Store").count().where("count = 36").count() == 2
    found = seasonal.search_orders(df, by=["Store"])
    assert found.groupBy("Store").count().where("count BETWEEN 4 AND 35").count() == 2
    best = rows(seasonal.best_orders(found, by=["Store"]), "Store")
    fitted = seasonal.fit_series(df, by=["Store"])
    assert rows(fitted.select("Store", "p", "d", "q", "sp", "sd", "sq").distinct(), "Store") == \
        [(r[0], *r[1:7]) for r in best]
    err = fitted.where("Store = 0 AND fitted IS NOT NULL").agg(
        F.avg(F.pow(F.col("y") - F.col("fitted"), 2)).alias("mse"), F.var_pop("y").alias("v")).first()
    assert err["mse"] < 0.7 * err["v"]
    assert fitted.count() == df.count()


def test_pure_season_is_differenced(spark):
    df = series(spark).where("Store = 1").drop("Store")
    best = seasonal.best_orders(seasonal.search_orders(df)).first()
    assert best["sd"] == 1


def test_short_and_flat_series_do_not_fail(spark):
    df = spark.createDataFrame([(1, W1, 1.0), (2, W1, 3.0), (2, W2, 3.0)],
                               "Store int, Date date, y double")
    assert seasonal.search_orders(df, by=["Store"]).count() >= 0
    assert seasonal.fit_series(df, by=["Store"]).where("fitted IS NULL").count() == 3


def test_ar1_recovers_the_slope(spark):
    got = seasonal.ar1_fit(series(spark).where("Store = 0"), by=["Store"]).first()
    assert got["slope"] == pytest.approx(0.7, abs=0.12)


# ---- rules ---------------------------------------------------------------

def basket_sales(spark, baskets):
    data = [(i, item, W1, 1.0, False) for i, items in enumerate(baskets) for item in items]
    return spark.createDataFrame(data, schemas.SALES)


def brute(baskets, support, max_len=None):
    n, items = len(baskets), sorted({str(i) for b in baskets for i in b})
    sets = [frozenset(map(str, b)) for b in baskets]
    out = {}
    for k in range(1, (max_len or len(items)) + 1):
        for c in itertools.combinations(items, k):
            hit = sum(set(c) <= s for s in sets)
            if hit and hit / n >= support:
                out[c] = hit
    return out


def random_baskets(seed=2, n=120, items=9):
    rng = np.random.default_rng(seed)
    return [sorted(set(rng.integers(1, items + 1, size=rng.integers(1, 6)).tolist())) for _ in range(n)]


@pytest.mark.parametrize("engine", ["bitmaps", "levels", "fpgrowth"])
@pytest.mark.parametrize("max_len", [None, 2])
def test_itemsets_against_brute_force(spark, engine, max_len):
    baskets = random_baskets()
    got = rules.frequent_itemsets(basket_sales(spark, baskets), min_support=0.05, max_len=max_len,
                                  basket_keys=["Store"], engine=engine)
    assert {tuple(r["items"]): r["n"] for r in got.collect()} == brute(baskets, 0.05, max_len)


def test_deep_levels(spark):
    baskets = random_baskets(4)
    got = rules.frequent_itemsets(basket_sales(spark, baskets), min_support=0.005,
                                  basket_keys=["Store"], engine="levels")
    want = brute(baskets, 0.005)
    assert {tuple(r["items"]): r["n"] for r in got.collect()} == want
    assert max(map(len, want)) >= 4


def test_sixty_two_items(spark):
    baskets = [list(range(1, 63))] * 3 + [[1, 62]]
    got = rules.frequent_itemsets(basket_sales(spark, baskets), min_support=0.9, max_len=2,
                                  basket_keys=["Store"])
    assert {tuple(r["items"]): r["n"] for r in got.collect()} == {("1",): 4, ("62",): 4, ("1", "62"): 4}


def test_more_than_sixty_two_items(spark):
    baskets = [[i, i + 100] for i in range(70) for _ in range(2)]
    got = rules.frequent_itemsets(basket_sales(spark, baskets), min_support=0.01,
                                  basket_keys=["Store"])
    assert got.count() == 210 and got.where("size = 2").count() == 70


@pytest.mark.parametrize("engine", ["bitmaps", "levels", "fpgrowth"])
def test_itemset_on_the_threshold(spark, engine):
    baskets = [[1]] * 7 + [[2]] * 93
    got = rules.frequent_itemsets(basket_sales(spark, baskets), min_support=0.07,
                                  basket_keys=["Store"], engine=engine)
    assert {tuple(r["items"]): r["n"] for r in got.collect()} == {("1",): 7, ("2",): 93}


@pytest.mark.parametrize("max_len", [None, 2])
def test_seventy_items_lose_nothing(spark, max_len):
    baskets = [[i, 70] for i in range(70) for _ in range(1 + (i < 30))]
    got = rules.frequent_itemsets(basket_sales(spark, baskets), min_support=0.02,
                                  basket_keys=["Store"], max_len=max_len)
    assert {tuple(r["items"]): r["n"] for r in got.collect()} == brute(baskets, 0.02, 2)


def test_dense_baskets_with_a_limit(spark):
    baskets = [list(range(1, 41))] * 3
    assert rules.frequent_itemsets(basket_sales(spark, baskets), basket_keys=["Store"],
                                   max_len=3).count() == 40 + 780 + 9880


def test_rules_against_brute_force(spark):
    baskets = random_baskets(7)
    sets = brute(baskets, 0.03)
    n, want = len(baskets), {}
    for whole, hit in sets.items():
        for k in range(1, len(whole)):
            for left in itertools.combinations(whole, k):
                right = tuple(i for i in whole if i not in left)
                conf = hit / sets[left]
                lift = conf / (sets[right] / n)
                if conf >= 0.1 and lift >= 0.5:
                    want[left, right] = (hit / n, conf, lift)
    got = rules.mine_association_rules(
        basket_sales(spark, baskets),
        rules.RuleParams(min_support=0.03, min_confidence=0.1, min_lift=0.5, max_len=None),
        basket_keys=["Store"]).collect()
    assert {(tuple(r[0]), tuple(r[1])): pytest.approx(tuple(r[2:])) for r in got} == want
    assert any(len(r["consequents"]) > 1 for r in got)
    lifts = [r["lift"] for r in got]
    assert lifts == sorted(lifts, reverse=True)


def test_empty_and_single_item_baskets(spark, sales):
    none = rules.mine_association_rules(sales.limit(0))
    assert none.columns == ["antecedents", "consequents", "support", "confidence", "lift"]
    assert none.count() == 0
    assert rules.mine_association_rules(basket_sales(spark, [[1], [2]]),
                                        basket_keys=["Store"]).count() == 0


def test_baskets_and_top(spark, sales):
    got = rows(rules.dept_baskets(sales), "Store", "Date")
    assert [r[2] for r in got] == [["1", "2"], ["1"], ["1", "2"], ["2"]]
    m = rows(rules.basket_matrix(sales, [1, 2]), "Store", "Date")
    assert [r[2:] for r in m] == [(True, True), (True, False), (True, True), (False, True)]
    assert rows(rules.top_departments(sales, 1), "Dept") == [(1, 156.0)]
    assert rules.restrict_to_top(sales, 1).count() == 3
