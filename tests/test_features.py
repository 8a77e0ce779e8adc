"""Scalar functions, features and the golden master rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import W1, W2, day, rows
from storecast import Config
from storecast.functions import scalar
from storecast.operators import features as fe
from storecast.operators import master as ma
from storecast.operators.quality import Limits
from storecast.operators.ordered import forward_fill, previous_value
from storecast.plans.features_plan import engineered_master

LOOSE = Config(limits=Limits(min_stores=1, min_rows=1))


def test_parse_bool(spark):
    texts = ["TRUE", " yes ", "1", "t", "\tTrue\n", "0", "", "no", None, "1.0"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in rows(df.select("i", scalar.parse_bool(F.col("t"))), "i")]
    assert got == [True] * 5 + [False] * 5
    flags = spark.createDataFrame([(True,), (False,)], "b boolean")
    assert [r[0] for r in flags.select(scalar.parse_bool(F.col("b"))).collect()] == [True, False]


def test_parse_date(spark):
    df = spark.createDataFrame([("5/2/2010",), ("05/02/2010",), ("2010-02-05",), (" 5/2/2010 ",),
                                (None,)], "t string")
    got = [r[0] for r in df.select(scalar.parse_date(F.col("t"))).collect()]
    assert got == [W1] * 4 + [None]
    bad = spark.createDataFrame([("13-2010",)], "t string").select(scalar.parse_date(F.col("t")))
    with pytest.raises(Exception, match="unparseable date"):
        bad.collect()


def test_temperature_bands(spark):
    df = spark.createDataFrame([(20.0,), (32.0,), (45.0,), (52.0,), (65.0,), (78.0,), (90.0,),
                                (None,), (float("nan"),)], "t double")
    got = [r[0] for r in df.select(scalar.temperature_band(F.col("t"))).collect()]
    assert got == ["Freezing", "Freezing", "Cold", "Cold", "Moderate", "Moderate", "Hot",
                   "Unknown", "Unknown"]


def test_iso_weeks(spark):
    df = spark.createDataFrame([(day("2010-01-01"),), (day("2011-01-01"),), (day("2012-12-31"),)],
                               "Date date")
    got = rows(fe.add_temporal_features(df).select("Year", "Month", "Week"), "Year")
    assert got == [(2010, 1, 53), (2011, 1, 52), (2012, 12, 1)]


@pytest.mark.parametrize("unique", [False, True])
def test_golden_rows(sales, stores, features, unique):
    df = engineered_master(sales, stores, features, LOOSE, unique=unique)
    got = rows(df.select("Store", "Dept", "Date", "Week", "Temp_Category", "Sales_Lag_1",
                         "MD_Count", "Total_MD_Value", F.round("Sales_ZScore", 6), "Is_Anomaly"),
               "Store", "Dept", "Date")
    z = 0.707107
    assert got == [
        (1, 1, W1, 5, "Freezing", 0.0, 0, 0.0, z, False),
        (1, 1, W2, 6, "Cold", 64.0, 1, 9.0, -z, False),
        (1, 2, W1, 5, "Freezing", 0.0, 0, 0.0, None, False),
        (2, 1, W1, 5, "Moderate", 0.0, 1, 4.0, None, False),
        (2, 2, W1, 5, "Moderate", 0.0, 1, 4.0, -z, False),
        (2, 2, W2, 6, "Hot", 20.0, 0, 0.0, z, False),
    ]


def test_composition_equals_the_step_by_step_plan(sales, stores, features):
    from storecast.operators.anomaly import flag_anomalies
    steps = flag_anomalies(fe.engineer_features(ma.build_master(sales, stores, features)))
    plan = engineered_master(sales, stores, features, LOOSE)
    assert sorted(plan.columns) == sorted(steps.columns)
    cols = sorted(set(steps.columns) - {"Sales_ZScore"})
    key = ["Store", "Dept", "Date"]
    assert rows(steps.select(*cols), *key) == rows(plan.select(*cols), *key)


@pytest.mark.parametrize("unique", [False, True])
def test_fused_lag_and_flags(spark, unique):
    """Equal to the two operators one after the other, over several years, with
    missing values, missing keys, short series and, where allowed, repeated dates."""
    from storecast.operators.anomaly import flag_anomalies, lag_and_flags
    start, data = dt.date(2000, 1, 1), {}
    for i in range(800):
        store = [1, 1, 1, 2, None][i % 5]
        when = start + dt.timedelta(days=7 * (i // 5) if i % 11 else 0)
        value = None if i % 17 == 3 else 1e6 + (i * 31 % 97) + (5000 if i == 405 else 0)
        data[(store, 1 + i % 2, when) if unique else i] = (store, 1 + i % 2, when, value, False)
    data["alone"] = (9, 9, start, 5.0, True)
    df = spark.createDataFrame(list(data.values()), "Store int, Dept int, Date date, "
                               "Weekly_Sales double, IsHoliday boolean")
    got = lag_and_flags(df, unique=unique)
    want = flag_anomalies(fe.add_sales_lag(df, unique=unique))
    order = ["Store", "Dept", "Date", "Weekly_Sales", "Sales_Lag_1", "IsHoliday", "Is_Anomaly"]
    a, b = (rows(x.select(*order, "Sales_ZScore"), *order) for x in (got, want))
    assert [r[:-1] for r in a] == [r[:-1] for r in b]
    assert [r[-1] is None for r in a] == [r[-1] is None for r in b]
    assert [r[-1] or 0 for r in a] == pytest.approx([r[-1] or 0 for r in b], abs=1e-6)
    assert any(r[-2] for r in a)


def test_lag_null_rules(spark, sales):
    # A missing previous value gives 0, and so does a row with a missing key.
    df = spark.createDataFrame([
        (1, 1, day("2010-01-01"), None, False), (1, 1, day("2010-01-08"), 5.0, False),
        (1, 1, day("2011-01-07"), 7.0, False), (None, 1, day("2010-01-01"), 3.0, False),
        (None, 1, day("2010-01-08"), 4.0, False)], sales.schema)
    got = rows(fe.add_sales_lag(df).select("Store", "Date", "Sales_Lag_1"), "Store", "Date")
    assert got == [(None, day("2010-01-01"), 0.0), (None, day("2010-01-08"), 0.0),
                   (1, day("2010-01-01"), 0.0), (1, day("2010-01-08"), 0.0),
                   (1, day("2011-01-07"), 5.0)]


@pytest.mark.parametrize("chunk", ["year", "month", "one"])
def test_chunked_scans_equal_plain_windows(spark, chunk):
    """One key holds most rows; years without rows lie between others; dates repeat."""
    start = dt.date(2000, 1, 1)
    data = []
    for i in range(600):
        k = 1 if i % 3 else i % 7
        data.append((k, start + dt.timedelta(days=(i * 37) % 5000 * (1 if i % 5 else 0)),
                     float(i * 13 % 101) if i % 4 else None))
    df = spark.createDataFrame(data, "k int, d date, v double")
    expr = {"year": F.year("d"), "month": F.trunc("d", "month"), "one": F.lit(0)}[chunk]
    got = previous_value(df, by=["k"], order=[F.col("d")], value="v", out="p", chunk=expr)
    w = Window.partitionBy("k").orderBy("d", "v")
    want = df.withColumn("p", F.lag("v").over(w))
    order = ["k", "d", "v", "p"]
    assert rows(got.select(*order), *order) == rows(want.select(*order), *order)

    got = forward_fill(df.withColumn("o", F.col("v")), by=["k"], order=[F.col("d")],
                       columns=["v"], chunk=expr)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("o", F.col("v")).withColumn("v", F.last("v", ignorenulls=True).over(running))
    order = ["k", "d", "o", "v"]
    assert rows(got.select(*order), *order) == rows(want.select(*order), *order)

    once = df.groupBy("k", "d").agg(F.max("v").alias("v"))
    got = previous_value(once, by=["k"], order=[F.col("d")], value="v", out="p", chunk=expr,
                         unique=True)
    want = previous_value(once, by=["k"], order=[F.col("d")], value="v", out="p", chunk=None)
    assert rows(got, "k", "d") == rows(want, "k", "d")
    got = forward_fill(once, by=["k"], order=[F.col("d")], columns=["v"], chunk=expr, unique=True)
    want = forward_fill(once, by=["k"], order=[F.col("d")], columns=["v"], chunk=None)
    assert rows(got, "k", "d") == rows(want, "k", "d")


def test_markdown_signals_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None, -2.0, 0.0, 3.0), (None, None, None, None, None)],
                               ", ".join(f"MarkDown{i} double" for i in range(1, 6)))
    got = [tuple(r) for r in fe.add_markdown_signals(df).select("MD_Count", "Total_MD_Value")
           .collect()]
    assert got == [(2, 2.0), (0, 0.0)]


def test_encode_type_and_saved_mapping(spark, stores):
    df, mapping = fe.encode_type(stores)
    assert mapping == {"B": 0, "C": 1}
    unseen = spark.createDataFrame([("C",), ("Z",), (None,)], "Type string")
    got = [r[0] for r in fe.encode_type(unseen, mapping)[0].select("Type_Encoded").collect()]
    assert got == [1, None, None]


def test_clean_keeps_missing_and_drops_negative(spark, sales):
    df = spark.createDataFrame([(1, 1, W1, None, False), (1, 2, W1, -1.0, False),
                                (1, 3, W1, 0.0, False)], sales.schema)
    assert ma.drop_negative_sales(df).count() == 2
    share = ma.negative_share(df).first()
    assert (share["n_rows"], share["n_negative"]) == (3, 1)
    assert share["negative_share"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="negative Weekly_Sales"):
        ma.check_negative_share(df, 0.1)


def test_fill_orders_differ(spark, sales, stores, features):
    """Input order fills the start of an item from the end of the item before
    it; chronological order never looks ahead in time."""
    gap = features.withColumn("CPI", F.when(F.col("Date") != W1, F.col("CPI")))
    key = ["Store", "Dept", "Date"]
    chrono = rows(ma.build_master(sales, stores, gap).select(*key, "CPI").where("Store = 1"), *key)
    as_read = rows(ma.build_master(sales, stores, gap, fill="input").select(*key, "CPI")
                   .where("Store = 1"), *key)
    assert [r[3] for r in chrono] == [None, 151.0, None]
    assert [r[3] for r in as_read] == [None, 151.0, 151.0]


def test_holiday_mismatch_gives_null_features(sales, stores, features):
    flipped = features.withColumn("IsHoliday", ~F.col("IsHoliday"))
    merged = ma.merge_datasets(sales, stores, flipped)
    assert merged.count() == 6 and merged.where("Temperature IS NOT NULL").count() == 0


def test_null_safe_join(spark, sales, stores):
    s = spark.createDataFrame([(None, 1, W1, 1.0, False)], sales.schema)
    dim = spark.createDataFrame([(None, "C", 5)], stores.schema)
    assert ma.join_stores(s, dim).first()["Type"] is None
    assert ma.join_stores(s, dim, null_safe=True).first()["Type"] == "C"


def test_split(sales):
    before, after = ma.split_by_date(sales, "2010-02-12")
    assert (before.count(), after.count()) == (4, 2)
