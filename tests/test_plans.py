"""Plan shapes that matter at scale, and what is shipped to Python workers."""

from __future__ import annotations

import re
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from storecast.operators import anomaly, seasonal
from storecast.operators.features import add_sales_lag
from storecast.operators.quality import dedupe, validate_raw_tables
from storecast.plans.features_plan import engineered_master
from storecast.sources.sinks import CHUNK_COLUMN, write_bucketed_master


@pytest.fixture(scope="module")
def tables(spark, sales, stores, features, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    out = []
    for df, name in ((sales, "sales"), (stores, "stores"), (features, "features")):
        df.write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return out


@pytest.fixture
def shuffled(spark):
    """No broadcast joins and no adaptive changes: the plan for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def exchanges(text: str, *keys: str) -> int:
    return len(re.findall(rf"Exchange hashpartitioning\({', '.join(keys)}, \d+\)", text))


def test_lag_and_flags_shuffle_the_rows_once(tables, shuffled):
    text = plan(anomaly.lag_and_flags(tables[0], unique=True))
    # The rows, the partial aggregates and the carried rows by (series, chunk); the
    # chunk table by series. Two scans, and a hash aggregation.
    assert exchanges(text, "Store", "Dept", "__chunk") == 3
    assert exchanges(text, "Store", "Dept") == 1
    assert text.count("FileScan") == 2 and "SortAggregate" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def moved_rows(df) -> list[str]:
    """The exchanges of the executed plan whose input still holds all rows: neither an
    aggregate nor another exchange lies between them and the scan."""
    out, lines = [], plan(df).splitlines()
    depth = [len(re.match(r"[\s:|+\-]*", line).group()) for line in lines]
    for i, line in enumerate(lines):
        if "Exchange " in line:
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            if not any("Aggregate(" in x or "Exchange " in x for x in below):
                out.append(line)
    return out


def test_bucketed_rows_are_not_exchanged(spark, tables, shuffled, tmp_path):
    sales, by_year = tables[0], F.col(CHUNK_COLUMN)
    table = write_bucketed_master(sales, "bucketed_master_test", f"{tmp_path}/master", buckets=8)
    try:
        for run in (lambda df, **kw: add_sales_lag(df, unique=True, **kw), lambda df, **kw: anomaly.lag_and_flags(df, unique=True, **kw)):
            stored, loose = run(table, chunk=by_year), run(sales)
            assert moved_rows(loose) and not moved_rows(stored)
            assert "Bucketed: true" in plan(stored)
            columns = [c for c in loose.columns if c not in ("Sales_ZScore",)]
            assert sorted(map(str, stored.select(columns).collect())) == sorted(map(str, loose.select(columns).collect()))
    finally:
        spark.sql("DROP TABLE bucketed_master_test")


def test_bucketed_master_keeps_rows_without_a_date(spark, tmp_path):
    rows = [(1, 1, "2010-02-05", 5.0), (1, 1, None, 6.0), (None, 1, "2010-02-05", 7.0), (1, 1, "2011-02-05", 8.0)]
    df = spark.createDataFrame(rows, "Store int, Dept int, Date string, Weekly_Sales double").withColumn("Date", F.col("Date").cast("date"))
    table = write_bucketed_master(df, "bucketed_null_test", f"{tmp_path}/master", buckets=4)
    try:
        want = sorted(map(str, add_sales_lag(df).collect()))
        assert sorted(map(str, add_sales_lag(table, chunk=F.col(CHUNK_COLUMN)).drop(CHUNK_COLUMN).collect())) == want
        assert write_bucketed_master(df.limit(0), "bucketed_null_test", f"{tmp_path}/none", buckets=4).count() == 0
    finally:
        spark.sql("DROP TABLE bucketed_null_test")


def test_statistics_join_is_salted(tables, shuffled):
    text = plan(anomaly.flag_anomalies(tables[0]))
    # Rows and statistics meet by (series, salt); the statistics are made by series.
    assert exchanges(text, "Store", "Dept", "__salt") == 2
    assert exchanges(text, "Store", "Dept") == 1


def test_engineered_master_scans_and_joins(tables, shuffled):
    text = plan(engineered_master(*tables, gate=False, unique=True))
    assert text.count("FileScan") == 4
    assert text.count("SortMergeJoin") == 3


def test_small_dimensions_are_broadcast_without_hints(tables):
    df = engineered_master(*tables, gate=False, unique=True)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    df.collect()
    assert plan(df).split("Initial Plan")[0].count("BroadcastHashJoin") == 3


def test_key_filter_reaches_the_scan_below_the_statistics(tables, shuffled):
    df = anomaly.flag_anomalies(tables[0]).where("Store = 1 AND Dept = 1")
    pushed = re.findall(r"PushedFilters: \[([^]]*)", plan(df))
    assert len(pushed) == 2 and all("EqualTo(Store,1)" in p for p in pushed)


def test_date_filter_stays_above_the_lag(tables, shuffled):
    df = add_sales_lag(tables[0]).where("Date >= DATE'2010-02-12'")
    assert df.where("Store = 1 AND Dept = 1").first()["Sales_Lag_1"] == 64.0
    first = plan(df).split("FileScan")[1]
    assert "2010-02-12" not in first


def test_only_needed_columns_are_read(tables):
    text = plan(seasonal.weekly_totals(tables[0]))
    assert re.search(r"ReadSchema: struct<Date:date,Weekly_Sales:double>", text)


def test_quality_checks_share_a_pass(tables, shuffled):
    text = plan(validate_raw_tables(*tables))
    # One pass per table, and one more over two key columns for the orphans.
    assert text.count("FileScan") == 5


def test_dedupe_needs_no_window(tables):
    assert "Window" not in plan(dedupe(tables[0]))


def test_workers_need_no_package(tmp_path):
    blob = cloudpickle.dumps((seasonal._rank_orders, seasonal.SeasonalParams(seasonal_period=4)))
    (tmp_path / "f.pkl").write_bytes(blob)
    code = ("import pickle, numpy as np; f, cfg = pickle.load(open('f.pkl', 'rb')); "
            "print(len(f(np.arange(40.0) % 7, cfg)[0]))")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                          text=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 0
