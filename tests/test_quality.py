"""Quality gates, sources and de-duplication."""

from __future__ import annotations

import pytest

from conftest import W1, W2, rows
from storecast import schemas
from storecast.operators import quality as qa
from storecast.operators.master import build_master
from storecast.sources.csv import FILES, load_raw_tables, write_raw_csv

SMALL = qa.Limits(min_stores=2, min_rows=6)


def failed(checks):
    return {(r["table_name"], r["check"]) for r in checks.collect() if not r["passed"]}


def test_all_pass(sales, stores, features):
    checks = qa.validate_raw_tables(sales, stores, features, SMALL)
    assert failed(checks) == set()
    assert "sales has all its columns; rows: 6" in qa.raise_if_failed(checks)


def test_missing_column_is_named_and_nothing_crashes(sales, stores, features):
    checks = qa.validate_raw_tables(sales.drop("Weekly_Sales", "Dept"), stores.drop("Store"),
                                    features, SMALL)
    assert failed(checks) == {("sales", "schema"), ("stores", "schema")}
    with pytest.raises(qa.DataQualityError, match="lacks the columns .*Weekly_Sales"):
        qa.raise_if_failed(checks)


def test_row_floors(sales, stores, features):
    checks = qa.validate_raw_tables(sales, stores, features, qa.Limits())
    assert failed(checks) == {("sales", "min_rows"), ("stores", "min_rows")}


def test_duplicates_orphans_and_dimension_keys(spark, sales, stores, features):
    twice = sales.unionByName(sales.where("Store = 1 AND Dept = 1"))
    dup = qa.duplicate_counts(twice, ["Store", "Dept", "Date"]).first()
    assert tuple(dup) == (4, 2, 2)
    checks = qa.validate_raw_tables(twice, stores.where("Store = 1"),
                                    features.unionByName(features), SMALL)
    assert failed(checks) == {("sales", "unique_key"), ("sales", "orphans"),
                              ("features", "unique_key"), ("stores", "min_rows")}
    assert qa.check_orphans(sales, stores.where("Store = 1"), "sales", "Store", "stores") \
        .first()["observed"] == 1.0


def test_negative_share_is_soft(spark, sales, stores, features):
    bad = sales.unionByName(spark.createDataFrame([(1, 9, W1, -5.0, False)], schemas.SALES))
    checks = qa.validate_raw_tables(bad, stores, features, SMALL)
    assert failed(checks) == {("sales", "negative_share")}
    qa.raise_if_failed(checks)


def test_master_null_rates(sales, stores, features):
    good = build_master(sales, stores, features)
    assert failed(qa.validate_master(good)) == set()
    thin = build_master(sales, stores.where("Store = 1"), features)
    assert failed(qa.validate_master(thin)) == {("master", "null_share:Type"),
                                                ("master", "null_share:Size")}
    assert failed(qa.validate_master(good.drop("Size"))) == {("master", "schema")}


def test_empty_sales(spark, sales, stores, features):
    none = sales.limit(0)
    assert ("sales", "min_rows") in failed(qa.validate_raw_tables(none, stores, features, SMALL))
    assert build_master(none, stores, features).count() == 0


def test_dedupe_is_order_free(sales, spark):
    extra = spark.createDataFrame([(1, 1, W1, 50.0, True), (1, 1, W1, 64.0, True)], schemas.SALES)
    a, b = qa.dedupe(sales.unionByName(extra)), qa.dedupe(extra.unionByName(sales))
    key = ["Store", "Dept", "Date"]
    assert rows(a, *key) == rows(b, *key)
    assert a.count() == 6 and rows(a, *key)[0] == (1, 1, W1, 64.0, True)


def test_freshness(sales, features):
    got = rows(qa.freshness({"sales": sales, "old": sales.where("Date = '2010-02-05'")},
                            max_age_days=6), "table_name")
    assert got == [("old", W1, 7, True), ("sales", W2, 0, False)]


def test_csv_round_trip(spark, sales, stores, features, tmp_path):
    for df, name in zip((sales, stores, features), FILES.values()):
        write_raw_csv(df, f"{tmp_path}/{name}")
    for got, want in zip(load_raw_tables(spark, str(tmp_path)), (sales, stores, features)):
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_csv_tokens_and_missing_columns(spark, tmp_path):
    (tmp_path / "sales data-set.csv").write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday,Note\n1,2,5/2/2010,NA, yes ,x\n"
        "1,3,05/02/2010,nan,0,\n1,4,2010-02-05,12.5,T,y\n")
    (tmp_path / "stores data-set.csv").write_text("Store,Type\n1,A\n")
    (tmp_path / "Features data set.csv").write_text("Store,Date,CPI,IsHoliday\n1,5/2/2010,#N/A,1\n")
    s, st, f = load_raw_tables(spark, str(tmp_path))
    assert rows(s, "Dept") == [(1, 2, W1, None, True, "x"), (1, 3, W1, None, False, None),
                               (1, 4, W1, 12.5, True, "y")]
    assert st.columns == ["Store", "Type"] and f.first()["CPI"] is None
    assert ("stores", "schema") in failed(qa.validate_raw_tables(s, st, f, SMALL))


def test_unparseable_number_raises(spark, tmp_path):
    (tmp_path / "sales data-set.csv").write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,2,5/2/2010,abc,FALSE\n")
    for name in ("stores data-set.csv", "Features data set.csv"):
        (tmp_path / name).write_text("Store\n1\n")
    with pytest.raises(Exception):
        load_raw_tables(spark, str(tmp_path))[0].collect()
