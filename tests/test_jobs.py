"""Forecasting, persistence and the batch jobs end to end."""

from __future__ import annotations

import dataclasses
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import day, rows
from storecast import schemas
from storecast import Config, load_config
from storecast.operators import forecast, metrics, quality, rules, segment
from storecast.plans import jobs
from storecast.plans.features_plan import engineered_master
from storecast.sources import sinks
from storecast.sources.bundle import champion, load_bundle, promote, save_bundle
from storecast.sources.csv import write_raw_csv

CONFIG = Config(
    split_date="2011-06-03",
    limits=quality.Limits(min_stores=6, min_rows=1000),
    segments=segment.SegmentParams(restarts=1, elbow_max_k=3),
    forecast=forecast.ForecastParams(n_estimators=12, learning_rate=0.3, max_depth=4,
                                     early_stopping_rounds=4),
    rules=rules.RuleParams(max_len=2, min_confidence=0.1, min_lift=1.0))


@pytest.fixture(scope="module")
def tables(spark):
    """Six stores, five departments, two years: a level per store and
    department, a yearly wave, and departments that skip weeks."""
    weeks = spark.range(104).select(F.col("id").cast("int").alias("w"))
    grid = (weeks.select("w", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("Store"))
            .select("w", "Store", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("Dept"))
            .where("(w * 7 + Store * 3 + Dept * 5) % (Dept + 2) <> 0 OR Dept = 1"))
    date = F.expr("date_add(DATE'2010-01-01', 7 * w)")
    hol = F.expr("w % 26 = 6")
    value = F.expr("1000 * Dept + 300 * Store + 200 * sin(w * 0.1208) + pmod(hash(w, Store, Dept), 600)")
    sales = grid.select("Store", "Dept", date.alias("Date"), value.alias("Weekly_Sales"),
                        hol.alias("IsHoliday"))
    stores = spark.createDataFrame(
        [(i, "ABC"[i % 3], 40000 + 15000 * i) for i in range(1, 7)], schemas.STORES)
    feats = weeks.select("w", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("Store")).select(
        "Store", date.alias("Date"), F.expr("50 + 30 * sin(w * 0.12)").alias("Temperature"),
        F.expr("2.5 + w / 100.0D").cast("double").alias("Fuel_Price"),
        *[F.expr(f"CASE WHEN (w + {i}) % 4 = 0 THEN 10.0D * {i} * Store END").alias(f"MarkDown{i}")
          for i in range(1, 6)],
        F.expr("CASE WHEN w % 5 <> 0 THEN 200.0D + w END").alias("CPI"),
        F.expr("CASE WHEN w % 7 <> 0 THEN 5.0D + Store END").alias("Unemployment"),
        hol.alias("IsHoliday"))
    return sales, stores, feats


@pytest.fixture(scope="module")
def master(spark, tables):
    df = engineered_master(*tables, CONFIG, unique=True)
    seg = segment.fit_segmentation(df, CONFIG.segments, elbow=False, score=False)
    return segment.attach_clusters(df, seg.profiles).persist()


def test_forecaster_beats_the_lag_and_survives_a_round_trip(spark, master, tmp_path):
    split = CONFIG.split_date
    result, holdout = forecast.train_forecaster(master, CONFIG.forecast, split_date=split)
    lag = metrics.regression_metrics(holdout, forecast="Sales_Lag_1").first()
    assert result.metrics["r2"] > 0.5 and result.metrics["r2"] > lag["r2"]
    assert result.metrics["mae"] >= 0 and 1 <= result.n_trees <= 12
    assert dict(holdout.dtypes)["Store"] == "int"
    path = f"{tmp_path}/model"
    result.model.save(path)
    again = forecast.score_forecasts(PipelineModel.load(path),
                                     master.where(F.col("Date") >= split), result.type_encoding)
    key = ["Store", "Dept", "Date"]
    a = rows(holdout.select(*key, "predicted_weekly_sales"), *key)
    assert a == rows(again.select(*key, "point_forecast"), *key) and len(a) > 100
    top = forecast.feature_importance(spark, path, result.feature_columns, result.imputed).collect()
    assert len(top) <= 12 and "Dept" in {r["feature"] for r in top[:6]}
    assert [r["n_splits"] for r in top] == sorted((r["n_splits"] for r in top), reverse=True)


def test_unseen_type_store_and_missing_values_are_scored(spark, master):
    result, _ = forecast.train_forecaster(
        master, forecast.ForecastParams(n_estimators=2, max_depth=3, early_stopping_rounds=0),
        split_date=CONFIG.split_date)
    odd = master.limit(3).withColumns({"Type": F.lit("Z"), "Store": F.lit(77),
                                       "Cluster": F.lit(None).cast("int"),
                                       "CPI": F.lit(None).cast("double")})
    scored = forecast.score_forecasts(result.model, odd, result.type_encoding).collect()
    assert all(r["Type_Encoded"] is None and math.isfinite(r["point_forecast"]) for r in scored)


def test_holdout_validation_and_patience(master):
    cfg = forecast.ForecastParams(n_estimators=6, max_depth=3, early_stopping_rounds=2, validation="holdout",
                         learning_rate=0.3)
    result, _ = forecast.train_forecaster(master, cfg, split_date=CONFIG.split_date)
    assert 1 <= result.n_trees <= 6


def test_a_stopped_run_is_the_run_of_its_best_rounds(master):
    """The trees up to the best round are those of a run of that many rounds."""
    split = CONFIG.split_date
    cfg = forecast.ForecastParams(n_estimators=30, max_depth=6, early_stopping_rounds=1, learning_rate=1.0,
                         validation="holdout", subsample=1.0, colsample=1.0)
    stepped, rows_a = forecast.train_forecaster(master, cfg, split_date=split)
    fixed = dataclasses.replace(cfg, n_estimators=stepped.n_trees, early_stopping_rounds=0)
    plain, rows_b = forecast.train_forecaster(master, fixed, split_date=split)
    assert stepped.n_trees < 29
    assert stepped.metrics["mae"] == pytest.approx(plain.metrics["mae"])


def test_run_all(spark, tables, tmp_path):
    data, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    for df, name in zip(tables, CONFIG.files.values()):
        write_raw_csv(df, f"{data}/{name}")
    trained, scored = jobs.run_all(spark, data, out, CONFIG)
    assert tuple(scored.columns) == sinks.SCORE_COLUMNS
    assert scored.count() == trained.master.count() == tables[0].count()
    assert tuple(trained.forecasts.columns) == sinks.FORECAST_COLUMNS
    assert scored.where("point_forecast IS NULL").count() == 0
    report = trained.reports
    assert report["forecast_metrics"]["r2"] > 0.5
    assert report["association_rule_count"] == trained.rules.count() > 0
    assert set(report["anomaly_summary"]) == {"total_anomalies", "anomaly_rate",
                                              "holiday_share_among_anomalies"}
    saved = sinks.read_report(spark, f"{out}/artifacts/reports/evaluation_{trained.run_id}")
    assert saved["seasonal"]["m"] == 52
    runs = spark.read.parquet(f"{out}/artifacts/runs")
    assert sorted(r["stage"] for r in runs.collect()) == ["score", "train"]
    compared = metrics.compare_runs(runs.where("stage = 'train'"), metric="mae")
    assert compared.first()["promote"]
    bundle = load_bundle(spark, trained.model_path)
    assert bundle.type_encoding == {"A": 0, "B": 1, "C": 2}
    assert bundle.profiles.count() == 6
    assert trained.profiles.count() == 6 and trained.master.where("Is_Anomaly IS NULL").count() == 0
    # A second training run adds a row and a bundle; no better, it leaves the champion.
    assert trained.promoted
    tables2 = jobs.load_staged(spark, data, f"{tmp_path}/staged", CONFIG)
    second = jobs.train(tables2, out, dataclasses.replace(CONFIG, forecast=dataclasses.replace(
        CONFIG.forecast, n_estimators=1)))
    assert spark.read.parquet(f"{out}/artifacts/runs").count() == 3
    assert not second.promoted and second.model_path != trained.model_path
    assert champion(spark, jobs.champion_log(out)) == trained.model_path


def test_a_save_that_dies_keeps_the_champion(spark, master, tmp_path, monkeypatch):
    result, _ = forecast.train_forecaster(
        master, forecast.ForecastParams(n_estimators=1, max_depth=2, early_stopping_rounds=0), split_date=CONFIG.split_date)
    plain, profiles = segment.SegmentModel([], [], {}, {}, [], [], []), master.select("Store").distinct()
    log = f"{tmp_path}/champions"
    assert champion(spark, log) is None
    first = save_bundle(spark, f"{tmp_path}/models/a", result, plain, profiles)
    promote(spark, log, "a", first)

    def dies(_):
        raise RuntimeError("lost")

    monkeypatch.setattr(segment.SegmentModel, "to_json", dies)  # after forecaster and profiles are written
    with pytest.raises(RuntimeError, match="lost"):
        save_bundle(spark, f"{tmp_path}/models/b", result, plain, profiles)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no whole bundle"):
        promote(spark, log, "b", f"{tmp_path}/models/b")
    assert champion(spark, log) == first and load_bundle(spark, champion(spark, log)).feature_columns
    second = save_bundle(spark, f"{tmp_path}/models/b", result, plain, profiles)
    promote(spark, log, "b", second)
    assert champion(spark, log) == second
    with pytest.raises(ValueError, match="train first"):
        jobs.score((master, master, master), f"{tmp_path}/empty")


def test_validate_job_stops_a_bad_run(spark, tables, tmp_path):
    sales, stores, feats = tables
    with pytest.raises(ValueError, match="values of Store that stores does not list"):
        jobs.train((sales, stores.where("Store < 6"), feats), str(tmp_path),
                   Config(limits=quality.Limits(min_stores=1, min_rows=1)))


def test_ingest_writes_by_year(spark, tables, tmp_path):
    got = jobs.ingest(tables, f"{tmp_path}/m", CONFIG)
    assert got.count() == tables[0].count()
    assert sorted(r[0] for r in got.select("Year").distinct().collect()) == [2010, 2011]


def test_export(spark, master, tmp_path):
    scored = metrics.forecast_errors(master.withColumn("point_forecast", F.col("Sales_Lag_1")))
    out = sinks.export_forecasts(scored.limit(5), f"{tmp_path}/csv")
    assert out.columns[-2:] == ["model", "scored_at"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 5
    assert len(sinks.new_run_id()) == 25


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("limits: {min_stores: 3}\nmarkdowns: [MarkDown1]\nfiles: {sales: s.csv}\n")
    cfg = load_config(str(path))
    assert cfg.limits.min_stores == 3 and cfg.limits.min_rows == 400_000
    assert cfg.markdowns == ("MarkDown1",) and cfg.files["stores"] == Config().files["stores"]
    assert cfg.files["sales"] == "s.csv" and cfg.zscore == 3.0
    assert load_config().rules.max_departments == 40
    for bad in ({"nope": {}}, {"limits": {"nope": 1}}):
        with pytest.raises(ValueError, match="nope"):
            Config.from_dict(bad)


def test_bad_split_leaves_holdout_empty(master):
    before, after = forecast.split_by_date(master, day("2030-01-01"))
    assert after.isEmpty() and not before.isEmpty()
