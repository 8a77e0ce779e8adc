"""The batch jobs: validate, ingest, train, score, and all of them in a row."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Keys
from ..operators.anomaly import anomaly_summary
from ..operators.explore import run_summary
from ..operators.forecast import score_forecasts, train_forecaster
from ..operators.master import build_master
from ..operators.metrics import compare_runs
from ..operators.quality import observe_nulls, raise_if_failed, validate_observed, validate_raw_tables
from ..operators.rules import mine_association_rules
from ..operators.seasonal import best_orders, densify, search_orders, weekly_totals
from ..operators.segment import attach_clusters, cluster_summary, fit_segmentation
from ..session import remove_path, scratch_path
from ..sources.bundle import champion, load_bundle, promote, save_bundle
from ..sources.csv import load_raw_tables
from ..sources.sinks import (append_run, new_run_id, write_forecasts, write_master, write_report,
                             write_rules, write_scores)
from .features_plan import engineered_master
from .settings import Config

Tables = tuple[DataFrame, DataFrame, DataFrame]


def load_staged(spark: SparkSession, data_dir: str, path: str, config: Config = Config()
                ) -> Tables:
    """The raw CSV tables, parsed once and kept as Parquet below `path`."""
    out = []
    for df, name in zip(load_raw_tables(spark, data_dir, config.files),
                        ("sales", "stores", "features")):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        out.append(spark.read.schema(df.schema).parquet(f"{path}/{name}"))
    return tuple(out)


def validate(tables: Tables, config: Config = Config(), *, keys: Keys = Keys()) -> DataFrame:
    return validate_raw_tables(*tables, config.limits, keys=keys)


def ingest(tables: Tables, path: str, config: Config = Config(), *, keys: Keys = Keys()
           ) -> DataFrame:
    """The cleaned master table, written as Parquet; no other gate runs."""
    sales, stores, features = tables
    master = build_master(sales, stores, features, markdowns=config.markdowns,
                          max_negative_share=config.limits.max_negative_share,
                          fill=config.fill, keys=keys)
    write_master(master.withColumn("Year", F.year(keys.time)), path)
    return sales.sparkSession.read.parquet(path)


@dataclass
class TrainResult:
    run_id: str
    master: DataFrame
    forecasts: DataFrame
    profiles: DataFrame
    rules: DataFrame
    model_path: str
    promoted: bool = False
    reports: dict[str, Any] = field(default_factory=dict)


def train(tables: Tables, out_dir: str, config: Config = Config(), *, keys: Keys = Keys()
          ) -> TrainResult:
    """Gates, master table, segments, forecaster, seasonal baseline, rules, and
    all their outputs below `out_dir`. The raw tables are checked in one pass each,
    the master table while it is written. The run's bundle becomes the champion if
    its holdout error is below that of all runs before, or if there is none yet."""
    sales, stores, features = tables
    spark, run_id, base = sales.sparkSession, new_run_id(), out_dir.rstrip("/")
    checks = raise_if_failed(validate(tables, config, keys=keys), also=["negative_share"])

    staged, required = scratch_path(spark, "engineered"), config.limits.required["master"]
    master, seen = observe_nulls(engineered_master(sales, stores, features, config, keys=keys,
                                                   gate=False, unique=True), required)
    master.write.parquet(staged)
    engineered = spark.read.parquet(staged)
    checks += raise_if_failed(validate_observed(engineered, seen, required=required,
                                                max_null_share=config.limits.max_null_share))

    segments = fit_segmentation(engineered, config.segments, keys=keys)
    processed = write_master(attach_clusters(engineered, segments.profiles, keys=keys),
                             f"{base}/processed/master_{run_id}")
    master = spark.read.parquet(processed)
    remove_path(spark, staged)

    forecast, holdout = train_forecaster(master, config.forecast,
                                         split_date=config.split_date)
    forecasts_path = write_forecasts(holdout, f"{base}/outputs/forecasts_{run_id}")

    weekly = densify(weekly_totals(sales, keys=keys), time=keys.time)
    order = best_orders(search_orders(weekly, config=config.seasonal)).first()
    rules = mine_association_rules(sales, config.rules, keys=keys)
    rules_path = write_rules(rules, f"{base}/outputs/association_rules_{run_id}")
    rules = spark.read.parquet(rules_path)

    model_path = save_bundle(spark, f"{base}/artifacts/models/{run_id}", forecast,
                             segments.model, segments.profiles)
    summary = run_summary(master, rules=rules, keys=keys).first().asDict()
    reports = {
        "forecast_metrics": forecast.metrics,
        "n_trees": forecast.n_trees,
        "segmentation": {
            "silhouette": segments.silhouette,
            "pca_variance_explained": segments.pca_variance_explained,
            "wcss": segments.wcss,
            "cluster_summary": [r.asDict() for r in
                                cluster_summary(segments.profiles, keys=keys).collect()],
        },
        "anomaly_summary": anomaly_summary(master, keys=keys).first().asDict(),
        "seasonal": order.asDict() if order else None,
        "association_rule_count": summary["n_rules"],
        "summary": summary,
        "checks": checks,
    }
    report_path = write_report(spark, reports, f"{base}/artifacts/reports/evaluation_{run_id}")
    runs = append_run(spark, f"{base}/artifacts/runs", run_id=run_id, stage="train",
                      paths={"processed_path": processed, "forecasts_path": forecasts_path,
                             "model_path": model_path, "report_path": report_path},
                      metrics=forecast.metrics, reports=reports)
    promoted = promote_if_better(spark, base, run_id, model_path, runs)
    return TrainResult(run_id, master, spark.read.parquet(forecasts_path),
                       segments.profiles, rules, model_path, promoted, reports)


def champion_log(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/artifacts/champions"


def promote_if_better(spark: SparkSession, out_dir: str, run_id: str, model_path: str, runs: DataFrame, *,
                      metric: str = "rmse") -> bool:
    """Make the run's bundle the champion if its metric is below that of all runs before it, or
    if there is no champion. A worse run's bundle stays on disk and scores nothing."""
    log = champion_log(out_dir)
    better = (compare_runs(runs.select("run_id", "created_at", metric), metric=metric)
              .where(F.col("run_id") == run_id).first()["promote"])
    if not better and champion(spark, log) is not None:
        return False
    promote(spark, log, run_id, model_path)
    return True


def score(tables: Tables, out_dir: str, config: Config = Config(), *,
          model_path: str | None = None, keys: Keys = Keys()) -> DataFrame:
    """Score all rows with a saved bundle, the champion by default. Segments come from the
    saved profiles; no anomaly flags are made."""
    sales, stores, features = tables
    spark, run_id, base = sales.sparkSession, new_run_id(), out_dir.rstrip("/")
    model_path = model_path or champion(spark, champion_log(base))
    if model_path is None:
        raise ValueError(f"no champion below {base}; train first or name a model")
    bundle = load_bundle(spark, model_path)
    master = engineered_master(sales, stores, features, config, keys=keys, anomalies=False)
    scored = score_forecasts(bundle.model, attach_clusters(master, bundle.profiles, keys=keys),
                             bundle.type_encoding)
    path = write_scores(scored, f"{base}/outputs/batch_scores_{run_id}")
    append_run(spark, f"{base}/artifacts/runs", run_id=run_id, stage="score",
               paths={"forecasts_path": path, "model_path": model_path})
    return spark.read.parquet(path)


def run_all(spark: SparkSession, data_dir: str, out_dir: str, config: Config = Config()
            ) -> tuple[TrainResult, DataFrame]:
    """Validate, train and score CSV input that is read once."""
    raw = scratch_path(spark, "raw")
    tables = load_staged(spark, data_dir, raw, config)
    try:
        trained = train(tables, out_dir, config)
        return trained, score(tables, out_dir, config, model_path=trained.model_path)
    finally:
        remove_path(spark, raw)
