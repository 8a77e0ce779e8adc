"""Parquet, CSV and JSON outputs, the run id, and the runs table."""

from __future__ import annotations

import datetime as dt
import json
import secrets
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Keys
from ..operators.ordered import year_chunk

FORECAST_COLUMNS = ("Store", "Dept", "Date", "Weekly_Sales", "predicted_weekly_sales")
SCORE_COLUMNS = ("Store", "Dept", "Date", "Weekly_Sales", "point_forecast")
EXPORT_COLUMNS = (*SCORE_COLUMNS, "forecast_error", "Cluster")
RUN_SCHEMA = ("run_id string, stage string, created_at timestamp, processed_path string, "
              "forecasts_path string, model_path string, report_path string, r2 double, "
              "mae double, rmse double, mape double, reports string")


def new_run_id() -> str:
    """UTC stamp and eight hex digits; sorts by time."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%SZ}-{secrets.token_hex(4)}"


def write_master(df: DataFrame, path: str) -> str:
    """Partitioned by year. The rebalance gathers each year's rows into files of
    the advisory size and splits a year that is too large for one task."""
    df.hint("rebalance", "Year").write.mode("overwrite").partitionBy("Year").parquet(path)
    return path


#: The column of a bucketed master that cuts each series into years.
CHUNK_COLUMN = "Series_Year"


def write_bucketed_master(df: DataFrame, table: str, path: str, *, buckets: int,
                          keys: Keys = Keys()) -> DataFrame:
    """The master as a bucketed table: rows of a series and year lie in one bucket, one
    sorted file each. Ordered scans over (series, year), with
    `chunk=F.col(CHUNK_COLUMN)`, then need no exchange of the rows, however often they
    run. The year is among the bucket keys, so a series of any length is spread.
    `buckets` is the number of tasks of such a scan: choose it so that a bucket fits one."""
    by = [*keys.series, CHUNK_COLUMN]
    rows = df.withColumn(CHUNK_COLUMN, year_chunk(keys.time))
    (rows.repartition(buckets, *by).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *by).sortBy(*by, keys.time).saveAsTable(table))
    return df.sparkSession.table(table)


def write_forecasts(df: DataFrame, path: str) -> str:
    df.select(*FORECAST_COLUMNS).write.mode("overwrite").parquet(path)
    return path


def write_scores(df: DataFrame, path: str) -> str:
    df.select(*SCORE_COLUMNS).write.mode("overwrite").parquet(path)
    return path


def write_rules(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def export_forecasts(scored: DataFrame, path: str | None = None, *, model: str = "gbt"
                     ) -> DataFrame:
    """The scored rows with the model name and the scoring time; written as CSV
    where a path is given."""
    out = (scored.select(*EXPORT_COLUMNS).withColumn("model", F.lit(model))
           .withColumn("scored_at", F.current_timestamp()))
    if path:
        out.write.mode("overwrite").option("header", True).csv(path)
    return out


def write_report(spark: SparkSession, payload: dict[str, Any], path: str) -> str:
    """A nested report as one JSON document."""
    spark.createDataFrame([(json.dumps(payload, default=str),)], "value string") \
        .write.mode("overwrite").text(path)
    return path


def read_report(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def append_run(spark: SparkSession, path: str, *, run_id: str, stage: str,
               paths: dict[str, str], metrics: dict[str, float] | None = None,
               reports: dict[str, Any] | None = None) -> DataFrame:
    """Append one row to the runs table, for training and scoring alike."""
    metrics = metrics or {}
    row = (run_id, stage, dt.datetime.now(dt.timezone.utc),
           *[paths.get(k) for k in ("processed_path", "forecasts_path", "model_path",
                                    "report_path")],
           *[metrics.get(k) for k in ("r2", "mae", "rmse", "mape")],
           json.dumps(reports or {}, default=str))
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(RUN_SCHEMA).parquet(path)
