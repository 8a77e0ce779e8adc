"""The model bundle: forecaster, segmentation, profiles and lookups, saved with
Spark's own persistence, and the log that says which bundle is the champion.

Every run saves a bundle of its own. A bundle counts once its path is appended to
the log, in one commit of a small table: a run that dies while it saves leaves the
old champion as it was.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.forecast import ForecastResult
from ..operators.segment import SegmentModel
from ..session import path_exists


@dataclass
class Bundle:
    model: PipelineModel
    model_path: str
    feature_columns: list[str]
    imputed: list[str]
    type_encoding: dict[str, int]
    train_end_date: str
    segmentation: SegmentModel
    profiles: DataFrame


def save_bundle(spark: SparkSession, path: str, forecast: ForecastResult,
                segmentation: SegmentModel, profiles: DataFrame) -> str:
    forecast.model.write().overwrite().save(f"{path}/forecaster")
    profiles.write.mode("overwrite").parquet(f"{path}/profiles")
    meta = {"feature_columns": forecast.feature_columns, "imputed": forecast.imputed,
            "type_encoding": forecast.type_encoding, "train_end_date": forecast.train_end_date,
            "n_trees": forecast.n_trees, "metrics": forecast.metrics,
            "segmentation": json.loads(segmentation.to_json())}
    spark.createDataFrame([(json.dumps(meta),)], "value string") \
        .write.mode("overwrite").text(f"{path}/meta")
    return path


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    meta = json.loads(spark.read.text(f"{path}/meta", wholetext=True).first()[0])
    return Bundle(
        model=PipelineModel.load(f"{path}/forecaster"), model_path=f"{path}/forecaster",
        feature_columns=meta["feature_columns"], imputed=meta["imputed"],
        type_encoding=meta["type_encoding"], train_end_date=meta["train_end_date"],
        segmentation=SegmentModel.from_json(json.dumps(meta["segmentation"])),
        profiles=spark.read.parquet(f"{path}/profiles"))


CHAMPION_SCHEMA = "run_id string, model_path string, promoted_at timestamp"


def promote(spark: SparkSession, log: str, run_id: str, model_path: str) -> None:
    """Make a saved bundle the champion."""
    if not path_exists(spark, f"{model_path}/meta/_SUCCESS"):
        raise ValueError(f"no whole bundle at {model_path}")
    row = (run_id, model_path, dt.datetime.now(dt.timezone.utc))
    spark.createDataFrame([row], CHAMPION_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def champion(spark: SparkSession, log: str) -> str | None:
    """Path of the bundle that was promoted last; None before the first."""
    if not path_exists(spark, log):
        return None
    last = spark.read.schema(CHAMPION_SCHEMA).parquet(log).selectExpr("max_by(model_path, struct(promoted_at, run_id))")
    return last.first()[0]
