"""Boosted-tree demand forecast: model frame, training, scoring, importance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FORECAST_FEATURES, MARKDOWNS
from ..session import scratch_path
from .boosting import LABEL, VALID, BoostParams, boost
from .features import encode_type
from .master import impute_markdowns, split_by_date
from .metrics import regression_metrics

_MODEL_VECTOR = "__features"


@dataclass(frozen=True)
class ForecastParams:
    """The boosted trees: shares are of rows and of columns per tree. Patience counts
    rounds without a better validation error; 0 grows all trees."""

    feature_columns: tuple[str, ...] = FORECAST_FEATURES
    max_depth: int = 7
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    n_estimators: int = 1000
    early_stopping_rounds: int = 50
    validation: str = "train_tail"
    random_state: int = 42


def model_frame(master: DataFrame, mapping: dict[str, int] | None = None, *,
                markdowns: Sequence[str] = MARKDOWNS) -> tuple[DataFrame, dict[str, int]]:
    """Type encoded (by a saved mapping, or one made here) and markdowns filled."""
    df, mapping = encode_type(master, mapping)
    return impute_markdowns(df, markdowns), mapping


@dataclass
class ForecastResult:
    model: PipelineModel
    feature_columns: list[str]
    type_encoding: dict[str, int]
    train_end_date: str
    n_trees: int
    metrics: dict[str, float]
    imputed: list[str] = field(default_factory=list)
    rounds: DataFrame | None = None


def _nullable(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with a missing value anywhere in `df`, from one aggregation."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(c).alias(c) for c in features]).first()
    empty = [c for c in features if row["__n"] and row[c] == 0]
    if empty:
        raise ValueError(f"features without any value: {empty}")
    return [c for c in features if row[c] < row["__n"]]


def _preparation(features: Sequence[str], impute: Sequence[str]) -> list:
    """Stages that put all features, and a 0/1 flag per imputed one, in a vector."""
    inputs = [f"__n_{c}" for c in features]
    numbers = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `__n_{c}`" for c in features)
    flags = "".join(f", CAST(`{c}` IS NULL AS DOUBLE) AS `__na_{c}`" for c in impute)
    stages = [SQLTransformer(statement=f"SELECT *, {numbers}{flags} FROM __THIS__")]
    if impute:
        stages.append(Imputer(strategy="median", inputCols=[f"__n_{c}" for c in impute],
                              outputCols=[f"__i_{c}" for c in impute]))
        inputs = [f"__i_{c}" if c in impute else f"__n_{c}" for c in features]
        inputs += [f"__na_{c}" for c in impute]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=_MODEL_VECTOR,
                                  handleInvalid="keep"))
    return stages


def _tail_cutoff(train: DataFrame, time: str, share: float) -> dt.date | None:
    """Date from which the last `share` of the training period's dates starts."""
    row = train.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).first()
    if row["lo"] is None or row["lo"] == row["hi"]:
        return None
    days = (row["hi"] - row["lo"]).days
    return row["hi"] - dt.timedelta(days=max(int(days * share) - 1, 0))


def train_forecaster(master: DataFrame, config: ForecastParams = ForecastParams(), *,
                     split_date: str = "2012-01-01", label: str = "Weekly_Sales",
                     time: str = "Date", tail_share: float = 0.1, state: str | None = None
                     ) -> tuple[ForecastResult, DataFrame]:
    """Train on rows before `split_date`, predict the rows from it on.

    The number of trees stops growing once the validation error has not improved
    for `early_stopping_rounds` rounds; the model is the trees up to the best round,
    none is fitted again. Validation rows, which no tree learns from, are the last
    part of the training period (`config.validation='train_tail'`), or the holdout
    itself ('holdout'). Rounds are saved below `state`; a run that finds some there,
    of the same rows and parameters, goes on after them.
    """
    spark, features = master.sparkSession, list(config.feature_columns)
    frame, mapping = model_frame(master)
    train, test = split_by_date(frame, split_date, time=time)
    train = train.where(F.col(label).isNotNull())

    impute = _nullable(train, features)
    # A column complete in training may have gaps later: impute what can be null.
    impute = [c for c in features if c in impute or c in
              ("Size", "Type_Encoded", "CPI", "Unemployment", "Temperature", "Fuel_Price",
               "Cluster")]
    prepare = Pipeline(stages=_preparation(features, impute)).fit(train)
    patience = config.early_stopping_rounds if config.early_stopping_rounds < config.n_estimators else 0
    valid = F.lit(False)
    if patience and config.validation == "holdout":
        valid = F.col(time) >= F.lit(split_date).cast("date")
        train = train.unionByName(test.where(F.col(label).isNotNull()))
    elif patience and (at := _tail_cutoff(train, time, tail_share)) is not None:
        valid = F.col(time) >= F.lit(at)
    rows = prepare.transform(train).select(
        _MODEL_VECTOR, F.col(label).cast("double").alias(LABEL), F.coalesce(valid, F.lit(False)).alias(VALID))
    booster, errors = boost(rows, state or scratch_path(spark, "boosting"), BoostParams(
        rounds=config.n_estimators, depth=config.max_depth, rate=config.learning_rate, rows=config.subsample,
        columns=config.colsample, patience=patience, seed=config.random_state),
        features=_MODEL_VECTOR, prediction="point_forecast", size=len(features) + len(impute))

    model = PipelineModel(stages=[*prepare.stages, booster])
    scored = _predict(model, test).withColumnRenamed("point_forecast", "predicted_weekly_sales")
    measured = regression_metrics(scored, actual=label).first()
    metrics = {m: measured[m] for m in ("r2", "mae", "rmse", "mape")}
    return ForecastResult(model, features, mapping, str(split_date), booster.getNumTrees - 1,
                          metrics, impute, errors), scored


def _predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select(*df.columns, "point_forecast")


def score_forecasts(model: PipelineModel, df: DataFrame, mapping: dict[str, int]) -> DataFrame:
    """Adds point_forecast. The saved type mapping applies; an unseen type or
    store is imputed like any missing value."""
    frame, _ = model_frame(df, mapping)
    return _predict(model, frame)


def feature_importance(spark: SparkSession, model_path: str, features: Sequence[str],
                       imputed: Sequence[str] = (), *, top: int = 12) -> DataFrame:
    """(feature, n_splits, gain_share) of a saved model's top features by split
    count. The tree nodes are read as the table they are saved as."""
    model = PipelineModel.load(model_path)
    booster = model.stages[-1]
    names = [*features, *[f"{c}_missing" for c in imputed]]
    gains = booster.featureImportances.toArray()  # ends at the last feature that a split uses
    table = spark.createDataFrame([(i, n, float(gains[i]) if i < len(gains) else 0.0)
                                   for i, n in enumerate(names)],
                                  "idx int, feature string, gain_share double")
    stage = len(model.stages) - 1
    folder = f"{model_path}/stages/{stage:0{len(str(len(model.stages)))}d}_{booster.uid}"
    nodes = spark.read.parquet(f"{folder}/data")
    splits = (nodes.select(F.col("nodeData.split.featureIndex").alias("idx"))
              .where("idx >= 0").groupBy("idx").agg(F.count(F.lit(1)).alias("n_splits")))
    return (table.join(splits, "idx", "left").fillna(0, subset=["n_splits"])
            .select("feature", "n_splits", "gain_share")
            .orderBy(F.desc("n_splits"), "feature").limit(top))
