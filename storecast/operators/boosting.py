"""Boosted regression trees, a Spark tree a round, that can stop and go on.

A round fits one tree to the residuals of the rounds before it, on its own share
of rows and its own subset of columns. After each block of rounds the rows are
written with their prediction so far, next to the trees and the errors of every
round. That table ends the lineage, and it is what a later run goes on from: no
round is ever fitted twice.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_path

LABEL, VALID, SO_FAR = "__label", "__valid", "__so_far"
ROUND_SCHEMA = "round int, n_train bigint, train_mse double, n_valid bigint, valid_mse double"


@dataclass(frozen=True)
class BoostParams:
    """Shares are of rows and of columns, each per tree. Patience counts rounds without a
    better validation error; 0 grows all trees. Every `block` rounds the state is written."""

    rounds: int = 1000
    depth: int = 7
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    patience: int = 50
    seed: int = 42
    bins: int = 32
    block: int = 20


def first_stall(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """(number of rounds up to the best error, whether `patience` rounds followed it
    without a better one). Rounds after the first such stall do not count."""
    best, at = float("inf"), 0
    for i, e in enumerate(errors):
        if e < best:
            best, at = e, i
        elif i - at >= patience:
            return at + 1, True
    return at + 1, False


def ensemble(spark: SparkSession, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float],
             features: str, prediction: str) -> GBTRegressionModel:
    """The trees as one model that Spark ML saves, loads and scores."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    array = gateway.new_array(kind, len(trees))
    for i, t in enumerate(trees):
        array[i] = t._java_obj
    factors = gateway.new_array(jvm.double, len(trees))
    for i, w in enumerate(weights):
        factors[i] = float(w)
    uid = f"GBTRegressionModel_{random.getrandbits(48):012x}"
    java = jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, array, factors)
    model = GBTRegressionModel(java)
    model._resetUid(uid)
    java.set(java.featuresCol(), features)
    java.set(java.predictionCol(), prediction)
    return model


class BoostState:
    """What is on disk below `path`: a folder per finished block with `rows` (features, label,
    part, prediction so far), `model` (all trees) and `rounds` (an error row per round).
    `rounds` is written last: a block without it does not count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def folder(self, rounds: int) -> str:
        return f"{self.path}/after-{rounds:06d}"

    def finished(self, block: int, most: int) -> int:
        """Rounds of the last finished block; -1 without any."""
        done = -1
        for n in [0, *range(block, most + block, block)]:
            n = min(n, most)
            if not path_exists(self.spark, f"{self.folder(n)}/rounds/_SUCCESS"):
                break
            done = n
        return done

    def rows(self, rounds: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder(rounds)}/rows")

    def rounds(self, rounds: int) -> DataFrame:
        return self.spark.read.schema(ROUND_SCHEMA).parquet(f"{self.folder(rounds)}/rounds")

    def model(self, rounds: int) -> GBTRegressionModel:
        return GBTRegressionModel.load(f"{self.folder(rounds)}/model")


def boost(rows: DataFrame, path: str, params: BoostParams = BoostParams(), *, features: str,
          prediction: str = "prediction", size: int) -> tuple[GBTRegressionModel, DataFrame]:
    """(model of the rounds up to the best, a row of errors per round grown).

    `rows` has `features` (a vector of `size` numbers), the label and a flag of the
    validation rows, which no tree sees. The first tree is the mean label; every
    other counts with `rate`. If `path` holds finished blocks of an earlier run
    over the same rows and parameters, `rows` is not read: rounds go on after
    them. Patience looks at every round, so at most a block is grown too many.
    """
    spark, state = rows.sparkSession, BoostState(rows.sparkSession, path)
    done = state.finished(params.block, params.rounds)
    if done < 0:
        base = DecisionTreeRegressor(featuresCol=features, labelCol=LABEL, predictionCol=SO_FAR, maxDepth=0)
        mean = base.fit(rows.where(~F.col(VALID)).select(features, LABEL))
        _finish(state, 0, [mean], params, features, prediction,
                mean.transform(rows).select(features, LABEL, VALID, SO_FAR), [], [SO_FAR])
        done = 0
    model = state.model(done)
    trees = [t for t in model.trees]
    known = [tuple(r) for r in state.rounds(done).orderBy("round").collect()]

    def stalled() -> bool:
        errors = [r[4] for r in known[1:]]
        return bool(params.patience) and None not in errors and first_stall(errors, params.patience)[1]

    while done < params.rounds and not stalled():
        # Kept in memory for the passes of the block; what is lost is read again from the table.
        start, names = state.rows(done).persist(), []
        block = min(params.block, params.rounds - done)
        fresh: list[DecisionTreeRegressionModel] = []
        for k in range(block):
            fresh.append(_round(start, fresh, done + k + 1, params, features, size))
        grown = start
        for k, tree in enumerate(fresh):  # each round's prediction, for its errors
            grown = tree.copy({tree.featuresCol: features, tree.predictionCol: f"__t{k}"}).transform(grown)
            step = F.col(names[-1] if names else SO_FAR) + params.rate * F.col(f"__t{k}")
            grown, names = grown.withColumn(f"__p{k}", step), [*names, f"__p{k}"]
        trees += fresh
        _finish(state, done + block, trees, params, features, prediction, grown, known, names)
        start.unpersist()
        remove_path(spark, f"{state.folder(done)}/rows")
        done += block
        known = [tuple(r) for r in state.rounds(done).orderBy("round").collect()]

    errors = [r[4] for r in known[1:]]
    best = first_stall(errors, params.patience)[0] if params.patience and errors and None not in errors else done
    kept = ensemble(spark, trees[:best + 1], [1.0, *[params.rate] * best], features, prediction)
    return kept, state.rounds(done)


def _round(start: DataFrame, fresh: list, number: int, params: BoostParams, features: str, size: int
           ) -> DecisionTreeRegressionModel:
    """One tree on the residuals after the block's rounds so far. Columns outside its subset are
    zeroed, so that no split uses them and indices stay those of the whole vector."""
    dice = random.Random(params.seed * 1_000_003 + number)
    subset = set(dice.sample(range(size), max(1, round(params.columns * size))))
    rows = start.where(~F.col(VALID))
    if params.rows < 1:
        rows = rows.sample(False, params.rows, seed=dice.getrandbits(31))
    if fresh:
        spark = start.sparkSession
        rows = ensemble(spark, fresh, [params.rate] * len(fresh), features, "__block").transform(rows)
        rows = rows.withColumn("__residual", F.col(LABEL) - F.col(SO_FAR) - F.col("__block"))
    else:
        rows = rows.withColumn("__residual", F.col(LABEL) - F.col(SO_FAR))
    mask = ElementwiseProduct(scalingVec=Vectors.dense([float(i in subset) for i in range(size)]),
                              inputCol=features, outputCol="__masked")
    return DecisionTreeRegressor(featuresCol="__masked", labelCol="__residual", maxDepth=params.depth,
                                 maxBins=params.bins, seed=dice.getrandbits(31)
                                 ).fit(mask.transform(rows).select("__masked", "__residual"))


def _finish(state: BoostState, rounds: int, trees: list, params: BoostParams, features: str,
            prediction: str, grown: DataFrame, known: list[tuple], names: list[str]) -> None:
    """Write a block: rows, trees, and at the end the errors of all rounds. The errors of
    the block's rounds are observed while the rows are written, in the same pass."""
    spark, folder, seen = state.spark, state.folder(rounds), Observation()
    parts = [F.count_if(~F.col(VALID)).alias("nt"), F.count_if(VALID).alias("nv")]
    for i, c in enumerate(names):
        miss = (F.col(LABEL) - F.col(c)) ** 2
        parts += [F.avg(F.when(~F.col(VALID), miss)).alias(f"t{i}"), F.avg(F.when(F.col(VALID), miss)).alias(f"v{i}")]
    (grown.observe(seen, *parts).select(features, LABEL, VALID, F.col(names[-1]).alias(SO_FAR))
     .write.mode("overwrite").parquet(f"{folder}/rows"))
    got, first = seen.get, rounds - len(names) + 1
    rows = [*known, *[(first + i, got["nt"], got[f"t{i}"], got["nv"], got[f"v{i}"]) for i in range(len(names))]]
    ensemble(spark, trees, [1.0, *[params.rate] * (len(trees) - 1)], features, prediction
             ).write().overwrite().save(f"{folder}/model")
    spark.createDataFrame(rows, ROUND_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/rounds")


def carried_difference(state: BoostState, rounds: int, features: str, *, within: float = 1e-6) -> DataFrame:
    """(n_rows, n_train, n_rounds, n_apart): over the rows of a saved block, in how many the
    prediction carried along differs from that of the saved trees. None does, unless
    a tree was counted twice or not at all."""
    model = state.model(rounds)
    both = model.transform(state.rows(rounds))
    apart = F.abs(F.col(model.getPredictionCol()) - F.col(SO_FAR)) > within * F.greatest(F.lit(1.0), F.abs(SO_FAR))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col(VALID)).alias("n_train"),
                    F.lit(rounds).alias("n_rounds"), F.count_if(apart).alias("n_apart"))
