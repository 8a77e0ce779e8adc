"""Segmentation: profiles, Yeo-Johnson, scaling, PCA, K-Means, silhouette.

Fitted parameters are a handful of numbers per profile column; they come to the
driver and go back into the plan as literals, so that every transform is a
plain projection.
"""

from __future__ import annotations

import dataclasses
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..config import PROFILE_FEATURES, Keys
from ..functions.scalar import yeo_johnson
from ..session import materialize


@dataclass(frozen=True)
class SegmentParams:
    """Profile columns, projection and K-Means; the elbow curve runs to `elbow_max_k`."""

    features: tuple[str, ...] = PROFILE_FEATURES
    pca_components: int = 2
    n_clusters: int = 4
    elbow_max_k: int = 10
    restarts: int = 10
    random_state: int = 42


def store_profiles(master: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """Per store: mean sales, size, mean markdown value, mean unemployment.
    Size is constant within a store once store keys are unique."""
    return (master.where(F.col(keys.entity).isNotNull()).groupBy(keys.entity).agg(
        F.avg(keys.value).alias("Weekly_Sales"), F.min("Size").alias("Size"),
        F.avg("Total_MD_Value").alias("Total_MD_Value"),
        F.avg("Unemployment").alias("Unemployment")))


def cluster_summary(profiles: DataFrame, *, cluster: str = "Cluster", keys: Keys = Keys(),
                    digits: int = 2) -> DataFrame:
    return profiles.groupBy(cluster).agg(
        F.count(keys.entity).alias("store_count"),
        F.bround(F.avg("Weekly_Sales"), digits).alias("avg_weekly_sales"),
        F.bround(F.avg("Size"), digits).alias("avg_size"),
        F.bround(F.avg("Unemployment"), digits).alias("avg_unemployment"))


def attach_clusters(df: DataFrame, profiles: DataFrame, *, keys: Keys = Keys(),
                    cluster: str = "Cluster") -> DataFrame:
    """Adds each row's segment; a store without a profile gets null."""
    return df.join(profiles.select(keys.entity, cluster), keys.entity, "left")


# ---- Yeo-Johnson ---------------------------------------------------------

def long_form(df: DataFrame, columns: Sequence[str], signed: Sequence[str] = ()) -> DataFrame:
    """(column_name, signed, x): one row per present value of each column."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(c in signed).alias("signed"),
                      F.col(c).cast("double").alias("x")) for c in columns]
    return df.select(F.inline(F.array(*cells))).where("x IS NOT NULL")


def yeo_johnson_loglik(long: DataFrame, grids: dict[str, Sequence[float]]) -> DataFrame:
    """(column_name, lam, loglik) for every column of a long form and each of its
    grid points, in one pass: the grid, a few dozen rows, goes to every task, and
    the sums are partially aggregated before the shuffle."""
    grid = long.sparkSession.createDataFrame(
        [(c, float(lam)) for c, points in grids.items() for lam in points],
        "column_name string, lam double")
    x, lam = F.col("x"), F.col("lam")
    psi = F.when(F.col("signed"), yeo_johnson(x, lam)).otherwise(
        yeo_johnson(x, lam, centred=False))
    jac = F.signum(x) * F.log1p(F.abs(x))
    stats = long.join(F.broadcast(grid), "column_name").groupBy("column_name", "lam").agg(
        F.count("x").alias("n"), F.var_pop(psi).alias("v"), F.sum(jac).alias("j"))
    return stats.select("column_name", "lam",
                        (-F.col("n") / 2 * F.ln("v") + (F.col("lam") - 1) * F.col("j"))
                        .alias("loglik")).where("v > 0")


def best_lambda(loglik: DataFrame) -> DataFrame:
    """(column_name, lam, loglik) of the highest likelihood per column."""
    best = loglik.groupBy("column_name").agg(
        F.max(F.struct("loglik", (-F.col("lam")).alias("neg"))).alias("b"))
    return best.select("column_name", (-F.col("b.neg")).alias("lam"),
                       F.col("b.loglik").alias("loglik"))


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str], *, signed: Sequence[str] | None = None,
                    low: float = -5.0, high: float = 5.0, points: int = 41, tolerance: float = 1e-4,
                    limit: float = 25.0) -> dict[str, float]:
    """Maximum-likelihood lambda per column: a coarse grid, widened while an edge
    wins, then refined around the winner. A constant column gets 1 (identity)."""
    signed = negative_columns(df, columns) if signed is None else signed
    span = {c: (low, high) for c in columns}
    long = long_form(df, columns, signed)
    found: dict[str, float] = {}
    while span:
        grids = {c: np.linspace(a, b, points).tolist() for c, (a, b) in span.items()}
        rows = best_lambda(yeo_johnson_loglik(long, grids)).collect()
        best = {r["column_name"]: r["lam"] for r in rows}
        following = {}
        for c, (a, b) in span.items():
            step, lam = (b - a) / (points - 1), best.get(c)
            if lam is None:
                found[c] = 1.0
            elif lam <= a + step / 2 and a > -limit:
                following[c] = (max(a - (b - a), -limit), a + step)
            elif lam >= b - step / 2 and b < limit:
                following[c] = (b - step, min(b + (b - a), limit))
            elif step > tolerance:
                following[c] = (lam - step, lam + step)
            else:
                found[c] = lam
        span = following
    beyond = [c for c in columns if abs(found[c]) >= limit - tolerance]
    if beyond:
        raise ValueError(f"no lambda within {limit} maximises the likelihood of {beyond}")
    return {c: found[c] for c in columns}


def negative_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    lows = df.agg(*[F.min(c).alias(c) for c in columns]).first()
    return [c for c in columns if lows[c] is not None and lows[c] < 0]


def apply_yeo_johnson(df: DataFrame, lambdas: dict[str, float], *,
                      uncentred: Sequence[str] = ()) -> DataFrame:
    """Transforms columns in place. For those in `uncentred`, which must hold no
    negatives, the additive constant is left out; scaling removes it anyway, and
    without it small spreads survive in floating point."""
    return df.withColumns({
        c: yeo_johnson(F.col(c).cast("double"), lam, centred=c not in uncentred)
        for c, lam in lambdas.items()})


# ---- scaling and PCA -----------------------------------------------------

def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, population deviation)}; a constant column has scale 1."""
    row = df.agg(*[f(c).alias(f"{p}{i}") for i, c in enumerate(columns)
                   for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]], *, suffix: str = ""
                 ) -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s)
                           for c, (m, s) in scaler.items()})


def fit_pca(df: DataFrame, columns: Sequence[str], k: int
            ) -> tuple[list[list[float]], list[float]]:
    """(loadings[component][column], explained variance ratios). The loading of
    largest magnitude is positive in each component."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="__x").transform(df).select("__x")
    model = PCA(k=k, inputCol="__x", outputCol="__pc").fit(vectors)
    axes = model.pc.toArray().T
    signs = [1.0 if a[np.argmax(np.abs(a))] >= 0 else -1.0 for a in axes]
    return ([(s * a).tolist() for s, a in zip(signs, axes)],
            [float(v) for v in model.explainedVariance.toArray()])


def apply_pca(df: DataFrame, columns: Sequence[str], loadings: Sequence[Sequence[float]]
              ) -> DataFrame:
    def score(axis: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for c, w in zip(columns, axis):
            total = total + F.col(c) * F.lit(float(w))
        return total
    return df.withColumns({f"pc{i + 1}": score(a) for i, a in enumerate(loadings)})


# ---- clustering ----------------------------------------------------------

def wcss(df: DataFrame, columns: Sequence[str], *, cluster: str = "Cluster") -> DataFrame:
    """Per cluster: rows and the sum of squared distances to its centre."""
    inertia = F.lit(0.0)
    for c in columns:
        inertia = inertia + F.var_pop(c) * F.count(c)
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), inertia.alias("inertia"))


def _assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="__x").transform(df)


def _best_fits(points: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int,
               restarts: int, parallelism: int) -> dict[int, tuple[KMeansModel, float]]:
    """{k: (model, cost)}: for each k the best of `restarts` runs. The runs do not
    depend on each other; a few at a time are submitted, as Spark's own
    cross-validation does."""
    vectors = _assembled(points, columns).select("__x").persist()

    def fit(task: tuple[int, int]) -> tuple[int, KMeansModel, float]:
        k, start = task
        model = KMeans(k=k, seed=start, featuresCol="__x", predictionCol="__raw").fit(vectors)
        return k, model, model.summary.trainingCost

    best: dict[int, tuple[KMeansModel, float]] = {}
    try:
        vectors.count()
        tasks = [(k, seed + i) for k in ks for i in range(restarts)]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            for k, model, cost in pool.map(inheritable_thread_target(points.sparkSession)(fit),
                                           tasks):
                if k not in best or cost < best[k][1]:
                    best[k] = (model, cost)
    finally:
        vectors.unpersist()
    return best


def fit_kmeans(points: DataFrame, columns: Sequence[str], k: int, *, seed: int = 42,
               restarts: int = 10, parallelism: int = 4) -> tuple[KMeansModel, float]:
    """The best of `restarts` runs by training cost."""
    return _best_fits(points, columns, [k], seed, restarts, parallelism)[k]


def elbow_curve(points: DataFrame, columns: Sequence[str], *, max_k: int = 10, seed: int = 42,
                restarts: int = 10, parallelism: int = 4) -> list[float]:
    """Inertia for k = 1 .. max_k. One cluster needs no search: its inertia is
    the total variance."""
    n = points.count()
    total = points.select(*columns, F.lit(0).alias("__one"))
    curve = [wcss(total, columns, cluster="__one").first()["inertia"]]
    ks = range(2, min(max_k, n) + 1)
    fits = _best_fits(points, columns, ks, seed, restarts, parallelism) if ks else {}
    return curve + [fits[k][1] for k in ks]


def silhouette(points: DataFrame, columns: Sequence[str], *, cluster: str = "Cluster",
               metric: str = "squared_euclidean") -> DataFrame:
    """One row: (silhouette, n_points, n_clusters, metric) of the labelled points.

    The caller names the metric; no size changes it. 'squared_euclidean' is exact
    from per-cluster sums. 'euclidean' sums the distances between blocks of points;
    bounds from the cluster centres leave out clusters that cannot be the nearest to
    any point of a block. Points stay distributed, and clusters may be of any number.
    Null with one cluster only, or with no more points than clusters. Points without
    a label are left out.
    """
    if metric not in ("euclidean", "squared_euclidean"):
        raise ValueError(f"unknown metric {metric}")
    spark, axes = points.sparkSession, [f"x{i}" for i in range(len(columns))]
    data = materialize(points.where(F.col(cluster).isNotNull()).select(
        F.col(cluster).alias("c"), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, axes)]), "silhouette-points")
    spread = F.lit(0.0)
    for x in axes:
        spread = spread + F.var_pop(x)
    stats = materialize(data.groupBy("c").agg(F.count(F.lit(1)).alias("n"), spread.alias("v"),
                                              *[F.avg(x).alias(f"m_{x}") for x in axes]), "silhouette-clusters")
    n, k = stats.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    described = [F.lit(n).cast("bigint").alias("n_points"), F.lit(k).cast("int").alias("n_clusters"),
                 F.lit(metric).alias("metric")]
    if k < 2 or n <= k:
        return spark.range(1).select(F.lit(None).cast("double").alias("silhouette"), *described)
    per_point = (_euclidean if metric == "euclidean" else _squared_euclidean)(data, stats, axes)
    return per_point.agg(F.avg("s").alias("silhouette")).select("silhouette", *described)


#: Points of a block, and clusters that are broadcast at once.
BLOCK, CLUSTERS = 2048, 1 << 15


def _cluster_parts(stats: DataFrame, axes: Sequence[str]):
    """Broadcasts of (labels, sizes, variances, centres), of CLUSTERS clusters at most each."""
    held: list = []

    def sent():
        return stats.sparkSession.sparkContext.broadcast((
            [r["c"] for r in held], np.array([r["n"] for r in held], float), np.array([r["v"] for r in held], float),
            np.array([[r[f"m_{x}"] for x in axes] for r in held], float).reshape(len(held), len(axes))))

    for r in stats.toLocalIterator():
        held.append(r)
        if len(held) == CLUSTERS:
            yield sent()
            held = []
    if held:
        yield sent()


def _score(a: Column, b: Column, n_own: Column) -> Column:
    top = F.greatest(a, b)
    return F.when((n_own == 1) | (top == 0), F.lit(0.0)).otherwise((b - a) / top)


def _squared_euclidean(data: DataFrame, stats: DataFrame, axes: Sequence[str]) -> DataFrame:
    """A score per point. Mean squared distance to a cluster = |x - centre|^2 + the cluster's
    variance, so per-cluster sums suffice; a pass over the points for each broadcast."""
    rows = data.select("*", F.lit(None).cast("double").alias("a"), F.lit(float("inf")).alias("b"))
    for part in _cluster_parts(stats, axes):
        def nearest(frames, part=part):
            labels, sizes, spreads, centres = part.value
            code = {c: i for i, c in enumerate(labels)}
            block = max(1, (1 << 20) // len(labels))
            for frame in frames:
                for start in range(0, len(frame), block):
                    out = frame.iloc[start:start + block].copy()
                    far = np.zeros((len(out), len(labels))) + spreads
                    for i, x in enumerate(axes):
                        far += np.subtract.outer(out[x].to_numpy(), centres[:, i]) ** 2
                    own = out["c"].map(code).to_numpy(dtype=float)
                    mine = np.flatnonzero(~np.isnan(own))
                    at = own[mine].astype(int)
                    a = out["a"].to_numpy(dtype=float).copy()
                    a[mine] = far[mine, at] * sizes[at] / np.maximum(sizes[at] - 1, 1)
                    far[mine, at] = np.inf
                    yield out.assign(a=a, b=np.minimum(out["b"].to_numpy(), far.min(axis=1)))

        rows = rows.mapInPandas(nearest, rows.schema)
    return rows.join(stats.select("c", "n"), "c").select(_score(F.col("a"), F.col("b"), F.col("n")).alias("s"))


def _euclidean(data: DataFrame, stats: DataFrame, axes: Sequence[str]) -> DataFrame:
    """A score per point, from sums of distances between blocks of at most BLOCK points.

    A block's mean distance to a cluster is at least that of its points to the centre,
    and at most the root of that squared plus the variance. A cluster whose least
    exceeds another one's most for the whole block is no candidate.
    """
    kind = dict(data.dtypes)["c"]
    sizes = stats.select("c", "n", F.ceil(F.col("n") / BLOCK).cast("long").alias("parts"))
    numbered = data.withColumn("id", F.monotonically_increasing_id()).join(sizes, "c")
    blocks = materialize(numbered.groupBy("c", F.expr("pmod(id, parts)").alias("b")).agg(
        F.collect_list(F.array(*axes)).alias("xs")), "silhouette-blocks")

    def bounds(frame, part):
        """(label, block, lower bounds, upper bounds) of each block against the clusters of a part."""
        labels, _, spreads, centres = part
        for c, b, xs in zip(frame["c"], frame["b"], frame["xs"], strict=True):
            points = np.stack(xs)
            middle = points.mean(axis=0)
            radius = float(np.sqrt(((points - middle) ** 2).sum(axis=1).max()))
            far = np.sqrt(((centres - middle) ** 2).sum(axis=1))
            other = np.array([x != c for x in labels])
            yield c, b, np.maximum(far - radius, 0), np.where(other, np.sqrt((far + radius) ** 2 + spreads), np.inf), other

    parts = list(_cluster_parts(stats, axes))
    limits = blocks.select("c", "b", "xs", F.lit(float("inf")).alias("most"))
    for part in parts:
        def least(frames, part=part):
            for frame in frames:
                top = [up.min() for _, _, _, up, _ in bounds(frame, part.value)]
                yield frame.assign(most=np.minimum(frame["most"], top))
        limits = limits.mapInPandas(least, limits.schema)
    if len(parts) > 1:
        limits = materialize(limits, "silhouette-limits")
    found = []
    for part in parts:
        def near(frames, part=part):
            labels = part.value[0]
            for frame in frames:
                rows = [(c, b, labels[i]) for (c, b, low, _, other), most in zip(bounds(frame, part.value), frame["most"])
                        for i in np.flatnonzero((low <= most * (1 + 1e-9)) | ~other)]
                yield pd.DataFrame(rows, columns=["c", "b", "other"])
        found.append(limits.mapInPandas(near, f"c {kind}, b long, other {kind}"))
    candidates = reduce(DataFrame.unionByName, found)
    pairs = (candidates.join(sizes.select(F.col("c").alias("other"), "parts"), "other")
             .withColumn("b2", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("parts"))
    right = blocks.select(F.col("c").alias("other"), F.col("b").alias("b2"), F.col("xs").alias("ys"))

    def summed(frames):
        for frame in frames:
            rows = []
            for xs, ys in zip(frame["xs"], frame["ys"], strict=True):
                x, y = np.stack(xs), np.stack(ys)
                far = np.zeros((len(x), len(y)))
                for i in range(x.shape[1]):
                    far += np.subtract.outer(x[:, i], y[:, i]) ** 2
                rows.append(np.sqrt(far).sum(axis=1))
            yield frame[["c", "b", "other"]].assign(sums=rows)

    sums = (pairs.join(right, ["other", "b2"]).join(blocks, ["c", "b"])
            .select("c", "b", "other", "xs", "ys").mapInPandas(summed, f"c {kind}, b long, other {kind}, sums array<double>")
            .select("c", "b", "other", F.posexplode("sums").alias("at", "d"))
            .groupBy("c", "b", "at", "other").agg(F.sum("d").alias("d")))
    own = F.col("c") == F.col("other")
    each = (sums.join(stats.select(F.col("c").alias("other"), "n"), "other").groupBy("c", "b", "at").agg(
        F.max(F.when(own, F.col("d") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~own, F.col("d") / F.col("n"))).alias("b_mean"), F.max(F.when(own, F.col("n"))).alias("n_own")))
    return each.select(_score(F.col("a"), F.col("b_mean"), F.col("n_own")).alias("s"))


@dataclass
class SegmentModel:
    """Fitted segmentation: plain numbers and the centres, in final labels."""

    features: list[str]
    signed: list[str]
    lambdas: dict[str, float]
    scaler: dict[str, tuple[float, float]]
    loadings: list[list[float]]
    explained: list[float]
    centres: list[list[float]]

    def project(self, profiles: DataFrame) -> DataFrame:
        """Adds pc1, pc2, ...; a missing profile value counts as the mean."""
        work = [f"__{c}" for c in self.features]

        def scaled(c: str) -> Column:
            mean, sd = self.scaler[c]
            bent = yeo_johnson(F.col(c).cast("double"), self.lambdas[c],
                               centred=c in self.signed)
            return F.coalesce((bent - F.lit(mean)) / F.lit(sd), F.lit(0.0))

        df = profiles.withColumns({w: scaled(c) for w, c in zip(work, self.features)})
        return apply_pca(df, work, self.loadings).drop(*work)

    def assign(self, projected: DataFrame) -> DataFrame:
        """Adds Cluster: the nearest centre."""
        dist = []
        for i, centre in enumerate(self.centres):
            d = F.lit(0.0)
            for j, m in enumerate(centre):
                d = d + F.pow(F.col(f"pc{j + 1}") - F.lit(float(m)), 2)
            dist.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
        return projected.withColumn("Cluster", F.array_min(F.array(*dist))["i"])

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "SegmentModel":
        raw = json.loads(text)
        raw["scaler"] = {c: tuple(v) for c, v in raw["scaler"].items()}
        return cls(**raw)


@dataclass
class SegmentationResult:
    profiles: DataFrame
    model: SegmentModel
    silhouette: float | None
    pca_variance_explained: float
    wcss: list[float]


def fit_projection(profiles: DataFrame, config: SegmentParams = SegmentParams()
                   ) -> SegmentModel:
    """Yeo-Johnson, scaling and PCA of the profiles; no clusters yet."""
    cols = list(config.features)
    signed = negative_columns(profiles, cols)
    lambdas = fit_yeo_johnson(profiles, cols, signed=signed)
    bent = apply_yeo_johnson(profiles, lambdas, uncentred=[c for c in cols if c not in signed])
    scaler = fit_scaler(bent, cols)
    scaled = apply_scaler(bent, scaler).fillna(0.0, subset=cols)
    loadings, explained = fit_pca(scaled, cols, min(config.pca_components, len(cols)))
    return SegmentModel(cols, signed, lambdas, scaler, loadings, explained, [])


def fit_segmentation(master: DataFrame, config: SegmentParams = SegmentParams(), *,
                     keys: Keys = Keys(), elbow: bool = True, score: bool = True
                     ) -> SegmentationResult:
    """Profiles -> clusters. Labels are ordered by mean sales, so that a label
    means the same from run to run."""
    profiles = materialize(store_profiles(master, keys=keys), "profiles")
    n = profiles.count()
    if n == 0:
        raise ValueError("no store profiles to segment")
    model = fit_projection(profiles, config)
    axes = [f"pc{i + 1}" for i in range(len(model.loadings))]
    points = model.project(profiles)
    k = min(config.n_clusters, n)
    if k > 1:
        km, _ = fit_kmeans(points, axes, k, seed=config.random_state, restarts=config.restarts)
        raw = [c.tolist() for c in km.clusterCenters()]
    else:
        raw = [[0.0] * len(axes)]
    model.centres = raw
    means = {r["Cluster"]: r["m"] for r in
             model.assign(points).groupBy("Cluster").agg(F.avg("Weekly_Sales").alias("m"))
             .collect()}
    order = sorted(range(len(raw)), key=lambda i: (means.get(i, math.inf), i))
    model.centres = [raw[i] for i in order]
    labelled = model.assign(points)
    curve = (elbow_curve(points, axes, max_k=config.elbow_max_k, seed=config.random_state,
                         restarts=config.restarts) if elbow else [])
    sil = silhouette(labelled, axes).first()["silhouette"] if score else None
    return SegmentationResult(labelled, model, sil, sum(model.explained), curve)


def model_frame(spark: SparkSession, model: SegmentModel) -> DataFrame:
    """The fitted parameters as a one-row table."""
    return spark.createDataFrame([(model.to_json(),)], "segmentation string")
