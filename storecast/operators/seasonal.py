"""Weekly series, seasonal baselines, and a seasonal order search that fits many
series in parallel.

The fit is conditional least squares: residuals of a long autoregression stand
in for the moving-average terms, and seasonal and plain lags enter side by
side. Its numbers differ from a state-space maximum-likelihood fit.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Keys


@dataclass(frozen=True)
class SeasonalParams:
    """Season length in weeks, and the largest orders that the search tries. `stepwise`
    goes from order to neighbouring order, else all are tried. A level is stationary
    where its KPSS statistic stays below `kpss_limit` (its 5 % point); a season is
    differenced where its strength exceeds `strength_limit`."""

    seasonal_period: int = 52
    max_p: int = 2
    max_P: int = 1
    max_q: int = 2
    max_Q: int = 1
    max_d: int = 2
    max_D: int = 1
    stepwise: bool = True
    kpss_limit: float = 0.463
    strength_limit: float = 0.64


def weekly_totals(sales: DataFrame, *, by: Sequence[str] = (), keys: Keys = Keys()) -> DataFrame:
    """(by..., Date, y): sales per week, of the whole chain or per `by`. Missing
    sales add nothing."""
    present = [F.col(c).isNotNull() for c in (*by, keys.time)]
    rows = sales
    for p in present:
        rows = rows.where(p)
    return rows.groupBy(*by, keys.time).agg(
        F.coalesce(F.sum(keys.value), F.lit(0.0)).alias("y"))


def densify(series: DataFrame, *, by: Sequence[str] = (), time: str = "Date", y: str = "y",
            step_days: int = 7, gap_value: float | None = 0.0) -> DataFrame:
    """One row per series and step from its first to its last date; steps
    without a row get `gap_value`."""
    span = series.groupBy(*by).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    grid = span.where("__lo IS NOT NULL").select(*by, F.explode(F.expr(
        f"sequence(__lo, __hi, interval {int(step_days)} days)")).alias(time))
    out = grid.join(series, [*by, time], "left")
    if gap_value is None:
        return out
    return out.withColumn(y, F.coalesce(F.col(y), F.lit(float(gap_value))))


def _series_window(by: Sequence[str], time: str) -> Window:
    # A series holds one row per date; without keys there is one short series.
    return Window.partitionBy(*(by or [F.lit(0)])).orderBy(time)


def seasonal_naive(series: DataFrame, *, by: Sequence[str] = (), time: str = "Date",
                   y: str = "y", period: int = 52) -> DataFrame:
    """Adds the value one season back and the difference to it. The series must
    be dense: the lag counts rows."""
    back = F.lag(y, period).over(_series_window(by, time))
    return series.withColumns({"seasonal_naive": back, "seasonal_diff": F.col(y) - back})


def ar1_fit(series: DataFrame, *, by: Sequence[str] = (), time: str = "Date", y: str = "y"
            ) -> DataFrame:
    """Slope, intercept and R-squared of y on the y before it, per series."""
    prev = F.lag(y).over(_series_window(by, time))
    pairs = series.withColumn("__prev", prev).where(F.col("__prev").isNotNull())
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, "__prev").alias("slope"),
        F.regr_intercept(y, "__prev").alias("intercept"), F.regr_r2(y, "__prev").alias("r2"))


# ---- order search --------------------------------------------------------

def _difference(y: np.ndarray, d: int, D: int, m: int) -> np.ndarray:
    for _ in range(D):
        y = y[m:] - y[:-m]
    for _ in range(d):
        y = np.diff(y)
    return y


def kpss_level(y: np.ndarray) -> float:
    """The KPSS statistic of level stationarity: the squared partial sums of the deviations
    from the mean, over a long-run variance with Bartlett weights up to the lag
    4 (n / 100)^(1/4). 0 for a constant or empty series."""
    n = len(y)
    e = y - y.mean() if n else y
    if not n or not np.ptp(y):
        return 0.0
    lags = min(int(4 * (n / 100) ** 0.25), n - 1)
    spread = float(e @ e) + 2 * sum((1 - j / (lags + 1)) * float(e[j:] @ e[:-j]) for j in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum()) / (n * spread) if spread > 0 else 0.0


def seasonal_strength(y: np.ndarray, m: int) -> float:
    """Share of the variance around a centred moving average of one season that the means of
    the season's phases explain, adjusted for their number: about 0 without a season
    however few seasons there are, 1 for an exact one. 0 below two seasons of such points."""
    half = m // 2
    weights = np.ones(2 * half + 1) / m
    if m % 2 == 0:
        weights[[0, -1]] /= 2
    if m < 2 or len(y) < 2 * m + 2 * half:
        return 0.0
    x = y[half:len(y) - half] - np.convolve(y, weights, "valid")
    phase = np.arange(half, len(y) - half) % m
    count = np.bincount(phase, minlength=m)
    rest = x - (np.bincount(phase, x, m) / np.maximum(count, 1))[phase]
    total = float(((x - x.mean()) ** 2).sum())
    if total <= 1e-12 * max(float(y @ y), 1e-300):
        return 0.0
    return max(0.0, 1 - (float(rest @ rest) / (len(x) - m)) / (total / (len(x) - 1)))


def _choose_differences(y: np.ndarray, cfg: SeasonalParams) -> tuple[int, int]:
    """(d, D): a seasonal difference for a strong season, then plain ones until the level is
    stationary, while enough points stay."""
    m = cfg.seasonal_period
    D = 0
    while D < cfg.max_D and len(_difference(y, 0, D, m)) >= 2 * m + 10 and (
            seasonal_strength(_difference(y, 0, D, m), m) > cfg.strength_limit):
        D += 1
    d = 0
    while d < cfg.max_d and len(_difference(y, d, D, m)) > 10 and (
            kpss_level(_difference(y, d, D, m)) > cfg.kpss_limit):
        d += 1
    return d, D


def _lags(order: tuple[int, ...], m: int) -> tuple[list[int], list[int]]:
    p, q, P, Q = order
    return (sorted({*range(1, p + 1), *[m * i for i in range(1, P + 1)]}),
            sorted({*range(1, q + 1), *[m * i for i in range(1, Q + 1)]}))


def _shifted(x: np.ndarray, lag: int, start: int) -> np.ndarray:
    return x[start - lag:len(x) - lag]


def _innovations(w: np.ndarray, m: int) -> np.ndarray:
    """Residuals of a long autoregression; zero over its start-up."""
    k = int(min(max(4, round(10 * np.log10(max(len(w), 2)))), max(len(w) // 4, 1), m))
    if len(w) <= 2 * k + 2:
        return np.zeros_like(w)
    x = np.column_stack([np.ones(len(w) - k), *[_shifted(w, i, k) for i in range(1, k + 1)]])
    beta = np.linalg.lstsq(x, w[k:], rcond=None)[0]
    return np.concatenate([np.zeros(k), w[k:] - x @ beta])


def _fit_order(w: np.ndarray, e: np.ndarray, order: tuple[int, ...], m: int, start: int):
    """(AICc, one-step fitted values of w from `start` on) or None."""
    ar, ma = _lags(order, m)
    n, k = len(w) - start, 1 + len(ar) + len(ma)
    if n - k - 2 <= 0:
        return None
    x = np.column_stack([np.ones(n), *[_shifted(w, i, start) for i in ar],
                         *[_shifted(e, i, start) for i in ma]])
    beta = np.linalg.lstsq(x, w[start:], rcond=None)[0]
    fitted = x @ beta
    sse = float(((w[start:] - fitted) ** 2).sum())
    s2 = max(sse / n, 1e-12)
    params = k + 1
    return (n * np.log(s2) + 2 * params + 2 * params * (params + 1) / max(n - params - 1, 1),
            fitted)


def _candidates(cfg: SeasonalParams, n: int) -> list[tuple[int, ...]]:
    """All (p, q, P, Q) within the limits that a series of n points can carry."""
    m = cfg.seasonal_period
    seasonal = n >= m + 30
    grid = itertools.product(range(cfg.max_p + 1), range(cfg.max_q + 1),
                             range(cfg.max_P * seasonal + 1), range(cfg.max_Q * seasonal + 1))
    return list(grid)


def _steps(order: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The neighbours of an order: one of its numbers, both plain or both seasonal ones, up or down by one."""
    moves = [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (1, 1, 0, 0), (0, 0, 1, 1)]
    return [tuple(o + s * x for o, x in zip(order, move)) for move in moves for s in (1, -1)]


def _rank_orders(y: np.ndarray, cfg: SeasonalParams):
    """[(order, d, D, aicc, fitted w)] of the orders tried, all on the same points, plus their start.

    Stepwise, four orders are tried at first and then the neighbours of the best so far,
    until none of them is better. Otherwise all are tried."""
    m = cfg.seasonal_period
    d, D = _choose_differences(y, cfg)
    w = _difference(y, d, D, m)
    orders = _candidates(cfg, len(w))
    start = max((max([0, *ar, *ma]) for ar, ma in (_lags(o, m) for o in orders)), default=0)
    if len(w) - start < 8:
        orders = [o for o in orders if o[2] == 0 and o[3] == 0]
        start = max(cfg.max_p, cfg.max_q)
    if len(w) <= start:
        return [], start
    e = _innovations(w, m)
    tried: dict[tuple[int, ...], tuple | None] = {}

    def attempt(some):
        for o in some:
            if o in allowed and o not in tried:
                fit = _fit_order(w, e, o, m, start)
                tried[o] = None if fit is None else (o, d, D, float(fit[0]), fit[1])

    def ranked():
        return [t for t in tried.values() if t is not None]

    allowed = set(orders)
    if not cfg.stepwise:
        attempt(orders)
        return ranked(), start
    top = tuple(max(o[i] for o in orders) for i in range(4))
    attempt([tuple(min(x, t) for x, t in zip(o, top)) for o in ((2, 2, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1))])
    best = None
    while ranked() and best != (now := min(ranked(), key=lambda r: (r[3], r[0]))[0]):
        best = now
        attempt(_steps(best))
    return ranked(), start


_ORDER_FIELDS = [T.StructField(c, T.IntegerType()) for c in ("p", "d", "q", "sp", "sd", "sq", "m")]


def _by_fields(series: DataFrame, by: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(c, series.schema[c].dataType) for c in by]


def _grouped(series: DataFrame, by: Sequence[str]):
    return series.groupBy(*by) if by else series.groupBy(F.lit(0).alias("__all"))


def search_orders(series: DataFrame, *, by: Sequence[str] = (), time: str = "Date", y: str = "y",
                  config: SeasonalParams = SeasonalParams()) -> DataFrame:
    """(by..., p, d, q, sp, sd, sq, m, n, aicc): every order that the search tried on
    every series; a series too short for any has one row of zeros without an AICc. One
    task call holds one series, whose length is its number of
    weeks; the candidates share its differenced values."""
    by = list(by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values(time)[y].to_numpy(dtype=float)
        ranked, _ = _rank_orders(values, config)
        rows = [(*(pdf[c].iloc[0] for c in by), o[0], d, o[1], o[2], D, o[3],
                 config.seasonal_period, len(values), aicc) for o, d, D, aicc, _ in ranked]
        if not rows:  # too short for any order: a row that says so
            rows = [(*(pdf[c].iloc[0] for c in by), 0, 0, 0, 0, 0, 0, config.seasonal_period,
                     len(values), None)]
        return pd.DataFrame(rows, columns=[*by, "p", "d", "q", "sp", "sd", "sq", "m", "n", "aicc"])

    schema = T.StructType([*_by_fields(series, by), *_ORDER_FIELDS,
                           T.StructField("n", T.LongType()), T.StructField("aicc", T.DoubleType())])
    return _grouped(series.select(*by, time, y), by).applyInPandas(fit, schema)


def unit_root_statistics(series: DataFrame, *, by: Sequence[str] = (), time: str = "Date", y: str = "y",
                         config: SeasonalParams = SeasonalParams()) -> DataFrame:
    """(by..., n, strength, kpss, kpss_diff, sd, d): what decides the differences of each series:
    its seasonal strength, and the KPSS statistics of it, seasonally differenced where
    `sd` says so, and of its first difference."""
    by = list(by)

    def measure(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values(time)[y].to_numpy(dtype=float)
        m = config.seasonal_period
        d, D = _choose_differences(values, config)
        w = _difference(values, 0, D, m)
        return pd.DataFrame([(*(pdf[c].iloc[0] for c in by), len(values), seasonal_strength(values, m),
                              kpss_level(w), kpss_level(np.diff(w)), D, d)],
                            columns=[*by, "n", "strength", "kpss", "kpss_diff", "sd", "d"])

    schema = T.StructType([*_by_fields(series, by), T.StructField("n", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("strength", "kpss", "kpss_diff")],
                           *[T.StructField(c, T.IntegerType()) for c in ("sd", "d")]])
    return _grouped(series.select(*by, time, y), by).applyInPandas(measure, schema)


def best_orders(candidates: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """The order of lowest AICc per series; ties go to the smaller order."""
    rank = ["aicc", "p", "q", "sp", "sq", "d", "sd", "m", "n"]
    best = candidates.groupBy(*by).agg(F.min(F.struct(*rank)).alias("b"))
    return best.select(*by, *[F.col(f"b.{c}") for c in
                              ("p", "d", "q", "sp", "sd", "sq", "m", "n", "aicc")])


def fit_series(series: DataFrame, *, by: Sequence[str] = (), time: str = "Date", y: str = "y",
               config: SeasonalParams = SeasonalParams()) -> DataFrame:
    """(by..., Date, y, fitted, p, d, q, sp, sd, sq, m, aicc): the best order of
    each series and its one-step in-sample values; null over the start-up."""
    by = list(by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time)
        values = pdf[y].to_numpy(dtype=float)
        m = config.seasonal_period
        ranked, start = _rank_orders(values, config)
        out = pd.DataFrame({c: pdf[c].to_numpy() for c in [*by, time, y]})
        out["fitted"] = np.nan
        if not ranked:
            return out.assign(p=0, d=0, q=0, sp=0, sd=0, sq=0, m=m, aicc=np.nan)
        o, d, D, aicc, fitted = min(ranked, key=lambda r: (r[3], r[0]))
        first = d + m * D + start
        level = values[first:] - _difference(values, d, D, m)[start:]
        out.loc[first:, "fitted"] = fitted + level
        return out.assign(p=o[0], d=d, q=o[1], sp=o[2], sd=D, sq=o[3], m=m, aicc=aicc)

    schema = T.StructType([*_by_fields(series, by), series.schema[time], series.schema[y],
                           T.StructField("fitted", T.DoubleType()), *_ORDER_FIELDS,
                           T.StructField("aicc", T.DoubleType())])
    columns = [f.name for f in schema]
    out = _grouped(series.select(*by, time, y), by).applyInPandas(
        lambda pdf: fit(pdf)[columns], schema)
    missing = F.isnan("fitted")
    return out.withColumn("fitted", F.when(~missing, F.col("fitted")))
