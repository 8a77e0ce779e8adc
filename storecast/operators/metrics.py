"""Regression metrics, error columns, run comparison and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import abs_pct_error, forecast_error


def regression_metrics(df: DataFrame, *, actual: str = "Weekly_Sales",
                       forecast: str = "predicted_weekly_sales", by: Sequence[str] = ()
                       ) -> DataFrame:
    """r2, mae, rmse and mape (percent) from one aggregation, overall or per
    `by`. Rows with a missing actual or forecast do not count."""
    y, f = F.col(actual), F.col(forecast)
    e = y - f
    rows = df.where(y.isNotNull() & f.isNotNull())
    agg = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("__sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("__sst"), F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(1e-9))) * 100).alias("mape"))
    r2 = (F.when(F.col("__sst") > 0, 1 - F.col("__sse") / F.col("__sst"))
          .when(F.col("__sse") == 0, F.lit(1.0)).when(F.col("n") > 0, F.lit(0.0)))
    return agg.select(*by, "n", r2.alias("r2"), "mae", "rmse", "mape")


def stacked(df: DataFrame, forecasts: Sequence[str], *, actual: str = "Weekly_Sales") -> DataFrame:
    """(model, actual, forecast): a row for each forecast column, named by it. The
    metrics of several forecasts then take one pass, by model."""
    each = F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("forecast")) for c in forecasts])
    return df.select(actual, F.inline(each))


def forecast_errors(df: DataFrame, *, actual: str = "Weekly_Sales",
                    forecast: str = "point_forecast") -> DataFrame:
    return df.withColumns({
        "forecast_error": forecast_error(F.col(actual), F.col(forecast)),
        "abs_pct_error": abs_pct_error(F.col(actual), F.col(forecast))})


def mean_abs_pct_error(df: DataFrame) -> DataFrame:
    """One row: scored rows and the mean of their abs_pct_error."""
    return df.agg(F.count("abs_pct_error").alias("n"),
                  F.avg("abs_pct_error").alias("mean_abs_pct_error"))


def compare_runs(runs: DataFrame, *, metric: str = "rmse", time: str = "created_at",
                 run: str = "run_id", lower_is_better: bool = True) -> DataFrame:
    """Each run against the last one before it that has the metric and against the
    best before it (the champion). `promote` is true for the first run with the
    metric and for one that beats the champion; a run without the metric, such as
    a score run, is never promoted and nothing is compared with it. A runs table
    has one row per run."""
    order = Window.orderBy(time, run)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    best = (F.min if lower_is_better else F.max)(metric).over(before)
    better: Column = (F.col(metric) < best) if lower_is_better else (F.col(metric) > best)
    previous = F.last(metric, ignorenulls=True).over(before)
    return runs.select(
        "*", previous.alias("previous"), best.alias("champion"),
        (F.col(metric) - previous).alias("change"),
        F.when(F.col(metric).isNull(), False).when(best.isNull(), True).otherwise(better)
        .alias("promote"))


def macro_drift(reference: DataFrame, current: DataFrame,
                columns: Sequence[str] = ("CPI", "Unemployment"), *, bins: int = 10,
                floor: float = 1e-6) -> DataFrame:
    """Per column: mean and deviation in both periods and the population
    stability index over equal-width bins of the reference range. Values outside
    that range count in the outer bins; empty bins count as `floor`."""
    bounds = reference.agg(*[f(c).cast("double").alias(f"{p}{i}") for i, c in enumerate(columns)
                             for p, f in (("lo", F.min), ("hi", F.max))]).first()

    def summarise(df: DataFrame) -> DataFrame:
        aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
        aggs += [F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)]
        for i, c in enumerate(columns):
            lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
            width = ((hi - lo) / bins if lo is not None else 0.0) or 1.0
            at = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(
                (F.col(c) - F.lit(lo or 0.0)) / F.lit(width))))
            at = F.when(F.col(c).isNotNull(), at)
            aggs += [F.greatest(F.count_if(at == b) / F.count(c), F.lit(floor)).alias(f"b{i}_{b}")
                     for b in range(bins)]
        return df.agg(*aggs)

    ref, cur = summarise(reference).first(), summarise(current).first()
    if ref is None or cur is None:
        return reference.sparkSession.createDataFrame([], _DRIFT)
    import math
    rows = []
    for i, c in enumerate(columns):
        pairs = [(ref[f"b{i}_{b}"], cur[f"b{i}_{b}"]) for b in range(bins)]
        psi = (sum((q - p) * math.log(q / p) for p, q in pairs)
               if all(p is not None and q is not None for p, q in pairs) else None)
        rows.append((c, ref[f"m{i}"], cur[f"m{i}"], ref[f"s{i}"], cur[f"s{i}"], psi))
    return reference.sparkSession.createDataFrame(rows, _DRIFT)


def value_sketches(df: DataFrame, columns: Sequence[str], *, by: Sequence[str], k: int = 4096
                   ) -> DataFrame:
    """(by, column_name, n, total, sketch): per group and column the rows that have a
    value, their sum and a KLL quantile sketch. The table is small and mergeable: a new
    period adds its rows and no old value is read again. A sketch is exact up to `k`
    values; beyond that ranks are off by about 1.33 / k of the rows at 99 % confidence."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns]
    return (df.select(*by, F.inline(F.array(*cells))).where("x IS NOT NULL AND NOT isnan(x)")
            .groupBy(*by, "column_name")
            .agg(F.count("x").alias("n"), F.sum("x").alias("total"), F.kll_sketch_agg_double("x", k).alias("sketch")))


def quantile_drift(sketches: DataFrame, reference: Column, current: Column, *, bins: int = 10,
                   floor: float = 1e-6, k: int = 4096) -> DataFrame:
    """(column_name, n and mean of both periods, n_bins, psi) from a table of sketches; the
    two conditions choose the groups of each period. Bins lie between the quantiles of
    the reference, so each holds about the same share of it, however skewed the column;
    equal borders become one. Empty bins count as `floor`. A column without values in one
    of the periods has no row."""
    def merged(where: Column, name: str) -> DataFrame:
        return sketches.where(where).groupBy("column_name").agg(
            F.sum("n").alias(f"{name}_n"), (F.sum("total") / F.sum("n")).alias(f"{name}_mean"),
            F.kll_merge_agg_double("sketch", k).alias(name))

    at = [F.kll_sketch_get_quantile_double("ref", F.lit(i / bins)) for i in range(1, bins)]
    borders = {r["column_name"]: sorted(set(r["at"])) for r in  # bins - 1 numbers a column
               merged(reference, "ref").select("column_name", F.array(*at).alias("at")).collect()}
    both = merged(reference, "ref").join(merged(current, "cur"), "column_name")

    def ranks(side: str) -> Column:
        known = [F.when(F.col("column_name") == c, F.array(*[F.kll_sketch_get_rank_double(side, F.lit(x)) for x in own]))
                 for c, own in borders.items()]
        return F.coalesce(F.lit(None).cast("array<double>"), *known)

    def shares(side: str) -> Column:
        """Bin i lies above border i - 1 and reaches to border i; the last has no upper one."""
        upper, lower = F.concat(side, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), side)
        return F.zip_with(upper, lower, lambda hi, lo: F.greatest(hi - lo, F.lit(floor)))

    psi = F.aggregate(F.zip_with(shares("ref"), shares("cur"), lambda p, q: (q - p) * F.ln(q / p)), F.lit(0.0), lambda acc, x: acc + x)
    return (both.withColumns({"ref": ranks("ref"), "cur": ranks("cur")})
            .select("column_name", "ref_n", "cur_n", "ref_mean", "cur_mean", (F.size("ref") + 1).alias("n_bins"), psi.alias("psi")))


_DRIFT = ("column_name string, ref_mean double, cur_mean double, ref_sd double, "
          "cur_sd double, psi double")
