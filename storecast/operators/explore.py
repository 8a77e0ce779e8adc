"""The aggregates behind the exploratory charts, and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EXTERNAL_FACTORS, Keys


def store_ranking(df: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    return (df.groupBy(keys.entity).agg(F.avg(keys.value).alias("avg_sales"))
            .orderBy(F.desc("avg_sales"), keys.entity))


def seasonality(df: DataFrame, *, keys: Keys = Keys(), wide: Sequence[int] | bool = False
                ) -> DataFrame:
    """Mean sales per (Year, Week); with `wide`, one row per week and one column
    per listed year, or, if true, per year that occurs."""
    if not wide:
        grouped = df.groupBy("Year", "Week")
    else:
        grouped = df.groupBy("Week").pivot("Year", None if wide is True else list(wide))
    return grouped.agg(F.avg(keys.value).alias("avg_sales"))


def holiday_effect(df: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """Mean, count and deviation of sales per (Week, holiday flag)."""
    return df.groupBy("Week", keys.holiday).agg(
        F.avg(keys.value).alias("avg_sales"), F.count(keys.value).alias("n"),
        F.stddev_samp(keys.value).alias("sd_sales"))


def holiday_lift(df: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """Per week: mean sales on holidays and otherwise, and holiday sales over
    the mean of all non-holiday weeks."""
    x, h = F.col(keys.value), F.col(keys.holiday)
    weekly = df.groupBy("Week").agg(
        F.avg(F.when(h, x)).alias("holiday_avg"), F.avg(F.when(~h, x)).alias("regular_avg"),
        F.count(F.when(h, x)).alias("n_holiday"), F.count(F.when(~h, x)).alias("n_regular"),
        F.sum(F.when(~h, x)).alias("__regular"))
    # At most 53 rows by now: one for each ISO week.
    weeks = Window.partitionBy(F.lit(0))
    base = F.sum("__regular").over(weeks) / F.sum("n_regular").over(weeks)
    return weekly.withColumn("lift", F.try_divide(F.col("holiday_avg"), base)).drop("__regular")


def histogram(df: DataFrame, columns: Sequence[str] = EXTERNAL_FACTORS, *, bins: int = 20
              ) -> DataFrame:
    """(column_name, bin, lower, upper, n): equal-width bins from each column's
    minimum to its maximum. The bounds come from a one-row aggregation; all
    columns are then counted in one pass with partial counts per task."""
    bounds = df.agg(*[f(c).cast("double").alias(f"{p}{i}") for i, c in enumerate(columns)
                      for p, f in (("lo", F.min), ("hi", F.max))]).first()
    cells = []
    for i, c in enumerate(columns):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins or 1.0
        at = F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        at = F.when(F.col(c).isNotNull(), at)  # least() skips nulls
        cells.append(F.struct(F.lit(c).alias("column_name"), at.cast("int").alias("bin"),
                              F.lit(lo).alias("__lo"), F.lit(width).alias("__width")))
    if not cells:
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, lower double, upper double, n bigint")
    return (df.select(F.inline(F.array(*cells))).where("bin IS NOT NULL")
            .groupBy("column_name", "bin", "__lo", "__width").agg(F.count(F.lit(1)).alias("n"))
            .select("column_name", "bin",
                    (F.col("__lo") + F.col("bin") * F.col("__width")).alias("lower"),
                    (F.col("__lo") + (F.col("bin") + 1) * F.col("__width")).alias("upper"), "n"))


def run_summary(master: DataFrame, *, rules: DataFrame | None = None, keys: Keys = Keys()
                ) -> DataFrame:
    """One row: rows, stores, items, weeks, anomalies, and rules where given."""
    out = master.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(keys.entity).alias("n_stores"),
        F.countDistinct(keys.item).alias("n_depts"),
        F.countDistinct(keys.time).alias("n_weeks"),
        F.count_if(F.coalesce(F.col("Is_Anomaly"), F.lit(False))).alias("n_anomalies"))
    if rules is None:
        return out
    return out.withColumn("n_rules", F.lit(rules.count()))


def table_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, n_rows, n_present), one pass over the table."""
    names = [(f.name, f.dataType.simpleString()) for f in df.schema]
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, (c, _) in enumerate(names)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                 F.col("__n").alias("n_rows"), F.col(f"__c{i}").alias("n_present"))
        for i, (c, t) in enumerate(names)])))


def head(df: DataFrame, n: int, *, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order).limit(n)
