"""Grouped z-score anomaly flags and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Keys
from .ordered import CHUNK, last_value, time_order, year_chunk


def flag_anomalies(df: DataFrame, *, threshold: float = 3.0, keys: Keys = Keys(),
                   fit_on: DataFrame | None = None, salts: int = 8) -> DataFrame:
    """Adds Sales_ZScore and Is_Anomaly (|z| > threshold, strictly).

    Mean and sample deviation are aggregated per series first, so a series of
    any length shrinks to one row before the shuffle, and joined back. Where the
    statistics are too many to broadcast, the join meets each series under
    `salts` salts, and so in as many tasks; adaptive execution can split those
    further. `fit_on` takes the statistics from other rows, for instance the
    training period. A series of one row has no z-score and no anomaly.
    """
    by, x = keys.series, F.col(keys.value)
    stats = (df if fit_on is None else fit_on).groupBy(*by).agg(
        F.avg(x).alias("__mean"), F.stddev_samp(x).alias("__sd"))
    salt = F.pmod(F.hash(keys.time, keys.value), F.lit(salts))
    stats = stats.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    z = (x - F.col("__mean")) / (F.col("__sd") + F.lit(1e-9))
    kept = [c for c in df.columns if c not in ("Sales_ZScore", "Is_Anomaly")]
    return (df.withColumn("__salt", salt).join(stats, [*by, "__salt"], "left")
            .select(*kept, z.alias("Sales_ZScore"))
            .withColumn("Is_Anomaly",
                        F.coalesce(F.abs("Sales_ZScore") > threshold, F.lit(False))))


def lag_and_flags(df: DataFrame, *, threshold: float = 3.0, keys: Keys = Keys(),
                  chunk: Column | None = None, unique: bool = False) -> DataFrame:
    """Sales_Lag_1, Sales_ZScore and Is_Anomaly in one shuffle of the rows.

    The same as `add_sales_lag` and `flag_anomalies` one after the other. One
    aggregation per (series, chunk) yields the chunk's last value and its
    moments; over those few rows the value carried into each chunk and the mean
    and deviation of the whole series are combined, and one join brings all of
    it back to the rows, which are already partitioned by (series, chunk).
    """
    by, x = keys.series, F.col(keys.value)
    order = time_order(keys.time)
    rows = df.withColumn(CHUNK, year_chunk(keys.time) if chunk is None else chunk)

    parts = rows.groupBy(*by, CHUNK).agg(
        last_value(keys.value, [order], [], unique, False).alias("__end"),
        F.count(x).alias("__n"), F.avg(x).alias("__m"), F.var_pop(x).alias("__v"))
    series = Window.partitionBy(*by)
    total, n = F.sum(F.col("__n") * F.col("__m")).over(series), F.sum("__n").over(series)
    # Squares around the series mean: within each chunk, and of the chunk means.
    squares = F.col("__n") * (F.col("__v") + F.pow(F.col("__m") - F.col("__mean"), 2))
    parts = (parts.withColumns({
                 "__carry": F.lag("__end").over(series.orderBy(CHUNK)),
                 "__count": n, "__mean": F.try_divide(total, n)})
             .withColumn("__sq", F.sum(squares).over(series))
             .select(*by, CHUNK, "__carry", "__mean", F.when(F.col("__count") > 1, F.sqrt(
                 F.col("__sq") / (F.col("__count") - 1))).alias("__sd")))

    inside = Window.partitionBy(*by, CHUNK).orderBy(*([order] if unique else [order, x]))
    marked = rows.withColumns({"__prev": F.lag(x).over(inside),
                               "__first": F.row_number().over(inside) == 1})
    known = F.col(by[0]).isNotNull() & F.col(by[1]).isNotNull()
    lag = F.when(known, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev")))
    z = (x - F.col("__mean")) / (F.col("__sd") + F.lit(1e-9))
    made = ("Sales_Lag_1", "Sales_ZScore", "Is_Anomaly")
    return (marked.join(parts, [*by, CHUNK], "left")
            .select(*[c for c in df.columns if c not in made],
                    F.coalesce(lag, F.lit(0.0)).alias("Sales_Lag_1"), z.alias("Sales_ZScore"))
            .withColumn("Is_Anomaly",
                        F.coalesce(F.abs("Sales_ZScore") > threshold, F.lit(False))))


def anomaly_summary(df: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """One row: anomalies, their rate, and the holiday share among them."""
    flag = F.coalesce(F.col("Is_Anomaly"), F.lit(False))
    holiday = F.coalesce(F.col(keys.holiday), F.lit(False)).cast("int")
    return df.agg(
        F.count_if(flag).alias("total_anomalies"),
        F.coalesce(F.avg(flag.cast("int")), F.lit(0.0)).alias("anomaly_rate"),
        F.coalesce(F.avg(F.when(flag, holiday)), F.lit(0.0)).alias("holiday_share_among_anomalies"))


def anomaly_triage(df: DataFrame, *, keys: Keys = Keys(), high_holiday_share: float = 0.5
                   ) -> DataFrame:
    """Per week: anomaly rate, holiday share among anomalies, and a verdict."""
    flag = F.coalesce(F.col("Is_Anomaly"), F.lit(False))
    holiday = F.coalesce(F.col(keys.holiday), F.lit(False)).cast("int")
    weekly = df.groupBy(keys.time).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(flag).alias("n_anomalies"),
        F.avg(flag.cast("int")).alias("anomaly_rate"),
        F.avg(F.when(flag, holiday)).alias("holiday_share"))
    return weekly.withColumn(
        "verdict",
        F.when(F.col("n_anomalies") == 0, "none")
        .when(F.col("holiday_share") >= high_holiday_share, "calendar_event")
        .otherwise("suspect_data"))


def anomaly_drilldown(df: DataFrame, *, entity: int, item: int, only_anomalies: bool = False,
                      keys: Keys = Keys()) -> DataFrame:
    """One series in date order, or only its anomalies. The key filter moves
    below the grouping that made the z-scores, down to the scan."""
    one = df.filter((F.col(keys.entity) == entity) & (F.col(keys.item) == item))
    if only_anomalies:
        one = one.filter("Is_Anomaly")
    return one.select(keys.time, keys.value, "Sales_ZScore", "Is_Anomaly").orderBy(keys.time)
