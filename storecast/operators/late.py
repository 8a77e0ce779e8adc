"""Lag and z-scores that take in late rows without a rebuild.

Beside the rows stands a small state table: for each series and chunk (a year) the
count, mean and squares of the values, and the last value by date. States merge: a
series' mean and deviation follow from its chunks. Late rows change the state of
their own chunks; the lag changes in those and in the next chunk of the series, whose
first row follows the last one of a changed chunk. No other row is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Keys
from .ordered import CHUNK, time_order, year_chunk

LAG = "Sales_Lag_1"
_STATE = ["__n", "__m", "__sq", "__end"]


def chunk_states(rows: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """(series..., chunk, __n, __m, __sq, __end) of rows that carry a chunk column."""
    x = F.col(keys.value)
    return rows.groupBy(*keys.series, CHUNK).agg(
        F.count(x).alias("__n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("__m"),
        F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias("__sq"),
        F.max_by(x, time_order(keys.time)).alias("__end"))


def series_moments(states: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """(series..., __count, __mean, __sd): the chunks' moments merged. Each chunk adds its
    squares around its own mean and those of its mean around the whole one."""
    whole = F.sum(F.col("__n") * F.col("__m")) / F.nullif(F.sum("__n"), F.lit(0))
    around = F.sum("__sq") + F.sum(F.col("__n") * F.col("__m") * F.col("__m")) - F.sum(F.col("__n") * F.col("__m")) * whole
    # Means are taken relative to the series' largest chunk mean, so that nothing large cancels.
    base = states.join(states.groupBy(*keys.series).agg(F.max("__m").alias("__base")), keys.series)
    moved = base.withColumn("__m", F.col("__m") - F.col("__base"))
    out = moved.groupBy(*keys.series).agg(
        F.sum("__n").alias("__count"), F.first("__base").alias("__base"), whole.alias("__mean"), around.alias("__around"))
    return out.select(*keys.series, "__count", (F.col("__base") + F.col("__mean")).alias("__mean"),
                      F.when(F.col("__count") > 1, F.sqrt(F.greatest("__around", F.lit(0.0)) / (F.col("__count") - 1))).alias("__sd"))


def _lagged(rows: DataFrame, states: DataFrame, keys: Keys) -> DataFrame:
    """The rows with the value of the row before in their series: within the chunk, or for its
    first row the last value of the chunk before, which the states hold."""
    carried = states.select(*keys.series, CHUNK, F.lag("__end").over(
        Window.partitionBy(*keys.series).orderBy(CHUNK)).alias("__carry"))
    inside = Window.partitionBy(*keys.series, CHUNK).orderBy(time_order(keys.time))
    kept = [c for c in rows.columns if c != LAG]
    marked = rows.select(*kept, F.lag(keys.value).over(inside).alias("__before"),
                         (F.row_number().over(inside) == 1).alias("__first"))
    before = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__before"))
    return (marked.join(carried, [*keys.series, CHUNK], "left")
            .select(*kept, F.coalesce(before, F.lit(0.0)).alias(LAG)))


def start(sales: DataFrame, *, keys: Keys = Keys(), chunk: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with chunk and lag, states) of a table with unique (series, time) and no missing
    series; what `absorb` goes on from. Both are plain tables to write."""
    rows = sales.withColumn(CHUNK, year_chunk(keys.time) if chunk is None else chunk)
    states = chunk_states(rows, keys=keys)
    return _lagged(rows, states, keys), states


def absorb(rows: DataFrame, states: DataFrame, late: DataFrame, *, keys: Keys = Keys(),
           chunk: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows changed or added, (series, chunk) they replace, new states).

    A late row whose key is stored replaces that row. The first result holds whole
    chunks: the touched ones, and the next one of each series after a touched one. Stored
    rows of any other chunk stay as they are; their z-scores follow from the states.
    """
    spot = [*keys.series, CHUNK]
    fresh = late.withColumn(CHUNK, year_chunk(keys.time) if chunk is None else chunk)
    touched = fresh.select(*spot).distinct()
    every = states.select(*spot).unionByName(touched).distinct()
    next_one = F.lead(CHUNK).over(Window.partitionBy(*keys.series).orderBy(CHUNK))
    after = (every.join(touched.withColumn("__touched", F.lit(True)), spot, "left")
             .withColumn("__next", next_one).where("__touched and __next is not null")
             .select(*keys.series, F.col("__next").alias(CHUNK)))
    replaced = touched.unionByName(after).distinct()

    stored = rows.join(replaced, spot, "left_semi").drop(LAG)
    whole = stored.join(fresh.select(*keys.series, keys.time), [*keys.series, keys.time], "left_anti").unionByName(
        fresh.select(*stored.columns))
    changed = chunk_states(whole.join(touched, spot, "left_semi"), keys=keys)
    now = states.join(touched, spot, "left_anti").unionByName(changed.select(*states.columns))
    return _lagged(whole, now, keys), replaced, now


def replace_chunks(rows: DataFrame, changed: DataFrame, replaced: DataFrame, *, keys: Keys = Keys()) -> DataFrame:
    """The stored rows with the changed chunks in place of the old ones. Where rows are written
    by chunk, only the partitions of `replaced` need to be."""
    return rows.join(replaced, [*keys.series, CHUNK], "left_anti").unionByName(changed.select(*rows.columns))


def flagged(rows: DataFrame, states: DataFrame, *, threshold: float = 3.0, keys: Keys = Keys()) -> DataFrame:
    """Adds Sales_ZScore and Is_Anomaly from the states alone; the rows are read once."""
    z = (F.col(keys.value) - F.col("__mean")) / (F.col("__sd") + F.lit(1e-9))
    out = rows.join(series_moments(states, keys=keys), keys.series, "left").withColumn("Sales_ZScore", z)
    return (out.withColumn("Is_Anomaly", F.coalesce(F.abs("Sales_ZScore") > threshold, F.lit(False)))
            .drop("__count", "__mean", "__sd"))
