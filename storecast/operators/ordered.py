"""Ordered scans (previous value, forward fill) that do not put a whole group
into one task.

A group is cut into chunks by an expression that never decreases along the
order, such as the year of the date. A window runs inside each (group, chunk);
a second, small window over one row per (group, chunk) carries the state across
chunk borders. The input is shuffled once, by (group, chunk), and the carried
rows are joined back on that same partitioning. A group that holds a large
share of all rows is thereby spread over as many tasks as it has chunks. Any
expression that never decreases along the order will do: a month, a date, or a
struct of item and year.

`unique=True` says that the order has no ties within a group. The last value of
a chunk is then found by hash aggregation; otherwise ties are broken by value,
which takes a sort. Without a chunk expression a plain window over the group is
used: right for groups that are known to be short.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "__chunk"
_END_OF_TIME = "9999-12-31"


def year_chunk(time: str) -> Column:
    """Calendar year of the date column; missing dates go last."""
    return F.coalesce(F.year(F.col(time)), F.lit(9999))


def time_order(time: str) -> Column:
    """Sort key for a date column with missing dates last."""
    return F.coalesce(F.col(time), F.lit(_END_OF_TIME).cast("date"))


def _present(by: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])


def last_value(column: str, order: Sequence[Column], ties: Sequence[str], unique: bool,
                skip_missing: bool) -> Column:
    """Aggregate: `column` of the last row, or of the last row that has it."""
    c = F.col(column)
    if unique and len(order) == 1:
        return F.max_by(c, F.when(c.isNotNull(), order[0]) if skip_missing else order[0])
    row = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)],
                   *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)], c.alias("v"))
    return F.max(F.when(c.isNotNull(), row) if skip_missing else row)["v"]


def previous_value(df: DataFrame, *, by: Sequence[str], order: Sequence[Column], value: str,
                   out: str, chunk: Column | None, unique: bool = False) -> DataFrame:
    """`out` = `value` of the row before, within `by`, ordered by `order` and
    then by `value`. Null for a first row and for rows with a missing key."""
    by = list(by)
    others = [F.col(c) for c in df.columns if c != out]
    sort = list(order) if unique else [*order, F.col(value)]
    if chunk is None:
        prev = F.lag(value).over(Window.partitionBy(*by).orderBy(*sort))
        return df.select(*others, F.when(_present(by), prev).alias(out))

    keys = by + [CHUNK]
    rows = df.withColumn(CHUNK, chunk)
    ends = rows.groupBy(*keys).agg(last_value(value, order, [], unique, False).alias("__end"))
    across = Window.partitionBy(*by).orderBy(CHUNK)
    carry = ends.select(*keys, F.lag("__end").over(across).alias("__carry"))

    inside = Window.partitionBy(*keys).orderBy(*sort)
    marked = rows.withColumns({
        "__prev": F.lag(value).over(inside),
        "__first": F.row_number().over(inside) == 1,
    })
    prev = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
    return (marked.join(carry, keys, "left")
            .select(*others, F.when(_present(by), prev).alias(out)))


def forward_fill(df: DataFrame, *, by: Sequence[str], order: Sequence[Column],
                 columns: Sequence[str], chunk: Column | None, unique: bool = False) -> DataFrame:
    """Replace missing values of `columns` by the last present value before
    them within `by`. Leading gaps stay; rows with a missing key get null."""
    by, columns = list(by), list(columns)
    sort = list(order) if unique else [*order, *[F.col(c) for c in columns]]

    def running(keys: Sequence[str]) -> dict[str, Column]:
        w = (Window.partitionBy(*keys).orderBy(*sort)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return {c: F.last(c, ignorenulls=True).over(w) for c in columns}

    if chunk is None:
        filled = {c: F.when(_present(by), f) for c, f in running(by).items()}
        return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])

    keys = by + [CHUNK]
    rows = df.withColumn(CHUNK, chunk)
    ends = rows.groupBy(*keys).agg(*[
        last_value(c, order, columns, unique, True).alias(f"__end_{c}") for c in columns])
    before = (Window.partitionBy(*by).orderBy(CHUNK)
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(*keys, *[
        F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}")
        for c in columns])
    inside = rows.withColumns({f"__in_{c}": f for c, f in running(keys).items()})
    joined = inside.join(carry, keys, "left")
    filled = {c: F.when(_present(by), F.coalesce(F.col(f"__in_{c}"), F.col(f"__carry_{c}")))
              for c in columns}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
