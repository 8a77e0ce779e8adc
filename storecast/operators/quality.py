"""Quality gates: every check is one row of a check table.

Columns: table_name, check, passed, severity, observed, limit, message. A
failed check of severity 'error' makes `raise_if_failed` raise; 'warn' does not.
A check whose columns are absent is left out; the schema check names them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import MACRO_COLUMNS, MARKDOWNS, MASTER_REQUIRED, Keys
from ..functions.scalar import is_negative

CHECK_COLUMNS = ("table_name", "check", "passed", "severity", "observed", "limit", "message")

# Columns that the tables must have.
REQUIRED = {
    "sales": ("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"),
    "stores": ("Store", "Type", "Size"),
    "features": ("Store", "Date", "Temperature", "Fuel_Price", *MARKDOWNS, *MACRO_COLUMNS,
                 "IsHoliday"),
    "master": MASTER_REQUIRED,
}


@dataclass(frozen=True)
class Limits:
    """What the gates let through."""

    min_rows: int = 400_000
    min_stores: int = 40
    max_null_share: float = 0.05
    max_negative_share: float = 0.01
    required: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(REQUIRED))


def _check(df: DataFrame, table: str, check: str, *, passed: Column, observed: Column,
           limit: float | None, message: Column, severity: str = "error") -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check"),
        passed.alias("passed"), F.lit(severity).alias("severity"),
        observed.cast("double").alias("observed"),
        F.lit(limit).cast("double").alias("limit"), message.alias("message"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _has(df: DataFrame, *columns: str) -> bool:
    return not missing_columns(df, columns)


def check_schema(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: required columns present, and the row count."""
    parts = []
    for name, (df, required) in tables.items():
        absent = missing_columns(df, required)
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        message = (F.lit(f"{name} lacks the columns {absent}") if absent else
                   F.concat(F.lit(f"{name} has all its columns; rows: "), F.format_number("n", 0)))
        parts.append(_check(counted, name, "schema", passed=F.lit(not absent),
                            observed=F.lit(len(absent)), limit=0, message=message))
    return _union(parts)


def check_row_count(df: DataFrame, table: str, minimum: int) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _check(counted, table, "min_rows", passed=F.col("n") >= minimum, observed=F.col("n"),
                  limit=minimum, message=F.concat(F.lit(f"{table} needs {minimum:,} rows and has "),
                                                  F.format_number("n", 0)))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in groups of more than one, the rows beyond the first of
    each group, and the number of such groups."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return groups.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("extra_rows"),
        F.count(F.lit(1)).alias("duplicate_keys"))


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    dup = duplicate_counts(df, keys)
    return _check(dup, table, "unique_key", passed=F.col("duplicate_rows") == 0,
                  observed=F.col("duplicate_rows"), limit=0,
                  message=F.concat(F.lit(f"{table}: rows that share ({', '.join(keys)}) with another: "),
                                   F.col("duplicate_rows").cast("string")))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys of `fact` that `dim` lacks. A missing key counts as an
    orphan unless `dim` has a missing key too."""
    right = dim.select(F.col(key).alias("__dim_key")).distinct()
    return (fact.select(key).distinct()
            .join(right, F.col(key).eqNullSafe(F.col("__dim_key")), "left_anti"))


def check_orphans(fact: DataFrame, dim: DataFrame, table: str, key: str, dim_table: str
                  ) -> DataFrame:
    n = orphan_keys(fact, dim, key).agg(F.count(F.lit(1)).alias("n"))
    return _check(n, table, "orphans", passed=F.col("n") == 0, observed=F.col("n"), limit=0,
                  message=F.concat(F.lit(f"{table}: values of {key} that {dim_table} does not list: "),
                                   F.col("n").cast("string")))


def check_negative(df: DataFrame, table: str, limit: float, *, value: str) -> DataFrame:
    """A soft check: cleaning drops the rows, and raises on a high share."""
    share = df.agg(F.coalesce(F.avg(is_negative(F.col(value)).cast("int")), F.lit(0.0)).alias("s"))
    return _check(share, table, "negative_share", severity="warn", passed=F.col("s") <= limit,
                  observed=F.col("s"), limit=limit,
                  message=F.format_string(f"{table}: %.2f%% of {value} lie below zero; {limit:.2%}% may",
                                          F.col("s") * 100))


def key_statistics(df: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """One row for all checks of a table: rows, rows whose key repeats, rows with
    a missing key, and rows with a negative `value`. One shuffle of partial
    counts per key."""
    neg = is_negative(F.col(value)) if value else F.lit(False)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.count_if(neg).alias("neg"))
    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return groups.agg(total(F.col("c")).alias("n"),
                      total(F.when(F.col("c") > 1, F.col("c"))).alias("dup"),
                      total(F.when(absent, F.col("c"))).alias("absent"),
                      total(F.col("neg")).alias("neg"))


def _row(table: str, check: str, passed: Column, observed: Column, limit: float, message: Column,
         severity: str = "error") -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check"),
                    passed.alias("passed"), F.lit(severity).alias("severity"),
                    observed.cast("double").alias("observed"),
                    F.lit(float(limit)).alias("limit"), message.alias("message"))


def _table_checks(df: DataFrame, table: str, required: Sequence[str], keys: Sequence[str], *,
                  minimum: int | None = None, value: str | None = None,
                  max_negative: float | None = None) -> DataFrame:
    """All checks of one table as rows, from one pass over it."""
    absent = missing_columns(df, required)
    keyed, valued = _has(df, *keys), value is not None and value in df.columns
    stats = (key_statistics(df, keys, value if valued else None) if keyed else
             df.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(is_negative(F.col(value)) if valued else F.lit(False))
                    .alias("neg")))
    n, pct = F.format_number("n", 0), F.col("neg") / F.greatest(F.col("n"), F.lit(1))
    rows = [_row(table, "schema", F.lit(not absent), F.lit(len(absent)), 0,
                 F.lit(f"{table} lacks the columns {absent}") if absent else
                 F.concat(F.lit(f"{table} has all its columns; rows: "), n))]
    if minimum is not None:
        rows.append(_row(table, "min_rows", F.col("n") >= minimum, F.col("n"), minimum,
                         F.concat(F.lit(f"{table} needs {minimum:,} rows and has "), n)))
    if keyed:
        rows.append(_row(table, "unique_key", F.col("dup") == 0, F.col("dup"), 0, F.concat(
            F.lit(f"{table}: rows that share ({', '.join(keys)}) with another: "),
            F.col("dup").cast("string"))))
        rows.append(_row(table, "key_nulls", F.col("absent") == 0, F.col("absent"), 0, F.concat(
            F.lit(f"{table}: "), F.col("absent").cast("string"),
            F.lit(" rows with a missing key")), "warn"))
    if valued and max_negative is not None:
        rows.append(_row(table, "negative_share", pct <= max_negative, pct, max_negative,
                         F.format_string(f"{table}: %.2f%% of {value} lie below zero; "
                                         f"{max_negative:.2%}% may", pct * 100), "warn"))
    return stats.select(F.inline(F.array(*rows)))


def validate_raw_tables(sales: DataFrame, stores: DataFrame, features: DataFrame,
                        limits: Limits = Limits(), *,
                        keys: Keys = Keys()) -> DataFrame:
    """The check table of the three raw tables: one pass over each, and the
    orphan join."""
    parts = [
        _table_checks(sales, "sales", limits.required["sales"], keys.grain,
                      minimum=limits.min_rows, value=keys.value,
                      max_negative=limits.max_negative_share),
        _table_checks(stores, "stores", limits.required["stores"], [keys.entity],
                      minimum=limits.min_stores),
        _table_checks(features, "features", limits.required["features"],
                      [keys.entity, keys.time, keys.holiday]),
    ]
    if _has(sales, keys.entity) and _has(stores, keys.entity):
        parts.append(check_orphans(sales, stores, "sales", keys.entity, "stores"))
    return _union(parts)


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_share) for each column, from one aggregation."""
    one = df.agg(*[F.coalesce(F.avg(F.col(c).isNull().cast("int")), F.lit(0.0)).alias(c)
                   for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_share"))
                      for c in columns])
    return one.select(F.inline(pairs))


def _master_checks(master: DataFrame, rates: DataFrame, required: Sequence[str], max_null_share: float
                   ) -> DataFrame:
    return _union([check_schema({"master": (master, required)}), rates.select(
        F.lit("master").alias("table_name"),
        F.concat(F.lit("null_share:"), "column_name").alias("check"),
        (F.col("null_share") <= max_null_share).alias("passed"),
        F.lit("error").alias("severity"), F.col("null_share").alias("observed"),
        F.lit(float(max_null_share)).alias("limit"),
        F.format_string("master: %s is %.2f%% null", F.col("column_name"),
                        F.col("null_share") * 100).alias("message"))])


def validate_master(master: DataFrame, *, required: Sequence[str] = MASTER_REQUIRED,
                    max_null_share: float = 0.05) -> DataFrame:
    """Required columns, and their null shares, which must not exceed the limit."""
    present = [c for c in required if c in master.columns]
    return _master_checks(master, null_rates(master, present), required, max_null_share)


def observe_nulls(master: DataFrame, required: Sequence[str] = MASTER_REQUIRED) -> tuple[DataFrame, Observation]:
    """The table, and what the action that reads it will have counted on the way: its rows and
    the nulls of each required column. No pass of its own."""
    seen = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in required if c in master.columns]
    return master.observe(seen, F.count(F.lit(1)).alias("__n"), *counts), seen


def validate_observed(master: DataFrame, seen: Observation, *, required: Sequence[str] = MASTER_REQUIRED,
                      max_null_share: float = 0.05) -> DataFrame:
    """The check table of `validate_master` from what was observed while the table was written."""
    got = seen.get
    rates = [(c, got[c] / got["__n"] if got["__n"] else 0.0) for c in required if c in master.columns]
    table = master.sparkSession.createDataFrame(rates, "column_name string, null_share double")
    return _master_checks(master, table, required, max_null_share)


class DataQualityError(ValueError):
    pass


def raise_if_failed(checks: DataFrame, also: Sequence[str] = ()) -> list[str]:
    """Action: raises with the messages of all failed error checks, and of failed checks
    named in `also`; otherwise returns the messages of all checks. A check table has
    a fixed few rows, collected once."""
    rows = checks.select("message", "passed", "severity", "check").collect()
    fatal = [r["message"] for r in rows if not r["passed"] and (r["severity"] == "error" or r["check"] in also)]
    if fatal:
        raise DataQualityError(f"{len(fatal)} data quality check(s) failed: " + "; ".join(fatal))
    return [r["message"] for r in rows]


def dedupe(df: DataFrame, *, keys: Sequence[str] = ("Store", "Dept", "Date"),
           prefer: Sequence[str] = ("Weekly_Sales",)) -> DataFrame:
    """One row per key: the one with the largest `prefer` values, then the
    largest remaining columns, so the result does not depend on row order. An
    aggregation, so copies of one key collapse before the shuffle."""
    keys = list(keys)
    rest = [*prefer, *[c for c in df.columns if c not in keys and c not in prefer]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns])


def freshness(tables: dict[str, DataFrame], *, as_of: str | None = None, time: str = "Date",
              max_age_days: int = 7) -> DataFrame:
    """Newest date per table, its age at `as_of` (default: the newest date of
    all tables), and whether the table is stale."""
    newest = _union([df.agg(F.max(time).alias("newest")).select(
        F.lit(name).alias("table_name"), "newest") for name, df in tables.items()])
    # One row per table: a window without keys sees only these few rows.
    at = (F.lit(as_of).cast("date") if as_of else
          F.max("newest").over(Window.partitionBy(F.lit(1))))
    return (newest.withColumn("age_days", F.datediff(at, "newest"))
            .withColumn("stale", F.coalesce(F.col("age_days") > max_age_days, F.lit(True))))
