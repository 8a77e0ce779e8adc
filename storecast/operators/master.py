"""Joining and cleaning: sales + stores + features -> the wide master table.

No join carries a broadcast hint. Catalyst broadcasts a side whose size it
knows to be below the session's threshold and sort-merges otherwise; adaptive
execution then splits join partitions that a hot key makes too large.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MACRO_COLUMNS, MARKDOWNS, Keys
from ..functions.scalar import is_negative
from .ordered import forward_fill, time_order, year_chunk


def _left(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, list(keys), "left")
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, cond, "left").drop(*[f"__r_{k}" for k in keys])


def join_stores(sales: DataFrame, stores: DataFrame, *, keys: Keys = Keys(),
                null_safe: bool = False) -> DataFrame:
    """Every sales row with its store attributes; unknown stores get null."""
    return _left(sales, stores, [keys.entity], null_safe)


def join_features(df: DataFrame, features: DataFrame, *, keys: Keys = Keys(),
                  null_safe: bool = False) -> DataFrame:
    """Adds the weekly store features. The holiday flag is part of the key, so
    rows whose flags disagree get null features."""
    return _left(df, features, [keys.entity, keys.time, keys.holiday], null_safe)


def merge_datasets(sales: DataFrame, stores: DataFrame, features: DataFrame, *,
                   keys: Keys = Keys(), null_safe: bool = False) -> DataFrame:
    return join_features(join_stores(sales, stores, keys=keys, null_safe=null_safe),
                         features, keys=keys, null_safe=null_safe)


def negative_share(df: DataFrame, *, value: str = "Weekly_Sales") -> DataFrame:
    """One row: row count, negative rows, and their share of all rows."""
    neg = is_negative(F.col(value)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.sum(neg), F.lit(0)).alias("n_negative"),
                  F.coalesce(F.avg(neg), F.lit(0.0)).alias("negative_share"))


def check_negative_share(df: DataFrame, limit: float, *, value: str = "Weekly_Sales") -> None:
    """Action: raises where more than `limit` of the rows are negative."""
    share = negative_share(df, value=value).first()["negative_share"]
    if share > limit:
        raise ValueError(f"{share:.2%} of the rows have negative {value}; the limit is {limit:.2%}")


def drop_negative_sales(df: DataFrame, *, value: str = "Weekly_Sales") -> DataFrame:
    return df.filter(~is_negative(F.col(value)))


def impute_markdowns(df: DataFrame, columns: Sequence[str] = MARKDOWNS) -> DataFrame:
    """No markdown recorded means no promotion ran."""
    return df.fillna(0.0, subset=list(columns))


def ffill_macro(df: DataFrame, columns: Sequence[str] = MACRO_COLUMNS, *,
                keys: Keys = Keys(), unique: bool = False) -> DataFrame:
    """Forward fill within the entity over rows ordered by (item, time): the
    order of a file sorted by entity, item and date. Each year of an item is one
    chunk of its entity, so the work spreads over (entity, item, year). `unique`
    says that no (entity, item, time) repeats."""
    chunk = F.struct(F.col(keys.item).alias("item"), year_chunk(keys.time).alias("year"))
    return forward_fill(df, by=[keys.entity], order=[time_order(keys.time)],
                        columns=columns, chunk=chunk, unique=unique)


def ffill_features(features: DataFrame, columns: Sequence[str] = MACRO_COLUMNS, *,
                   keys: Keys = Keys(), chunk: Column | None = None) -> DataFrame:
    """Forward fill of the features table by date, before it meets the sales:
    no value comes from a later week. A store has one features row per date and
    holiday flag, so a plain window over the store is short; give a chunk, such
    as the year, where that does not hold."""
    return forward_fill(features, by=[keys.entity], order=[time_order(keys.time)],
                        columns=columns, chunk=chunk)


def clean_master(master: DataFrame, *, markdowns: Sequence[str] = MARKDOWNS,
                 macro: Sequence[str] = MACRO_COLUMNS,
                 max_negative_share: float | None = 0.01,
                 fill: str | None = "input", keys: Keys = Keys(),
                 unique: bool = False) -> DataFrame:
    """Gate on the negative share (an action; None skips it), drop negative
    rows, zero missing markdowns, forward-fill the macro series."""
    if max_negative_share is not None:
        check_negative_share(master, max_negative_share, value=keys.value)
    df = impute_markdowns(drop_negative_sales(master, value=keys.value), markdowns)
    if fill == "input":
        return ffill_macro(df, macro, keys=keys, unique=unique)
    if fill is None:
        return df
    raise ValueError("clean_master fills in 'input' order or not at all (None)")


def build_master(sales: DataFrame, stores: DataFrame, features: DataFrame, *,
                 markdowns: Sequence[str] = MARKDOWNS, macro: Sequence[str] = MACRO_COLUMNS,
                 max_negative_share: float | None = 0.01, fill: str = "chronological",
                 keys: Keys = Keys(), unique: bool = False) -> DataFrame:
    """Merge and clean. `fill` is 'chronological' (features filled by date before
    the join) or 'input' (rows filled in (item, time) order after it). The
    negative-share gate looks at the sales alone, before any join."""
    if fill not in ("chronological", "input"):
        raise ValueError(f"unknown fill order: {fill}")
    if max_negative_share is not None:
        check_negative_share(sales, max_negative_share, value=keys.value)
    if fill == "chronological":
        features = ffill_features(features, macro, keys=keys)
    kept = drop_negative_sales(sales, value=keys.value)
    return clean_master(
        merge_datasets(kept, stores, features, keys=keys), markdowns=markdowns, macro=macro,
        max_negative_share=None, fill="input" if fill == "input" else None, keys=keys,
        unique=unique)


def split_by_date(df: DataFrame, cutoff: str | dt.date, *,
                  time: str = "Date") -> tuple[DataFrame, DataFrame]:
    """(rows before the cutoff, rows from the cutoff on)."""
    at = F.lit(str(cutoff)).cast("date")
    return df.filter(F.col(time) < at), df.filter(F.col(time) >= at)
