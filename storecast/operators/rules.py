"""Association rules over baskets.

Itemsets of any size come from Spark's FP-growth. Where the caller limits the
size, as for dense baskets, tasks walk over basket bitmaps; baskets too many for
that grow their itemsets by one item a level, and only the frequent ones grow on. All
give the same itemsets, and in all they stay distributed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Keys
from ..session import materialize, remove_path, scratch_path
from . import itemwalk

ITEMSET_SCHEMA = "items array<string>, size int, n bigint, support double"
RULE_SCHEMA = ("antecedents array<string>, consequents array<string>, support double, "
               "confidence double, lift double")


@dataclass(frozen=True)
class RuleParams:
    """Which items enter, and which itemsets and rules stay. `max_len` None: any size."""

    max_departments: int = 40
    max_len: int | None = None
    min_support: float = 0.011
    min_confidence: float = 0.8
    min_length: int = 2
    min_lift: float = 3.0


def top_departments(sales: DataFrame, n: int = 40, *, keys: Keys = Keys()) -> DataFrame:
    """The n items of largest total sales; ties go to the smaller item."""
    return (sales.where(F.col(keys.item).isNotNull()).groupBy(keys.item)
            .agg(F.coalesce(F.sum(keys.value), F.lit(0.0)).alias("total_sales"))
            .orderBy(F.desc("total_sales"), keys.item).limit(n))


def restrict_to_top(sales: DataFrame, n: int = 40, *, keys: Keys = Keys()) -> DataFrame:
    return sales.join(top_departments(sales, n, keys=keys).select(keys.item), keys.item,
                      "left_semi")


def dept_baskets(sales: DataFrame, *, basket_keys: Sequence[str] = ("Store", "Date"),
                 item: str = "Dept") -> DataFrame:
    """(basket keys..., items): the distinct items of each basket as sorted text.
    Any row counts, whatever its sales. The sets are built per task first."""
    rows = sales
    for k in (*basket_keys, item):
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*basket_keys).agg(
        F.array_sort(F.collect_set(F.col(item).cast("string"))).alias("items"))


def basket_matrix(sales: DataFrame, items: Sequence | None = None, *,
                  basket_keys: Sequence[str] = ("Store", "Date"), item: str = "Dept") -> DataFrame:
    """One row per basket, one boolean column `item_<x>` per listed item; without a
    list, per item that occurs, so as many as a row can hold."""
    rows = sales
    for k in (*basket_keys, item):
        rows = rows.where(F.col(k).isNotNull())
    if items is None:
        items = [r[0] for r in rows.select(item).distinct().orderBy(item).collect()]
    return rows.groupBy(*basket_keys).agg(*[
        F.max(F.col(item) == F.lit(x)).alias(f"item_{x}") for x in items])


def _present_rows(sales: DataFrame, basket_keys: Sequence[str], item: str) -> DataFrame:
    """(basket keys..., item as text) of the rows without a missing key."""
    rows = sales.select(*basket_keys, F.col(item).cast("string").alias(item))
    for k in (*basket_keys, item):
        rows = rows.where(F.col(k).isNotNull())
    return rows


def _least_count(min_support: float, n_baskets: int) -> int:
    """The smallest count whose share of the baskets reaches min_support."""
    return max(1, math.ceil(min_support * n_baskets - 1e-9))


def frequent_itemsets(sales: DataFrame, *, min_support: float = 0.011,
                      max_len: int | None = None,
                      basket_keys: Sequence[str] = ("Store", "Date"), item: str = "Dept",
                      engine: str = "auto") -> DataFrame:
    """(items, size, n, support) of all itemsets with support >= min_support, of
    at most `max_len` items where that is given.

    `engine` decides how, never what: 'fpgrowth' finds all sizes and then keeps the
    asked ones; 'bitmaps' and 'levels' end their work at `max_len`, for dense baskets whose
    larger itemsets nobody asks for; 'auto' takes bitmaps where a `max_len` is given, or
    levels where the bitmaps would be too large to broadcast.
    """
    if engine not in ("auto", "bitmaps", "levels", "fpgrowth"):
        raise ValueError(f"unknown engine {engine!r}")
    rows = _present_rows(sales, basket_keys, item)
    distinct = rows.distinct().persist()
    try:
        n_baskets = distinct.select(*basket_keys).distinct().count()
        if n_baskets == 0:
            return sales.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
        least = _least_count(min_support, n_baskets)
        if engine == "bitmaps" or (engine == "auto" and max_len is not None):
            weighted = weighted_baskets(distinct, least, basket_keys, item)
            if engine == "bitmaps" or itemwalk.fits(weighted):
                return itemwalk.walked(weighted, least, n_baskets, closed=False, most=max_len)
        if engine == "levels" or (engine == "auto" and max_len is not None):
            return _levels(distinct, least, max_len, basket_keys, item, n_baskets)
        return _fpgrowth(distinct, least, max_len, basket_keys, item, n_baskets)
    finally:
        distinct.unpersist()


def weighted_baskets(distinct: DataFrame, least: int, basket_keys: Sequence[str], item: str) -> DataFrame:
    """(items, w): the distinct baskets of frequent items and how often each occurs."""
    usual = distinct.groupBy(item).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    kept = distinct.join(usual.select(item), item, "left_semi")
    return materialize(dept_baskets(kept, basket_keys=basket_keys, item=item)
                       .groupBy("items").agg(F.count(F.lit(1)).alias("w")), "distinct-baskets")


def _levels(distinct: DataFrame, least: int, max_len: int | None, basket_keys: Sequence[str],
            item: str, n_baskets: int) -> DataFrame:
    """Level by level: a row per frequent itemset and basket that holds it, with the
    items of the basket behind the itemset's last one; each of those makes a row of
    the next level. Baskets that end alike are one row with a weight. Per level only
    the answer whether an itemset was found reaches the driver."""
    spark = distinct.sparkSession
    level = materialize(distinct.groupBy(F.array(item).alias("items")).agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") >= least), "itemsets")
    usual = distinct.join(level.select(F.col("items")[0].alias(item)), item, "left_semi")
    held = (dept_baskets(usual, basket_keys=basket_keys, item=item)
            .groupBy(F.col("items").alias("rest")).agg(F.count(F.lit(1)).alias("w"))
            .withColumn("items", F.expr("cast(array() as array<string>)")))

    def grown() -> DataFrame:
        return (held.select("w", "items", "rest", F.posexplode("rest").alias("at", "next"))
                .select(F.concat("items", F.array("next")).alias("items"),
                        F.expr("slice(rest, at + 2, size(rest))").alias("rest"), "w"))

    paths, found = [], [level]
    while len(found) != max_len and not level.isEmpty():
        path = scratch_path(spark, "itemset-rows")
        rows = (grown().where(F.size("rest") > 0).groupBy("items", "rest").agg(F.sum("w").alias("w"))
                .join(level.select("items"), "items", "left_semi"))
        rows.write.parquet(path)
        for old in paths:
            remove_path(spark, old)
        held, paths = spark.read.schema(rows.schema).parquet(path), [path]
        level = materialize(grown().groupBy("items").agg(F.sum("w").alias("n"))
                            .where(F.col("n") >= least), "itemsets")
        found.append(level)
    for old in paths:
        remove_path(spark, old)
    return reduce(DataFrame.unionByName, found).select(
        "items", F.size("items").alias("size"), "n", (F.col("n") / n_baskets).alias("support"))


def _fpgrowth(distinct: DataFrame, least: int, max_len: int | None,
              basket_keys: Sequence[str], item: str, n_baskets: int) -> DataFrame:
    baskets = dept_baskets(distinct, basket_keys=basket_keys, item=item)
    # The model rounds a share up to a count; half a basket below asks for exactly `least`.
    found = (FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_baskets).fit(baskets)
             .freqItemsets.where(F.col("freq") >= least))
    out = found.select(F.array_sort("items").alias("items"), F.size("items").alias("size"),
                       F.col("freq").alias("n"), (F.col("freq") / n_baskets).alias("support"))
    # The model's itemsets are recomputed on each use: keep them as a table.
    return materialize(out if max_len is None else out.where(F.col("size") <= max_len),
                       "itemsets")


def rules_from_itemsets(itemsets: DataFrame, *, min_confidence: float = 0.8,
                        min_lift: float = 3.0, min_length: int = 2) -> DataFrame:
    """All splits of each itemset into antecedents and consequents, with
    confidence and lift. Both sides of a split are frequent itemsets themselves,
    so two equi-joins supply their supports."""
    whole = itemsets.where("size >= 2").select("items", "support")
    splits = F.expr("sequence(1L, shiftleft(1L, size(items)) - 2)")
    side = ("filter(items, (x, i) -> (shiftright(split, i) & 1) = {bit})")
    pairs = (whole.withColumn("split", F.explode(splits))
             .select("support", F.expr(side.format(bit=1)).alias("antecedents"),
                     F.expr(side.format(bit=0)).alias("consequents")))
    known_a = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("sa"))
    known_c = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("sc"))
    confidence = F.col("support") / F.col("sa")
    return (pairs.join(known_a, "antecedents").where(confidence >= min_confidence)
            .join(known_c, "consequents")
            .select("antecedents", "consequents", "support", confidence.alias("confidence"),
                    (confidence / F.col("sc")).alias("lift"))
            .where((F.col("lift") >= min_lift)
                   & (F.size("antecedents") + F.size("consequents") >= min_length)))


def sort_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedents", "consequents")


def mine_association_rules(sales: DataFrame, config: RuleParams = RuleParams(), *,
                           basket_keys: Sequence[str] = ("Store", "Date"), keys: Keys = Keys(),
                           engine: str = "auto") -> DataFrame:
    """Rules among the best-selling items, by falling lift; an empty input gives
    an empty table with the five columns."""
    kept = restrict_to_top(sales, config.max_departments, keys=keys)
    itemsets = frequent_itemsets(kept, min_support=config.min_support, max_len=config.max_len,
                                 basket_keys=basket_keys, item=keys.item, engine=engine)
    return sort_rules(rules_from_itemsets(
        itemsets, min_confidence=config.min_confidence, min_lift=config.min_lift,
        min_length=config.min_length))
