"""Closed itemsets: the itemsets that no larger one matches in count.

They are far fewer than all frequent itemsets where baskets are dense, and the
count of any frequent itemset is that of its smallest closed superset. So this
table stands for all of them, of any size, and rules follow from it by joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import itemwalk
from .rules import ITEMSET_SCHEMA, _least_count, _present_rows, frequent_itemsets, weighted_baskets


def closed_itemsets(sales: DataFrame, *, min_support: float = 0.011,
                    basket_keys: Sequence[str] = ("Store", "Date"), item: str = "Dept",
                    engine: str = "auto") -> DataFrame:
    """(items, size, n, support) of all closed itemsets with support >= min_support.

    `engine` decides how, never what. 'bitmaps' walks the tree of closed itemsets over a
    bitmap of baskets for each item, in rounds that deal out the open branches anew;
    equal baskets are one bit with a weight, and the bitmaps are broadcast. 'filter'
    takes all frequent itemsets and drops those that a larger one matches. 'auto' takes
    bitmaps while items times distinct baskets stay within `itemwalk.BITMAP_BITS`.
    """
    if engine not in ("auto", "bitmaps", "filter"):
        raise ValueError(f"unknown engine {engine!r}")
    rows = materialize(_present_rows(sales, basket_keys, item).distinct(), "basket-items")
    n_baskets = rows.select(*basket_keys).distinct().count()
    if n_baskets == 0:
        return sales.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    least = _least_count(min_support, n_baskets)
    distinct = weighted_baskets(rows, least, basket_keys, item)
    if engine == "filter" or (engine == "auto" and not itemwalk.fits(distinct)):
        return _unmatched(frequent_itemsets(rows, min_support=min_support, basket_keys=basket_keys,
                                            item=item, engine="fpgrowth"))
    return itemwalk.walked(distinct, least, n_baskets, closed=True)


def _unmatched(itemsets: DataFrame) -> DataFrame:
    """Itemsets that none of one more item matches in count, by one anti join."""
    smaller = (itemsets.where("size > 1").select(F.explode("items").alias("x"), "items", "n")
               .select(F.array_remove("items", F.col("x")).alias("items"), "n"))
    return itemsets.join(smaller.distinct(), ["items", "n"], "left_anti").select(*itemsets.columns)


def supports_of(itemsets: DataFrame, closed: DataFrame) -> DataFrame:
    """`itemsets` (a column `items`) with n and support: those of the smallest closed superset,
    the one of the largest count. Null where the itemset is not frequent."""
    asked = itemsets.select("items").distinct()
    holders = closed.select(F.col("items").alias("held"), "n", "support", F.explode("items").alias("first"))
    found = (asked.withColumn("first", F.col("items")[0]).join(holders, "first")
             .where(F.size(F.array_except("items", "held")) == 0)
             .groupBy("items").agg(F.max("n").alias("n"), F.max("support").alias("support")))
    return itemsets.join(found, "items", "left")


def closed_rules(closed: DataFrame, *, min_confidence: float = 0.8, min_lift: float = 3.0) -> DataFrame:
    """Rules with one consequent whose items together are closed. What is left of a closed
    itemset without an item is closed too, or its closure is the whole; so one left
    join gives the antecedents' supports. Items count with their own closures."""
    whole = closed.where("size >= 2").select("items", F.col("support").alias("s"))
    split = (whole.withColumn("c", F.explode("items"))
             .select(F.array_remove("items", F.col("c")).alias("antecedents"), F.array("c").alias("consequents"), "s"))
    left = closed.select(F.col("items").alias("antecedents"), F.col("support").alias("sa"))
    single = (closed.select(F.explode("items").alias("c"), "support").groupBy("c").agg(F.max("support").alias("sc"))
              .select(F.array("c").alias("consequents"), "sc"))
    confidence = F.col("s") / F.coalesce("sa", "s")
    return (split.join(left, "antecedents", "left").where(confidence >= min_confidence)
            .join(single, "consequents")
            .select("antecedents", "consequents", F.col("s").alias("support"), confidence.alias("confidence"),
                    (confidence / F.col("sc")).alias("lift")).where(F.col("lift") >= min_lift))
