"""Sales, stores and features derived from the driver tables.

Store = supplier nation (or the supplier itself), Dept = part brand number,
Date = Friday of the ship week. The formulas for holidays, types, sizes, CPI
and unemployment are invented test data.

Lines without a store, department or date are no sales. Saying so here also
keeps both branches of a later self-join alike (a join on these keys would
filter one side only), so that Spark reuses one shuffle of the order lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAY_WEEKS = (6, 36, 47, 52)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _friday(c: Column) -> Column:
    """Friday of the week, Monday first: day arithmetic only."""
    day = c.cast("date")
    return F.date_add(day, F.lit(4) - F.weekday(day))


def _units(c: Column) -> Column:
    """An amount of at most four decimals as a whole number of ten-thousandths.
    Sums of whole numbers are exact in any order, and cheaper than decimals."""
    return F.rint(c * 10000).cast("long")


def _total(c: str | Column) -> Column:
    return F.sum(c).cast("double") / 10000


def _store_of(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    column = {"nation": "s_nationkey", "supplier": "s_suppkey"}[entity]
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col(column).cast("int").alias("Store")).where("Store IS NOT NULL")


def _dept_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.expr("CAST(substr(p_brand, 7) AS INT)").alias("Dept")) \
        .where("Dept IS NOT NULL")


def sales(spark: SparkSession, sf_dir: str, entity: str = "nation") -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", _friday(F.col("l_shipdate")).alias("Date"),
        _units(F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") <= 1),
                      -F.col("l_extendedprice"))
               .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("amount")) \
        .where("Date IS NOT NULL")
    return (lines
            .join(_dept_of(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
            .join(_store_of(spark, sf_dir, entity), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("Store", "Dept", "Date")
            .agg(_total("amount").alias("Weekly_Sales"))
            .withColumn("IsHoliday", F.weekofyear("Date").isin(*HOLIDAY_WEEKS)))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("Store"),
        F.when(F.col("n_regionkey") <= 1, "A").when(F.col("n_regionkey") <= 3, "B")
        .otherwise("C").alias("Type"),
        (30000 + 7000 * F.col("n_nationkey")).alias("Size"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", _friday(F.col("l_shipdate")).alias("Date"),
        _units(F.col("l_quantity")).alias("quantity"), _units(F.col("l_tax")).alias("tax"),
        _units(F.col("l_extendedprice") * F.col("l_discount")).alias("off")) \
        .where("Date IS NOT NULL")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"))
    n = F.count(F.lit(1))
    weekly = (lines
              .join(_store_of(spark, sf_dir, "nation"), F.col("l_suppkey") == F.col("s_suppkey"))
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy("Store", "Date")
              .agg((_total("quantity") / n * 2).alias("Temperature"),
                   (_total("tax") / n * 20 + 2).alias("Fuel_Price"),
                   *[_total(F.when(F.col("priority") == str(i), F.col("off")))
                     .alias(f"MarkDown{i}") for i in range(1, 6)],
                   n.alias("n")))
    week = F.weekofyear("Date")
    return weekly.select(
        "Store", "Date", "Temperature", "Fuel_Price",
        *[f"MarkDown{i}" for i in range(1, 6)],
        F.when((week + F.col("Store")) % 5 != 0,
               200 + F.col("n").cast("double") / 10).alias("CPI"),
        F.when((week + F.col("Store")) % 7 != 0,
               5 + (F.col("Store") * 7 % 10).cast("double") / 2).alias("Unemployment"),
        week.isin(*HOLIDAY_WEEKS).alias("IsHoliday"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(OrderKey, Dept, Weekly_Sales): line grain, for baskets that are orders."""
    return (table(spark, sf_dir, "lineitem")
            .join(_dept_of(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("OrderKey"), "Dept",
                    (F.col("l_extendedprice") * (1 - F.col("l_discount")))
                    .alias("Weekly_Sales")))


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Store, Dept, Date, Weekly_Sales) with one row per order line, so that
    keys repeat."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", _friday(F.col("l_shipdate")).alias("Date"),
        F.col("l_extendedprice").alias("Weekly_Sales"))
    return (lines
            .join(_dept_of(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
            .join(_store_of(spark, sf_dir, "nation"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select("Store", "Dept", "Date", "Weekly_Sales"))
