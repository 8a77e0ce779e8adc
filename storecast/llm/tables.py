"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.session import materialize, remove_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the key's text modulo n; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def staged(df: DataFrame, label: str) -> DataFrame:
    """The table, written to the shared folder and read again: it is computed
    once, and a lost executor costs a new read."""
    return materialize(df, f"llm-{label}")


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in tables:
        files = df.inputFiles()
        if files:
            remove_path(df.sparkSession, files[0].rsplit("/", 1)[0])


def join_hot(many: DataFrame, one: DataFrame, hot: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """`many` joined to `one`, which has unique keys. `hot` holds the rows of `one` that very
    many rows of `many` belong to, few enough to broadcast by the caller's proof; the
    others meet in a shuffle, without a hot key."""
    rest = many.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(one, keys, how)
    return many.join(F.broadcast(hot), keys).unionByName(rest)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, one narrow aggregate; sizes partitions, never results."""
    return int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, root): the least node of each connected component. Alternates two
    star contractions until no edge changes; edges and labels stay distributed.
    Nodes without an edge do not come out."""
    u, v = F.col(left), F.col(right)
    now = staged(edges.where(u != v).select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct(), "edges")
    known = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_low, "a")
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                         F.col("m").alias("b")).where("a != b").distinct())
        now = staged(small, "edges")
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == known:
            break
        known = sign
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
