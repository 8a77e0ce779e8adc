"""Vector bin packing of documents into shards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged


def pack_vectors(loads: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit. Units go, largest share first, to the shard whose
    residual capacity has the highest dot product with the unit's load; loads
    and capacities are shares of an even split. Ties go to the lower shard."""
    total = loads.sum(axis=0)
    share = loads * shards / np.where(total > 0, total, 1)
    order = np.argsort(-share.max(axis=1), kind="stable")
    left = np.ones((shards, loads.shape[1]))
    out = np.zeros(len(loads), np.int64)
    for i in order:
        j = int(np.argmax(left @ share[i]))
        out[i] = j
        left[j] -= share[i]
    return out


def shard_documents(docs: DataFrame, shards: int = 8, lots: int = 4096, grain: int = 64) -> DataFrame:
    """A shard and a gapless slot for each document; bytes, tokens and rows are
    balanced together. Law `bytes`: sizes near equal.

    Units of placement: documents of equal text stay together, as a group. A
    group above 1/`grain` of a shard's even share in any dimension is split by
    row into parts of that size; other groups are summed into `lots` by hash.
    So the driver packs at most lots + 3 * shards * grain * 2 vectors, however
    many documents there are. Only sizes and hashes are shuffled, not texts.

    Null text: as empty (size 1). Null doc_id: kept. Repeated rows: each has its
    own slot. Empty table: no rows. Other columns are not read.
    """
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = staged(docs.select(
        "doc_id", (F.length(raw) + 1).cast("long").alias("size"),
        F.size(F.split(F.coalesce("text", F.lit("")), "[ \t\n\x0b\f\r]+")).cast("long").alias("tokens"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("grp"),
        F.monotonically_increasing_id().alias("rid")), "shard-rows")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.sum("n").alias("n")]
    groups = rows.groupBy("grp").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    cap = [max(float(x or 0) / shards / grain, 1.0) for x in total]
    heavy = F.greatest(*[F.col(c) / F.lit(k) for c, k in zip(("size", "tokens", "n"), cap, strict=True)])
    split = groups.where(heavy > 1).select("grp", F.least(F.ceil(heavy), F.col("n")).cast("int").alias("parts"))
    # At most 3 * shards * grain groups are heavy, as each takes 1/(shards * grain) of some total.
    split = F.broadcast(split)
    part = F.pmod(F.xxhash64("rid"), F.col("parts").cast("long")).cast("int")
    unit = rows.join(split, "grp", "left").select(
        "doc_id", "size", "tokens", "text_crc32", "rid",
        F.coalesce("grp", F.lit(0)).alias("grp"),
        F.when(F.col("parts").isNull(), F.pmod(F.col("grp"), F.lit(lots))).otherwise(F.col("grp")).alias("u"),
        F.when(F.col("parts").isNull(), F.lit(-1)).otherwise(part).alias("p"))
    loads = (unit.withColumn("n", F.lit(1)).groupBy("u", "p").agg(*sums).orderBy("u", "p").toPandas())
    loads["shard"] = pack_vectors(loads[["size", "tokens", "n"]].to_numpy(float), shards)
    loads["base"] = loads.groupby("shard")["n"].cumsum() - loads["n"]
    spark = docs.sparkSession
    place = spark.createDataFrame(
        [(int(r.u), int(r.p), int(r.shard), int(r.base)) for r in loads.itertuples()],
        "u long, p int, shard int, base long")
    own = Window.partitionBy("u", "p").orderBy("rid")
    return unit.join(F.broadcast(place), ["u", "p"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.row_number().over(own) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
