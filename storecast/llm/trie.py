"""Prefix trie of conversations, rolled up within bands of depths and then across them."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import dropped, join_hot, staged

#: Rows of a conversation that one window orders, and ids that one text of ids holds.
CHUNK, IDS = 1024, 4096
NODE = ["depth", "p1", "p2"]


def _marks(depth: Column) -> list[Column]:
    """Two 64-bit marks of a turn at its depth. The XOR of a prefix's marks names it."""
    return [F.xxhash64(F.lit(seed), depth, "h1", "h2") for seed in (1, 2)]


def numbered(conversations: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """(conv_id, p, h1, h2, size): each turn's place from 1 in its conversation, two
    fingerprints of role and text, and the UTF-8 bytes of the text. Texts are not
    shuffled. The order is by turn, null first, ties by fingerprint; it is one range
    sort over all conversations, and where one of them spans several ranges, their
    sizes, a row for each range, are added to the places in the later ones. Tables
    written on the way are added to `scratch`, here and below."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(3), role, text).alias("h1"), F.xxhash64(F.lit(4), role, text).alias("h2"),
        F.octet_length(text).cast("long").alias("size"))

    def count(batches):
        last, seen, part = None, 0, None
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            if part is None:
                part = batch.column(4)[0].as_py()
            new = np.concatenate(([conv[0] != last], conv[1:] != conv[:-1]))
            at = np.arange(len(conv))
            start = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(start < 0, at + seen + 1, at - start + 1)
            last, seen = conv[-1], int(place[-1])
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column(0), "h1": batch.column(1), "h2": batch.column(2), "size": batch.column(3),
                "part": pa.array(np.full(len(conv), part), pa.int32()), "i": pa.array(place, pa.int64())})

    order = ["conv_id", "turn", "h1", "h2"]
    dealt = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .select("conv_id", "h1", "h2", "size", F.spark_partition_id().alias("part")))
    local = staged(dealt.mapInArrow(count, "conv_id long, h1 long, h2 long, size long, part int, i long"), "trie-rows")
    scratch.append(local)
    parts = local.groupBy("conv_id", "part").agg(F.max("i").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = (parts.withColumn("before", F.sum("n").over(before)).where("before is not null")
             .select("conv_id", "part", "before"))
    # A range border lies in one conversation, so `later` has fewer rows than there are ranges.
    return (local.join(F.broadcast(later), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("i") + F.coalesce("before", F.lit(0))).alias("p"), "h1", "h2", "size"))


def rebuilt(turns: DataFrame, scratch: list[DataFrame], group: int = 5, fold: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns of the rebuilt conversations, their lengths). A conversation c takes the first
    crc32(c) modulo `fold` turns of conversation c - c % `group`, then its own after as many."""
    whole = turns.groupBy("conv_id").agg(F.max("p").alias("n"))
    convs = whole.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
                         (F.crc32(F.col("conv_id").cast("string").cast("binary")) % fold).alias("h"))
    convs = (convs.join(whole.select(F.col("conv_id").alias("base"), F.col("n").alias("b")), "base", "left")
             .select("conv_id", "base", "h", "n", F.least("h", F.coalesce("b", F.lit(0))).alias("lent")))
    convs = staged(convs, "trie-conversations")
    scratch.append(convs)
    own = (turns.join(convs.select("conv_id", "h", "lent"), "conv_id").where("p > h")
           .select("conv_id", (F.col("p") - F.col("h") + F.col("lent")).alias("depth"), "h1", "h2", "size"))
    lent = (turns.where(F.col("p") < fold).withColumnRenamed("conv_id", "base")
            .join(convs.select("base", "conv_id", "lent"), "base").where("p <= lent")
            .select("conv_id", F.col("p").alias("depth"), "h1", "h2", "size"))
    lengths = convs.select("conv_id", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"))
    return own.unionByName(lent), lengths


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, up1, up2, size): a row per conversation and depth from 0,
    the name of its prefix and of the one above. Names run along chunks of a
    conversation; totals of the chunks before are carried in."""
    m1, m2 = _marks(F.col("depth"))
    rows = turns.select("conv_id", "depth", "size", m1.alias("m1"), m2.alias("m2"),
                        F.expr(f"(depth - 1) div {CHUNK}").alias("chunk"))
    total = (rows.groupBy("conv_id", "chunk").agg(F.bit_xor("m1").alias("t1"), F.bit_xor("m2").alias("t2"))
             .join(lengths.where(F.col("depth") > CHUNK).select("conv_id"), "conv_id", "left_semi"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (total.select("conv_id", "chunk", F.bit_xor("t1").over(before).alias("c1"), F.bit_xor("t2").over(before).alias("c2"))
             .where("chunk > 0"))
    upto = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    named = (rows.withColumns({"p1": F.bit_xor("m1").over(upto), "p2": F.bit_xor("m2").over(upto)})
             .join(carry, ["conv_id", "chunk"], "left")
             .select("conv_id", "depth", "size", "m1", "m2",
                     *[F.col(f"p{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0))).alias(f"p{k}") for k in (1, 2)]))
    zero = F.lit(0).cast("long")
    top = lengths.select("conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"),
                         F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"), zero.alias("size"))
    return top.unionByName(named.select("conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("m1")).alias("up1"),
                                        F.col("p2").bitwiseXOR(F.col("m2")).alias("up2"), "size"))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256): of each node's ending conversations in order. Ids are
    dealt out by ranges of node and id and joined to texts of at most `IDS` of them there;
    a node's texts then pass one hash in order, so no node is held in memory."""
    order = [*NODE, "conv_id"]

    def join(frames):
        for frame in frames:
            key = frame[["depth", "p1", "p2"]].to_numpy()
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))) if len(key) else []
            cuts = [*new, len(frame)]
            ids = frame["conv_id"].to_numpy()
            rows = [(*key[a], int(ids[s]), ",".join(map(str, ids[s:min(s + IDS, b)])))
                    for a, b in zip(cuts, cuts[1:]) for s in range(a, b, IDS)]
            yield pd.DataFrame(rows, columns=["depth", "p1", "p2", "first", "ids"])

    def digest(frames):
        node, state = None, None
        for frame in frames:
            done = []
            for d, p1, p2, ids in zip(frame["depth"], frame["p1"], frame["p2"], frame["ids"], strict=True):
                if (d, p1, p2) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (d, p1, p2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    texts = (ends.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInPandas(join, "depth long, p1 long, p2 long, first long, ids string"))
    return (texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
            .mapInPandas(digest, "depth long, p1 long, p2 long, ends_sha256 string"))


def rolled_up(nodes: DataFrame, paths: DataFrame, values: list[str], band: int,
              scratch: list[DataFrame]) -> DataFrame:
    """(depth, p1, p2, values...): sums over each node's subtree. `nodes` has conv_id, a
    conversation through the node; `paths` is the table of prefixes.

    A node explodes to itself and its ancestors down to its band's first depth, and one
    shuffle sums all bands. Then the first nodes of the deepest band are complete;
    round by round their totals go to the first node of the band above, a table of
    one row a path and band. Last, each completed total explodes once to the nodes
    of the band above it. Rounds: depth / `band`; rows: nodes times `band` at most.
    """
    at = F.expr(f"depth div {band}")
    above = paths.select("conv_id", at.alias("band"), F.col("depth").alias("d"), F.col("p1").alias("a1"), F.col("p2").alias("a2"))

    def exploded(rows: DataFrame, depth: Column) -> DataFrame:
        """Each row joined to the prefixes of its conversation at or above `depth`, in that depth's band."""
        return (rows.withColumn("below", depth).withColumn("band", F.expr(f"below div {band}"))
                .join(above, ["conv_id", "band"]).where("d <= below"))

    def summed(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(F.col("d").alias("depth"), F.col("a1").alias("p1"), F.col("a2").alias("p2"))
                .agg(*[F.sum(v).alias(v) for v in values]))

    inside = staged(summed(exploded(nodes.select("conv_id", "depth", *values), F.col("depth"))), "trie-bands")
    scratch.append(inside)
    firsts = inside.where(F.col("depth") % band == 0).join(nodes.select("conv_id", *NODE), NODE)
    deepest = int(nodes.agg(F.max(at)).first()[0] or 0)
    if not deepest:
        return inside
    links = (exploded(firsts.where("depth > 0"), F.col("depth") - 1).where(F.col("d") % band == 0)
             .select("conv_id", *NODE, *values, F.col("a1").alias("up1"), F.col("a2").alias("up2")))
    links = staged(links, "trie-links")
    done, parts = None, []
    for k in range(deepest, 0, -1):
        rows = links.where(F.col("depth") == k * band)
        if done is not None:
            more = (done.groupBy(F.col("up1").alias("p1"), F.col("up2").alias("p2"))
                    .agg(*[F.sum(v).alias(f"__{v}") for v in values]))
            rows = (rows.join(more, ["p1", "p2"], "left")
                    .select("conv_id", *NODE, *[(F.col(v) + F.coalesce(f"__{v}", F.lit(0))).alias(v) for v in values], "up1", "up2"))
        done = staged(rows, "trie-totals")
        parts.append(done)
    scratch += [links, *parts]
    totals = parts[0]
    for p in parts[1:]:
        totals = totals.unionByName(p)
    spread = summed(exploded(totals.select("conv_id", "depth", *values), F.col("depth") - 1))
    return summed(inside.unionByName(spread).select(F.col("depth").alias("d"), F.col("p1").alias("a1"), F.col("p2").alias("a2"), *values))


def trie(conversations: DataFrame, *, band: int = 32, group: int = 5, fold: int = 9) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256), a row per node of the trie of rebuilt conversations, the root included.

    Null turn: first; null role or text: empty. Null conv_id: not a conversation. Equal
    turns, repeated rows too: each is a turn of its own, in the order of a fingerprint of
    role and text. Empty and very long texts: only fingerprint and size leave the scan.
    Empty table: no rows, no root either. Very long conversations: bounded windows and
    depth / `band` rounds. Other columns are not read.
    """
    scratch: list[DataFrame] = []
    turns = numbered(conversations, scratch)
    built, lengths = rebuilt(turns, scratch, group, fold)
    paths = staged(prefixes(built, lengths), "trie-prefixes")
    nodes = staged(paths.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                            F.min("up1").alias("up1"), F.min("up2").alias("up2"), F.max("size").alias("size")),
                   "trie-nodes")
    children = staged(nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("p1"), F.col("up2").alias("p2"))
                      .agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    own = (nodes.join(children, NODE, "left").fillna(0, ["n_children"])
           .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
           .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("size")))
    own = staged(own, "trie-own")
    sums = rolled_up(own, paths, ["n_leaves", "saved_tokens"], band, scratch)

    # Nodes of many children are few: a share of a 512th of all nodes has at most 512 owners.
    many = nodes.count() // 512
    parents = children.join(nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")), NODE)
    up = parents.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), "n_children", "parent_conv_id")
    hot = up.where(F.col("n_children") > many).drop("n_children")
    named = join_hot(own.drop("n_leaves", "saved_tokens", "size"), up.drop("n_children"), hot, ["depth", "up1", "up2"])
    ends = paths.join(lengths, ["conv_id", "depth"], "left_semi").select(*NODE, "conv_id")
    empty = hashlib.sha256(b"").hexdigest()
    out = (named.join(sums, NODE).join(ends_hashes(ends), NODE, "left")
           .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                   F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
    out = staged(out, "trie")
    dropped(paths, nodes, children, own, *scratch)
    return out
