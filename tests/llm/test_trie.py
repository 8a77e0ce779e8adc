"""The prefix trie against a plain one."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from storecast.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth int, size string, p int"


def plain_trie(rows):
    """Node values by walking every rebuilt conversation from the root. Rows come without ties."""
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), (role or "", text or "")))
    told = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    members = collections.defaultdict(list)
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = told.get(base, [])[:h] + own[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path)))
    kids = collections.defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(sums[k][0] for k in kids[node]) or 1
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = leaves, saved + sum(sums[k][1] for k in kids[node])
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c, n in sorted(own) if n == len(node))
        out.append((min(own)[0], len(node), min(members[node[:-1]])[0] if node else None, len(own), len(kids[node]),
                    *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA).repartition(parts)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def talks():
    """Copies of few conversations, null and empty parts, negative and missing ids, a long one."""
    rng = random.Random(5)
    rows = []
    for c in [*range(-12, 60), 102, 103, 1000]:
        if c in (20, 25):  # absent bases
            continue
        kind = rng.randrange(4)
        for t in range(rng.choice([0, 1, 2, 5, 9, 12])):
            text = [f"turn {t}", f"Ünï {kind} {t}", "", None][(t + kind) % 4]
            rows.append((c, t if t else None, ["user", "assistant", None][t % 3], text))
    rows += [(30, t, "user", f"long {t % 7}") for t in range(100, 190)]
    rows += [(31, t, "user", f"long {t % 7}") for t in range(100, 170)]
    rows += [(None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("band", [16, 64])
def test_trie(spark, talks, band):
    assert got(trie.trie(table(spark, talks), band=band)) == plain_trie(talks)


def test_chunks_and_ranges(spark, talks, monkeypatch):
    """Names carried over chunks of a conversation, texts of ids cut short, many ranges."""
    monkeypatch.setattr(trie, "CHUNK", 7)
    monkeypatch.setattr(trie, "IDS", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert got(trie.trie(table(spark, talks, 5), band=16)) == plain_trie(talks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


def test_repeated_rows_are_turns(spark):
    rows = [(5, 1, "user", "a")] * 3 + [(5, 2, "user", "b")]
    out = trie.trie(table(spark, rows)).collect()
    assert {(r.depth, r.n_convs) for r in out} == {(d, 1) for d in range(5)}


def test_empty(spark):
    assert trie.trie(table(spark, [(1, 1, "u", "t")]).limit(0)).count() == 0
    only = trie.trie(table(spark, [(9, None, None, None)]))  # crc32 takes more turns than there are
    assert got(only) == plain_trie([(9, None, None, None)])
