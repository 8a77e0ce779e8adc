"""Language-model scores from a log-frequency Bloom filter."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import fold, staged, text_bytes
from .text import SPACE, hashed_words, mix, runs, slices

_END, _START = np.uint64(0x1D8AF066A5F0E5B1), np.uint64(0x7C3A9B0DA1F2C6E5)
HASHES = 4
MAX_LEVELS = 48


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, token before) with one end token after each text."""
    doc, name = hashed_words(data, offs, ~SPACE)
    n_docs = len(offs) - 1
    count = np.bincount(doc, minlength=n_docs) + 1
    last = np.cumsum(count) - 1
    token = np.empty(len(name) + n_docs, np.uint64)
    token[np.arange(len(name)) + doc] = name
    token[last] = _END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[last - count + 1] = _START
    return np.repeat(np.arange(n_docs), count), token, before


def unigram_key(token: np.ndarray) -> np.ndarray:
    return mix(token ^ np.uint64(0xA24BAED4963EE407))


def bigram_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9FB21C651E98DF25) + mix(token))


def block_of(key: np.ndarray, blocks: int) -> np.ndarray:
    return ((key >> np.uint64(40)) % np.uint64(blocks)).astype(np.int64)


def levels_of(count: np.ndarray) -> np.ndarray:
    """Quantised count: 1 + floor(log2(count))."""
    return np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1


def expected(level: np.ndarray) -> np.ndarray:
    """The middle count of a level, 0 for none."""
    return np.where(level > 0, (np.exp2(level - 1.0) + np.exp2(np.maximum(level, 1) * 1.0) - 1) / 2, 0.0)


def _places(key: np.ndarray, level, size: np.ndarray):
    """Bit positions in blocks of `size` bits, one array for each hash function."""
    one = mix(key + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))
    two = mix(one) | np.uint64(1)
    for h in range(HASHES):
        yield (one + np.uint64(h) * two) % size


def filter_block(key: np.ndarray, count: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of a block: an n-gram is put in once for each level up to its own."""
    level = levels_of(count)
    size = max(64, -(-int(level.sum()) * bits // 64) * 64)
    out = np.zeros(size, bool)
    for k in range(1, int(level.max(initial=0)) + 1):
        for place in _places(key[level >= k], k, np.uint64(size)):
            out[place.astype(np.int64)] = True
    return np.packbits(out, bitorder="little")


class Filter:
    """Blocks of a filter, as many as one broadcast holds."""

    def __init__(self, blocks: int, numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray, data: bytes):
        self.blocks, self.data = blocks, data
        self.start, self.size = np.zeros(blocks, np.uint64), np.zeros(blocks, np.uint64)
        self.start[numbers], self.size[numbers] = starts, sizes

    def level(self, key: np.ndarray) -> np.ndarray:
        """The largest level whose probes, from 1 upward, all hit; 0 where the block is not here."""
        bits = np.frombuffer(self.data, np.uint8)
        block = block_of(key, self.blocks)
        size, start = self.size[block], self.start[block]
        out = np.zeros(len(key), np.int64)
        live = np.flatnonzero(size > 0)
        for k in range(1, MAX_LEVELS):
            hit = np.ones(len(live), bool)
            for place in _places(key[live], k, size[live]):
                at = place + start[live] * np.uint64(8)
                hit &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            live = live[hit]
            if not len(live):
                break
            out[live] = k
        return out


def _emit_counts(blocks: int, chunk_tokens: int):
    """For each block of n-gram keys and chunk of documents: how often each word is
    in each document, and how often each bigram is in the training documents. The
    upper bit of a posting's document marks the training ones; `starts` counts those.
    The end token, which every document has once, takes no posting. The row of block
    0 also names the chunk's documents."""
    def emit(batches):
        from pyspark import TaskContext
        held, size, chunk = [], 0, TaskContext.get().partitionId() << 32

        def flush(chunk):
            ids = pa.concat_arrays([h[0] for h in held])
            empty = np.asarray(ids.is_null())
            doc_id = np.asarray(ids.fill_null(0)).astype(np.int64)
            fp = np.concatenate([h[1] for h in held]).astype(np.int64)
            learn = np.concatenate([h[2] for h in held])
            shift = np.cumsum([0] + [len(h[1]) for h in held])
            doc = np.concatenate([h[3] + s for h, s in zip(held, shift, strict=False)])
            token = np.concatenate([h[4] for h in held])
            taught = learn[doc]
            pair = bigram_key(np.concatenate([h[5] for h in held])[taught], token[taught])
            held.clear()
            word = token != _END
            name, at = np.unique(unigram_key(token[word]), return_inverse=True)
            doc = doc[word]
            del token, taught, word
            pair, pairs = np.unique(pair, return_counts=True)

            def by_block(key):
                block = block_of(key, blocks)
                order = np.argsort(block, kind="stable")
                return order, np.searchsorted(block[order], np.arange(blocks + 1))

            order, cut = by_block(name)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            post = (place[at].astype(np.uint64) << np.uint64(32)) | doc.astype(np.uint64)
            del at, doc, place
            post.sort()
            first, n = runs(post)
            post = post[first]
            at, doc_of = (post >> np.uint64(32)).astype(np.int64), post.astype(np.uint32)
            doc_of |= learn[doc_of].astype(np.uint32) << np.uint32(31)
            starts = int(learn.sum())
            name, post_cut = name[order], np.searchsorted(at, cut)
            order, pair_cut = by_block(pair)
            pair, pairs = pair[order], pairs[order]
            for b in range(blocks):
                own, posts, two = (slice(c[b], c[b + 1]) for c in (cut, post_cut, pair_cut))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([b], pa.int32()), "chunk": pa.array([chunk], pa.int64()),
                    "doc_id": pa.array([None if b else doc_id.tobytes() + empty.tobytes()], pa.binary()), "fp": pa.array([None if b else fp.tobytes()], pa.binary()),
                    "starts": pa.array([starts], pa.int64()), "name": pa.array([name[own].tobytes()]),
                    "post_name": pa.array([(at[posts] - cut[b]).astype(np.uint32).tobytes()]), "post_doc": pa.array([doc_of[posts].tobytes()]),
                    "post_n": pa.array([n[posts].astype(np.uint32).tobytes()]), "pair": pa.array([pair[two].tobytes()]),
                    "pairs": pa.array([pairs[two].astype(np.uint32).tobytes()])})

        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            fp, learn = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            for i, j, data, offs in slices(batch.column(3)):
                doc, token, before = tokens(data, offs)
                held.append((ids[i:j], fp[i:j], learn[i:j], doc, token, before))
                size += len(token)
                if size >= chunk_tokens:
                    yield from flush(chunk)
                    size, chunk = 0, chunk + 1
        if held:
            yield from flush(chunk)
    return emit


COUNTS = ("block int, chunk long, doc_id binary, fp binary, starts long, name binary, post_name binary, post_doc binary, "
          "post_n binary, pair binary, pairs binary")
BLOCK = "block int, chunk long, doc_id binary, fp binary, doc binary, part binary, known binary, bits binary, n long, v long, ends long"


def _close_block(bits: int, blocks: int):
    """Of one block: for each chunk the parts of the base score of the documents that
    hold a word of the block, and once its filter bitmap and token totals."""
    def close(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        names = [np.frombuffer(x, np.uint64) for x in frame["name"]]
        every, at = np.unique(np.concatenate(names), return_inverse=True)
        cut = np.cumsum([0] + [len(x) for x in names])
        count, starts, out = np.zeros(len(every)), int(frame["starts"].sum()), []

        def postings(k):
            row = frame.iloc[k]
            name, doc, n = (np.frombuffer(row[c], np.uint32) for c in ("post_name", "post_doc", "post_n"))
            return at[cut[k]:cut[k + 1]][name], doc & np.uint32(0x7FFFFFFF), n, doc >> np.uint32(31) == 1

        for k in range(len(frame)):
            place, _, n, taught = postings(k)
            count += np.bincount(place[taught], n[taught], len(every))
        worth, seen = np.log10(count + 1), count > 0
        for k in range(len(frame)):
            place, doc, n, _ = postings(k)
            held, where = np.unique(doc, return_inverse=True)
            out.append({"block": block, "chunk": frame["chunk"].iloc[k], "doc_id": frame["doc_id"].iloc[k], "fp": frame["fp"].iloc[k],
                        "doc": held.tobytes(), "part": np.bincount(where, n * worth[place], len(held)).tobytes(),
                        "known": np.bincount(where, n * seen[place], len(held)).astype(np.int64).tobytes()})
        pair, where = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in frame["pair"]]), return_inverse=True)
        pairs = np.bincount(where, np.concatenate([np.frombuffer(x, np.uint32) for x in frame["pairs"]]), len(pair))
        key, n = np.concatenate((every[seen], pair)), np.concatenate((count[seen], pairs))
        tokens, distinct = int(count.sum()), int(seen.sum())
        for border in unigram_key(np.array([_START, _END])):  # one of each in every training document
            if starts and block_of(border, blocks) == block:
                key, n = np.append(key, border), np.append(n, starts)
        if starts and block == 0:
            tokens, distinct = tokens + starts, distinct + 1
        out.append({"block": block, "bits": filter_block(key, n, bits).tobytes(), "n": tokens, "v": distinct, "ends": starts})
        res = pd.DataFrame(out, columns=["block", "chunk", "doc_id", "fp", "doc", "part", "known", "bits", "n", "v", "ends"])
        binary = ["doc_id", "fp", "doc", "part", "known", "bits"]
        res[binary] = res[binary].astype(object).where(res[binary].notna(), None)
        return res.astype({c: "Int64" for c in ("chunk", "n", "v", "ends")})
    return close


def _close_chunk(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one chunk: its documents' sums over all blocks."""
    head = frame[frame["fp"].notna()].iloc[0]
    fp = np.frombuffer(head["fp"], np.int64)
    ids, empty = np.frombuffer(head["doc_id"], np.int64, len(fp)), np.frombuffer(head["doc_id"], bool, offset=8 * len(fp))
    doc = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["doc"]])
    part, known = (np.concatenate([np.frombuffer(x, t) for x in frame[c]]) for c, t in (("part", np.float64), ("known", np.int64)))
    return pd.DataFrame({
        "doc_id": pd.array(np.where(empty, 0, ids), "Int64").copy() if not empty.any() else pd.array([None if e else i for i, e in zip(ids, empty, strict=True)], "Int64"),
        "fp": fp,
        "part": np.bincount(doc, part, len(fp)),
        "known": np.bincount(doc, known, len(fp)).astype(np.int64)})


def score_documents(docs: DataFrame, held_mod: int = 7, held: int = 2, bits: int = 10, prior: float = 60.0,
                    block_bytes: int = 8 << 20, broadcast_bytes: int = 256 << 20, chunk_tokens: int = 2_000_000) -> DataFrame:
    """Base and model scores of every document.

    Training documents have crc32(doc_id) % held_mod != held. Their unigrams and
    bigrams go into a log-frequency Bloom filter: a quantised count of k puts k
    entries in, and probing upward from 1 until a miss gives it back, never too
    low. The model is p(w | h) = (c(h w) + prior * p(w)) / (c(h) + prior) with
    p(w) = (c(w) + 1) / (N + V + 1), counts as the filter returns them and the
    ratio held to 1.

    All counts are taken in blocks of n-gram keys, their number in proportion to
    the text (`block_bytes` of text each). A block gives parts of the base score, from
    exact counts, only for the documents that hold one of its words, so all parts
    together grow with the text; the block of a very common word holds a posting for
    each document with it. The filter has
    `bits` bits for each entry; it is broadcast in parts of at most
    `broadcast_bytes`, with a pass over the documents for each, so what a worker
    holds is bounded at any size.

    Very long texts: whole; a task holds `chunk_tokens` tokens and the longest text.
    Null text: as empty, one end token. Null doc_id: kept, trains by the crc32 of
    an empty text. Repeated rows: each trains and each has its row. Empty table:
    no rows. Other columns are not read. doc_id must be an integer.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("fp"),
                       (fold("doc_id", held_mod) != held).alias("learn"), "text")
    blocks = max(12, math.ceil(text_bytes(base) / block_bytes))
    table = staged(base.mapInArrow(_emit_counts(blocks, chunk_tokens), COUNTS).groupBy("block")
                   .applyInPandas(_close_block(bits, blocks), BLOCK), "lm-blocks")
    total = table.agg(F.sum("n"), F.sum("v"), F.max("ends")).first()
    n_all, v_all, ends = (int(x or 0) for x in total)

    sizes = table.where("bits is not null").select("block", F.length("bits").alias("size")).orderBy("block").collect()
    parts: list[list] = [[]]
    for row in sizes:
        if parts[-1] and sum(r["size"] for r in parts[-1]) + row["size"] > broadcast_bytes:
            parts.append([])
        parts[-1].append(row)

    now = base.withColumn("levels", F.lit(None).cast("binary"))
    for k, part in enumerate(parts):
        now = now.mapInArrow(_pass(spark, table, blocks, part, k == len(parts) - 1, n_all, v_all, prior),
                             "doc_id long, fp long, learn boolean, text string, levels binary"
                             if k < len(parts) - 1 else "doc_id long, fp long, n_tokens long, score double")
        if k < len(parts) - 1:
            now = staged(now, "lm-levels")
    rows = now.withColumn("rows", F.lit(1)).withColumn("part", F.lit(0.0)).withColumn("known", F.lit(0).cast("long"))
    sums = table.where("chunk is not null").select("chunk", "doc_id", "fp", "doc", "part", "known").groupBy("chunk").applyInPandas(
        _close_chunk, "doc_id long, fp long, part double, known long")
    parts_of = sums.select(
        "doc_id", "fp", F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("score"), F.lit(0).alias("rows"),
        (F.col("part") + math.log10(ends + 1)).alias("part"), (F.col("known") + int(ends > 0)).alias("known"))  # with the end token's
    per = F.sum("rows")  # equal rows give equal sums; each takes its share
    whole = rows.unionByName(parts_of).groupBy("doc_id", "fp").agg(
        per.alias("rows"), (F.sum("n_tokens") / per).cast("long").alias("n_tokens"), (F.sum("known") / per).cast("long").alias("n_known"),
        (F.sum("part") / per).alias("part"), (F.sum("score") / per).alias("score"))
    return whole.select(
        "doc_id", (fold("doc_id", held_mod) == held).alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("part") - F.col("n_tokens") * F.lit(math.log10(n_all + v_all + 1))).alias("base_score"), "score",
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")).drop("copy")


def _pass(spark, table: DataFrame, blocks: int, part: list, last: bool, n_all: int, v_all: int, prior: float):
    numbers = np.array([r["block"] for r in part], np.int64)
    sizes = np.array([r["size"] for r in part], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = bytearray(int(sizes.sum()))
    place = dict(zip(numbers.tolist(), starts.tolist(), strict=True))
    for row in table.where(F.col("bits").isNotNull() & F.col("block").isin(list(place))).select("block", "bits").toLocalIterator():
        data[place[row["block"]]:place[row["block"]] + len(row["bits"])] = row["bits"]
    known = spark.sparkContext.broadcast((numbers, starts.astype(np.uint64), (sizes * 8).astype(np.uint64), bytes(data)))
    del data

    def run(batches):
        table = Filter(blocks, *known.value)

        def probe(key):
            one, at = np.unique(key, return_inverse=True)
            return table.level(one)[at].astype(np.uint8)

        for batch in batches:
            old = batch.column(4)
            n_tokens, score, levels = np.zeros(len(batch), np.int64), np.zeros(len(batch)), []
            for i, j, data, offs in slices(batch.column(3)):
                doc, token, before = tokens(data, offs)
                found = np.stack([probe(unigram_key(token)), probe(unigram_key(before)), probe(bigram_key(before, token))])
                count = np.bincount(doc, minlength=j - i)
                cut = np.cumsum(count)[:-1]
                if old.null_count < len(old):
                    found = np.maximum(found, np.concatenate([np.frombuffer(x.as_py(), np.uint8).reshape(3, -1) for x in old[i:j]], axis=1))
                if not last:
                    levels += [x.tobytes() for x in np.split(found, cut, axis=1)]
                    continue
                w, h, pair = (expected(x.astype(np.int64)) for x in found)
                p_word = (w + 1) / (n_all + v_all + 1)
                p = (np.minimum(pair, h) + prior * p_word) / (h + prior)
                score[i:j] = np.bincount(doc, np.log10(np.minimum(p, 1.0)), j - i)
                n_tokens[i:j] = count
            if last:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": batch.column(1), "n_tokens": n_tokens, "score": score})
            else:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": batch.column(1), "learn": batch.column(2),
                                                  "text": batch.column(3), "levels": pa.array(levels, pa.binary())})
    return run
