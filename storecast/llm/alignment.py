"""Token alignment of two tokenizers, worked out once for each distinct text."""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import dropped, join_hot, staged

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Letters by any version of the tables behind A's pattern.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
#: A single blank before a letter: both tokenizers start a token there, whatever stands around.
_BLANK = re.compile(rf"(?<=\S) (?={_LETTER})")
_LETTERS, _INNER = re.compile(f"{_LETTER}+"), re.compile(rf"{_LETTER}(.*\S)?", re.DOTALL)
#: About how many words each worker keeps with their tokens, and the longest of them.
CACHE, WORD = 1 << 18, 64
#: Bytes of text encoded together, links listed at a time, and pairs a task holds before it lets them go.
SLICE_BYTES, LINKS, HELD = 1 << 19, 1 << 22, 1 << 20
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _byte_letters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class _Bytes:
    """Byte strings by id, as one array."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The strings of `ids`, concatenated."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Tokenizers:
    """The two tokenizers, loaded where they are first used. What travels is the folder's path
    and the ids that A never gives.

    Plain words of letters are encoded by A's merges in another library, faster. Both take
    the least-ranked pair first, but that one merges any two neighbours that join to a
    known token, A only listed pairs. Where they could differ, A leaves the token
    itself in two: without such tokens both give the same ids.
    """

    def __init__(self, folder: str = TOKENIZERS, never: frozenset[int] | None = None):
        self.folder, self.never = folder, never

    def __reduce__(self):
        return _loaded, (self.folder, self.never)

    def checked(self) -> Tokenizers:
        """With `never` worked out, once on the driver; the ids that do not encode to themselves.
        None, and no second library, where ids do not rise in the order of merges."""
        vocab = self.vocab
        with open(f"{self.folder}/{A_FILE}", encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if order != sorted(order):
            return self
        letters, texts = _byte_letters(), {}
        for token, i in vocab.items():
            try:
                texts[i] = bytes(letters[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):
                continue
        words = [i for i, t in texts.items() if _LETTERS.fullmatch(t.removeprefix(" "))]
        got = self.a.encode_batch([texts[i] for i in words], add_special_tokens=False)
        return Tokenizers(self.folder, frozenset(i for i, e in zip(words, got, strict=True) if e.ids != [i]))

    @cached_property
    def vocab(self) -> dict[str, int]:
        return self.a.get_vocab(with_added_tokens=False)

    @cached_property
    def merged(self):
        """A's merges on words of letters, in the other library."""
        import tiktoken
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in self.vocab.items() if i not in self.never}
        return tiktoken.Encoding("words", pat_str=f" ?{_LETTER}+", mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        made = Tokenizer.from_file(f"{self.folder}/{A_FILE}")
        made.encode_special_tokens = True
        return made

    @cached_property
    def b(self):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=f"{self.folder}/{B_FILE}")

    @cached_property
    def a_bytes(self) -> _Bytes:
        letters = _byte_letters()
        known = self.a.get_vocab(with_added_tokens=True)
        out = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return _Bytes(out)

    @cached_property
    def b_bytes(self) -> _Bytes:
        return _Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                       for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]])

    @cached_property
    def numbers(self) -> _Bytes:
        """Decimal ids, each with the sign that follows it: ',', '|', ';' or nothing."""
        most = max(len(self.a_bytes.size), len(self.b_bytes.size))
        return _Bytes([f"{i}{sign}".encode() for sign in (",", "|", ";", "") for i in range(most)])

    @cached_property
    def words(self) -> list[dict[str, tuple | None]]:
        """What `_aligned` says of the words met of late, and of those met before these."""
        return [{}, {}]

    @cached_property
    def splits(self) -> bool:
        """B has no piece with a blank behind another character. A's pattern starts a token at
        a blank before a letter anyway."""
        return not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def encode(self, texts: list[str], letters: bool) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text with a blank before it. `letters`: words of letters only."""
        spaced = [" " + t for t in texts]
        if letters:
            a = [self.merged.encode_ordinary(t) for t in spaced]
        else:
            a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)


@lru_cache(maxsize=1)
def _loaded(folder: str, never: frozenset[int] | None) -> Tokenizers:
    """A worker loads its tokenizers once, and the words it has met serve its later tasks too."""
    return Tokenizers(folder, never)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum())), size


def _whole(ids: np.ndarray, size: np.ndarray, strings: _Bytes, spaced: list[bytes]) -> np.ndarray:
    """Whether each text's tokens join to its bytes."""
    ends = np.concatenate(([0], np.cumsum(strings.size[ids])))[np.concatenate(([0], np.cumsum(size)))]
    joined = strings.of(ids).tobytes()
    return np.array([joined[s:e] == t for s, e, t in zip(ends[:-1], ends[1:], spaced, strict=True)], bool)


def _pairs(doc, a, b, group_a, group_b, n_groups: int, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """(text and id pair in one number, links), sorted: the links of each text by id pair.
    A group lists its distinct ids, with their numbers, against each other, in
    pieces of a bounded number of pairs."""
    sides = []
    for ids, group, n in ((a, group_a, n_a), (b, group_b, n_b)):
        key, count = np.unique(group * n + ids, return_counts=True)
        sides.append((key // n, key % n, count))
    (ga, ia, ca), (gb, ib, cb) = sides
    first = np.searchsorted(gb, np.arange(n_groups + 1))
    wide = np.diff(first)[ga]  # partners of each distinct A id of a group
    ends = np.cumsum(wide)
    keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = 0
    while s < len(ga):
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + LINKS, "right")))
        w = wide[s:e]
        left = np.repeat(np.arange(s, e), w)
        right = np.repeat(first[ga[s:e]] - (np.cumsum(w) - w), w) + np.arange(w.sum())
        key = (doc[ga[left]] * n_a + ia[left]) * n_b + ib[right]
        keys, at = np.unique(np.concatenate((keys, key)), return_inverse=True)
        sums = np.bincount(at, np.concatenate((sums, ca[left] * cb[right])), len(keys)).astype(np.int64)
        s = e
    return keys, sums


def _aligned(lines: list[list[str]], tools: Tokenizers, letters: bool = False) -> list[tuple | None]:
    """(n_a, n_b, n_groups, n_links, groups as text, id pairs, links of each) of each word of
    each line; the last two are packed 64-bit numbers. Lines are encoded whole, with blanks
    between their words. None where the tokens of a line do not give it back."""
    texts = [" ".join(words) for words in lines]
    (a, size_a), (b, size_b) = map(_flat, tools.encode(texts, letters))
    spaced = [(" " + t).encode() for t in texts]
    good = _whole(a, size_a, tools.a_bytes, spaced) & _whole(b, size_b, tools.b_bytes, spaced)
    n_words = np.array([len(words) for words in lines])
    out: list[tuple | None] = [None] * int(n_words.sum())
    if not good.any():
        return out
    a, b = a[np.repeat(good, size_a)], b[np.repeat(good, size_b)]
    full = np.flatnonzero(np.repeat(good, n_words))
    end_a, end_b = np.cumsum(tools.a_bytes.size[a]), np.cumsum(tools.b_bytes.size[b])
    both = np.zeros((2, end_a[-1] + 1), bool)
    both[0, end_a], both[1, end_b] = True, True
    last_a, last_b = both[1, end_a], both[0, end_b]  # last tokens of groups; ends of words are among them
    cuts = end_a[last_a]
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    every = list(chain.from_iterable(lines))
    doc = np.searchsorted(np.cumsum([1 + len(every[i].encode()) for i in full]), cuts)
    in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    n = len(full)
    size_a, size_b = np.bincount(doc[group_a], minlength=n), np.bincount(doc[group_b], minlength=n)

    # The tokens of both sides in the order of groups, A before B, each with the sign behind it.
    place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
    sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    sign_a[np.cumsum(in_a) - 1] = 1
    sign_b[np.cumsum(in_b) - 1] = 2
    sign_b[np.cumsum(in_b)[np.flatnonzero(np.diff(doc, append=n))] - 1] = 3
    most = len(tools.numbers.size) // 4
    written = np.empty(len(a) + len(b), np.int64)
    written[place_a], written[place_b] = sign_a * most + a, sign_b * most + b
    text = tools.numbers.of(written).tobytes()
    chars = np.cumsum(tools.numbers.size[written])[np.cumsum(size_a + size_b) - 1]

    n_a, n_b = len(tools.a_bytes.size), len(tools.b_bytes.size)
    keys, links = _pairs(doc, a, b, group_a, group_b, len(cuts), n_a, n_b)
    at = (8 * np.searchsorted(keys, np.arange(n + 1) * (n_a * n_b))).tolist()
    pair, links = (keys % (n_a * n_b)).tobytes(), links.tobytes()
    rows = zip(size_a.tolist(), size_b.tolist(), np.bincount(doc, minlength=n).tolist(),
               np.bincount(doc, in_a * in_b, n).astype(np.int64).tolist(), [0, *chars[:-1].tolist()], chars.tolist(), strict=True)
    for k, (x, y, groups, total, start, end) in enumerate(rows):
        out[full[k]] = x, y, groups, total, text[start:end], pair[at[k]:at[k + 1]], links[at[k]:at[k + 1]]
    return out


def _looked_up(words: list[str], tools: Tokenizers) -> tuple[dict[str, tuple | None], list[str]]:
    """What `_aligned` says of words, these among them, and those of these that are too long
    to be kept. New words that start with a letter are encoded many to a line, others alone.
    Words stay while they are met again: of two halves the older one goes when the other is full."""
    if len(tools.words[0]) > CACHE // 2:
        tools.words[:] = {}, tools.words[0]
    known, before = tools.words
    unseen = [w for w in words if w not in known]
    known.update((w, before[w]) for w in unseen if w in before)
    new = [w for w in unseen if w not in before]
    got: dict[str, tuple | None] = {}
    if tools.splits:
        pure, inner = [], []
        for w in new:
            if tools.never is not None and _LETTERS.fullmatch(w):
                pure.append(w)
            elif _INNER.fullmatch(w):
                inner.append(w)
        for some, letters in ((pure, True), (inner, False)):
            lines = [some[i:i + 4096] for i in range(0, len(some), 4096)]
            got |= dict(zip(some, _aligned(lines, tools, letters), strict=True)) if lines else {}
    # A line with a word that is not given back says nothing of the others.
    alone = [w for w in new if got.get(w) is None]
    got |= dict(zip(alone, _aligned([[w] for w in alone], tools), strict=True)) if alone else {}
    known.update(got)
    return known, [w for w in new if len(w) > WORD]


def align(texts: list[str | None], tools: Tokenizers) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, id pairs, links of each) of each text, from
    those of its words: groups end wherever a word does."""
    parts = [(_BLANK.split(t) if tools.splits else [t]) if t else [] for t in texts]
    found, passing = _looked_up(list(dict.fromkeys(chain.from_iterable(parts))), tools)
    nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
    out = []
    for words in parts:
        rows = [found[w] for w in words]
        if not rows or None in rows:
            out.append(nothing)
            continue
        n_a, n_b, groups, total, text, pairs, links = zip(*rows, strict=True)
        pair = np.frombuffer(b"".join(pairs), np.int64)
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        times = np.add.reduceat(np.frombuffer(b"".join(links), np.int64)[order], first)
        out.append((sum(n_a), sum(n_b), sum(groups), sum(total), hashlib.sha256(b";".join(text)).hexdigest(), pair[first], times))
    for w in passing:
        del found[w]
    return out


def _texts(column: pa.Array):
    """(first row, texts) of runs of rows of about SLICE_BYTES; null where not UTF-8."""
    first, held, size = 0, [], 0
    for i, value in enumerate(column):
        raw = value.as_py() or b""
        if held and size + len(raw) > SLICE_BYTES:
            yield first, held
            first, held, size = i, [], 0
        try:
            held.append(raw.decode("utf-8"))
        except UnicodeDecodeError:
            held.append(None)
        size += len(raw)
    if held:
        yield first, held


def align_texts(docs: DataFrame, tools: Tokenizers) -> DataFrame:
    """(key, copies, measures, pairs, links) of each distinct non-empty text; pairs and links
    are packed little-endian 64- and 32-bit numbers. The shuffle is by the whole text;
    copies are counted on the way, so a common text is one row of each task."""
    def run(batches):
        for batch in batches:
            for first, texts in _texts(batch.column(2)):
                rows = align(texts, tools)
                part = batch.slice(first, len(texts))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_pydict({
                    "key": part.column(0), "copies": part.column(1), "n_a": pa.array(cols[0], pa.int64()),
                    "n_b": pa.array(cols[1], pa.int64()), "n_groups": pa.array(cols[2], pa.int64()),
                    "n_links": pa.array(cols[3], pa.int64()), "groups_sha256": pa.array(cols[4], pa.string()),
                    "pairs": pa.array([k.astype("<i8").tobytes() for k in cols[5]], pa.binary()),
                    "links": pa.array([n.astype("<i4").tobytes() for n in cols[6]], pa.binary())})

    texts = (docs.where("text is not null and text != ''").groupBy(F.col("text").alias("__text"))
             .agg(F.count(F.lit(1)).alias("copies"))
             .select(_key("__text").alias("key"), "copies", F.col("__text").cast("binary").alias("raw")))
    return texts.mapInArrow(run, f"key binary, copies long, {_MEASURES}, pairs binary, links binary")


def _key(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): how many documents hold each id pair linked, and whether that is the
    most of its A id. Each task adds up its own texts before the shuffle."""
    def count(batches):
        keys, sums, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged():
            every = np.concatenate([keys, *[k for k, _ in waiting]])
            out, at = np.unique(every, return_inverse=True)
            return out, np.bincount(at, np.concatenate([sums, *[n for _, n in waiting]]), len(out)).astype(np.int64)

        for batch in batches:
            for copies, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                k = np.frombuffer(raw.as_py(), "<i8")
                waiting.append((k, np.full(len(k), copies)))
                size += len(k)
                if size > HELD:
                    keys, sums = merged()
                    waiting, size = [], 0
                    if len(keys) > HELD:
                        yield pa.RecordBatch.from_pydict({"pair": keys, "n": sums})
                        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, sums = merged()
        yield pa.RecordBatch.from_pydict({"pair": keys, "n": sums})

    n = (aligned.select("copies", "pairs").mapInArrow(count, "pair long, n long")
         .groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {n_b}")))
    n = staged(n, "pairs")
    top = n.groupBy("a").agg(F.max("n").alias("top"))
    out = staged(n.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-counts")
    dropped(n)
    return out


def weigh(aligned: DataFrame, counts: DataFrame, most: int = 1 << 20) -> DataFrame:
    """`aligned` without its packed columns, and n_best, count_sum, of each distinct text. The counts of the commonest id pairs are
    broadcast, `most` at most: of all that documents hold linked, in sum T, fewer than
    `most` pairs can be held more than T / `most` times. The other pairs meet their
    texts in a shuffle, in which none of them is common."""
    total, n = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    floor = 0 if n <= most else total // most
    common = counts.where(F.col("n") > floor).toArrow().sort_by("pair")
    known = aligned.sparkSession.sparkContext.broadcast(tuple(
        common.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")))
    kept = [c for c in aligned.columns if c not in ("pairs", "links")]

    def each(batches):
        pair, n, best = known.value
        for batch in batches:
            keys = [np.frombuffer(x.as_py(), "<i8") for x in batch.column("pairs")]
            links = [np.frombuffer(x.as_py(), "<i4") for x in batch.column("links")]
            size = np.array([len(k) for k in keys], np.int64)
            code = np.concatenate([*keys, np.zeros(0, np.int64)]).astype(np.int64)
            times = np.concatenate([*links, np.zeros(0, np.int32)]).astype(np.int64)
            at = np.minimum(np.searchsorted(pair, code), max(len(pair) - 1, 0))
            hit = pair[at] == code if len(pair) else np.zeros(len(code), bool)
            yield batch, size, code, times, at, hit

    def summed(batches):
        pair, n, best = known.value
        for batch, size, code, times, at, hit in each(batches):
            row = np.repeat(np.arange(len(size)), size)[hit]
            sums = np.zeros((2, len(size)), np.int64)
            np.add.at(sums[0], row, times[hit] * best[at[hit]])
            np.add.at(sums[1], row, times[hit] * n[at[hit]])
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in kept}, "n_best": sums[0], "count_sum": sums[1]})

    def others(batches):
        for batch, size, code, times, at, hit in each(batches):
            row = np.repeat(np.arange(len(size)), size)[~hit]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key").take(pa.array(row)), "pair": code[~hit], "links": times[~hit]})

    sums = aligned.mapInArrow(summed, f"key binary, copies long, {_MEASURES}, n_best long, count_sum long")
    if not floor:
        return sums
    rare = (aligned.select("key", "pairs", "links").mapInArrow(others, "key binary, pair long, links long").join(counts.where(F.col("n") <= floor), "pair")
            .groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("r_best"),
                                F.sum(F.col("links") * F.col("n")).alias("r_sum")))
    return sums.join(rare, "key", "left").select(
        *kept, (F.col("n_best") + F.coalesce("r_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("r_sum", F.lit(0))).alias("count_sum"))


def align_documents(docs: DataFrame, *, folder: str = TOKENIZERS, most: int = 1 << 20) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null or empty text, or one that its tokens do not give back: zeros and ''. Very long
    texts: encoded whole, links listed in pieces. Repeated rows and equal texts: tokenized
    and aligned once, each counts as a document. Null doc_id: a row like others. Ties of
    the highest count: all of them. Empty table: no rows. Other columns are not read.
    """
    tools = Tokenizers(folder).checked()
    aligned = staged(align_texts(docs, tools), "aligned")
    counts = pair_counts(aligned, len(tools.b_bytes.size))
    measures = staged(weigh(aligned, counts, most), "measures")
    # Texts that a 512th of all rows or more have in common are 512 at most.
    total = measures.agg(F.sum("copies")).first()[0] or 0
    hot = measures.where(F.col("copies") * 512 >= max(total, 1 << 14)).drop("copies")
    rows = docs.select("doc_id", F.when(F.col("text") != "", _key("text")).alias("key"))
    out = join_hot(rows.where("key is not null"), measures.drop("copies"), hot, ["key"])
    none = rows.where("key is null").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in NUMBERS], F.lit("").alias("groups_sha256"))
    out = staged(out.select("doc_id", *NUMBERS, "groups_sha256").unionByName(none), "alignment")
    dropped(aligned, counts, measures)
    return out
