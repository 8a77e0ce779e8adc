"""Token alignment against a plain version."""

from __future__ import annotations

import collections
import hashlib
import pickle
import random

import numpy as np
import pytest

from storecast.llm import alignment

TOOLS = alignment.Tokenizers().checked()


def plain_groups(text):
    """[(A ids, B ids)] of a text, token by token."""
    a, b = TOOLS.a.encode(" " + text, add_special_tokens=False).ids, TOOLS.b.encode(text)
    letters = alignment._byte_letters()
    bytes_a = [bytes(letters[c] for c in TOOLS.a.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if TOOLS.b.is_byte(i) else p.replace("▁", " ").encode()
               for i in b for p in [TOOLS.b.id_to_piece(i)]]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        ga, gb = [], []
        while i < len(a) and ends_a[i] <= end:
            ga.append(a[i])
            i += 1
        while j < len(b) and ends_b[j] <= end:
            gb.append(b[j])
            j += 1
        groups.append((ga, gb))
    return groups


def plain(rows):
    held, each = collections.Counter(), []
    for i, text in rows:
        groups = plain_groups(text) if text else []
        links = collections.Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        each.append((i, groups, links))
        held.update(set(links))
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for i, groups, links in each:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
                    sum(n for k, n in links.items() if held[k] == top[k[0]]), sum(n * held[k] for k, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def awkward(corpus):
    rng = random.Random(4)
    odd = ["a▁b", "<|endoftext|> and <s> </s> <unk> <0x0A>", "\x00\x01", "  two  blanks \n\n\t", "日本語のテキスト 😀👍🏽 ünïcödé",
           "▁", " ", "\n", "a" * 3000, "́" * 50, "x\r\ny", "﻿mark", "ﬁne ℌ½"]
    odd += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0xA0, 0x2FF), rng.randint(0x4E00, 0x4E80)]))
                    for _ in range(rng.randint(1, 200))) for _ in range(30)]
    return [*corpus, *[(900 + i, t) for i, t in enumerate(odd)], (900, odd[0]), (2000, odd[4])]


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, b"k", 1, "b") for i, t in rows],
                                 "doc_id long, text string, key binary, copies int, best string").repartition(3)


@pytest.mark.parametrize("most", [1 << 20, 50, 0])
def test_alignment(spark, awkward, most, monkeypatch):
    """All counts broadcast, only the commonest, none; links listed in small pieces."""
    if most < 100:
        monkeypatch.setattr(alignment, "LINKS", 11)
        monkeypatch.setattr(alignment, "HELD", 100)
        monkeypatch.setattr(alignment, "SLICE_BYTES", 500)
    assert got(alignment.align_documents(rows_of(spark, awkward), most=max(most, 1))) == plain(awkward)


def test_one_group_of_many_tokens():
    """Two token streams that share no end but the last: links are counted, not listed."""
    a, b = np.arange(300) % 7, np.arange(500) % 5
    keys, links = alignment._pairs(np.zeros(1, np.int64), a, b, np.zeros(300, np.int64), np.zeros(500, np.int64), 1, 10, 10)
    want = collections.Counter(x * 10 + y for x in a for y in b)
    assert dict(zip(keys.tolist(), links.tolist(), strict=True)) == want


def test_words_by_themselves_are_the_whole_text():
    """Every split, and the second library, against whole texts through the first one."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZéüßñçÀÿ"
    joints = [" "] * 12 + [", ", ". ", "\n", "  ", "'s ", " - ", "\u00a0", "\t ", " (", ") ", "' ", "…", " 12 ", "\x1c ", "\u2003 ", "×"]
    common = [t.removeprefix(" ") for t in (TOOLS.a.decode([i]) for i in range(300, 50000, 7)) if t.strip().isalpha()]
    texts = []
    for _ in range(400):
        words = [rng.choice(common) + rng.choice(["", rng.choice(common)]) if rng.random() < 0.6 else
                 "".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(1, 120))]
        texts.append("".join(w + rng.choice(joints) for w in words))
    assert TOOLS.splits and TOOLS.never is not None
    for text, row in zip(texts, alignment.align(texts, TOOLS), strict=True):
        groups = plain_groups(text)
        want = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        assert row[4] == hashlib.sha256(want.encode()).hexdigest() and row[2] == len(groups)


def test_nothing_to_align(spark):
    rows = rows_of(spark, [(1, None), (2, ""), (None, "")])
    assert got(alignment.align_documents(rows)) == sorted([(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, None)], key=repr)
    assert alignment.align_documents(rows.limit(0)).count() == 0




def test_words_met_again_are_not_encoded_again(monkeypatch):
    """Also where new words overflow the cache each time, and in a worker's next task."""
    monkeypatch.setattr(alignment, "CACHE", 64)
    encoded = collections.Counter()
    aligned = alignment._aligned
    monkeypatch.setattr(alignment, "_aligned", lambda lines, *more: (encoded.update(w for x in lines for w in x), aligned(lines, *more))[1])
    again, long = ["common", "words", "stay."], "long" * alignment.WORD
    rng = random.Random(3)
    first = pickle.loads(pickle.dumps(TOOLS))
    first.words[:] = {}, {}
    for _ in range(10):
        tools = pickle.loads(pickle.dumps(TOOLS))
        fresh = ["".join(rng.choices("abcdefgh", k=9)) for _ in range(40)]
        text = " ".join([*again, *fresh, long])
        (row,), groups = alignment.align([text], tools), plain_groups(text)
        assert row[:3] == (sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups))
        links = collections.Counter(x * len(tools.b_bytes.size) + y for ga, gb in groups for x in ga for y in gb)
        assert dict(zip(row[5].tolist(), row[6].tolist(), strict=True)) == links
        assert sum(map(len, tools.words)) <= 128 and long not in tools.words[0]
    assert [encoded[w] for w in again] == [1, 1, 1] and encoded[long] == 10
