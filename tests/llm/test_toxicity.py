"""Subwords and windows against plain versions; what the fit learns, on held-out and unseen words."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from storecast.llm import toxicity

from .conftest import prose

BAD = ["idiot", "moron", "scumbag", "pathetic"]


def arrays(texts):
    data = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def plain_grams(text):
    """The n-grams of 3 to 6 of each word with its two ends, in the order of their first character."""
    out, word = [], ""
    for c in text + " ":
        if c.isalnum():
            word += c.lower()[0]
        elif word:
            marked = f" {word} "
            out += [marked[i:i + n] for i in range(len(marked)) for n in (3, 4, 5, 6) if i + n <= len(marked)]
            word = ""
    return out


def test_subwords_are_the_words_grams():
    rng = random.Random(1)
    texts = ["", "a", "ab", "Ünïcode-Wörter 42!", "  ", "x" * 40, "日本語"] + [prose(rng, rng.randint(0, 30)) for _ in range(20)]
    doc, bucket = toxicity.subwords(*arrays(texts), bits=30)
    names = {}
    for i, t in enumerate(texts):
        want, have = plain_grams(t), bucket[doc == i]
        assert len(want) == len(have)
        for g, b in zip(want, have, strict=True):
            assert names.setdefault(g, b) == b  # the same gram, the same bucket, in any text
    assert len(set(names.values())) == len(names)


def test_windows_cover_each_document():
    rng = random.Random(2)
    size = [rng.choice([0, 1, 7, 8, 9, 12, 13, 40, 41]) for _ in range(60)]
    doc = np.repeat(np.arange(60), size)
    owner, start, end = toxicity.windows(doc, 60, 8)
    for d in range(60):
        mine = [(s, e) for o, s, e in zip(owner, start, end, strict=True) if o == d]
        first = sum(size[:d])
        assert {i for s, e in mine for i in range(s, e)} == set(range(first, first + size[d]))
        assert all(e - s == min(8, size[d]) for s, e in mine) and len(mine) <= max(1, size[d] // 4)
    weight = np.array([rng.random() for _ in range(5)])
    bucket = np.array([rng.randrange(5) for _ in doc])
    want = [np.mean([weight[b] for b in bucket[s:e]]) for s, e in zip(start, end, strict=True)]
    assert np.allclose(toxicity.means(weight, bucket, start, end), want)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(900):
        words = prose(rng, rng.choice([8, 60, 400])).split()
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "x", 1, "y"))
        marks.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, score string").repartition(5)
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_documents_and_misspellings(spark, labelled):
    docs, labels = labelled
    rng = random.Random(4)
    extra = [(5000, "idiott"), (5001, "m0ron you"), (5002, prose(rng, 3000) + " such pathetic idiots " + prose(rng, 3000)),
             (5003, prose(rng, 6000)), (5004, None), (5005, ""), (5006, "!!! ..."), (None, "moron"), (5007, "idiott"), (5007, "idiott")]
    rows = docs.unionByName(spark.createDataFrame([(i, t, None, 0, None) for i, t in extra], docs.schema))
    got = toxicity.score_documents(rows, labels).collect()
    assert len(got) == 900 + len(extra)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.held_out]
    assert all(r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.predicted == (r.doc_id % 4 == 0) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    by = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 5000}
    assert [by[i].predicted for i in (5000, 5001, 5002, 5003, None, 5007)] == [1, 1, 1, 0, 1, 1]
    assert by[5004].score == by[5005].score == by[5006].score and 0 <= by[5004].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_training_sees_neither_held_out_labels_nor_copies_twice(spark, labelled):
    docs, labels = labelled
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    doubled = docs.unionByName(docs.where("doc_id % 3 = 0")).repartition(2)
    a = sorted(map(tuple, toxicity.sample_of(docs, labels).collect()))
    b = sorted(map(tuple, toxicity.sample_of(doubled, flipped.unionByName(flipped)).collect()))
    assert a == b and len(a) > 600
    few = toxicity.sample_of(docs, labels, most=10, longest=2000).collect()
    assert len(few) == 20 and all(len(r.text.encode()) <= 2000 for r in few)


def test_very_long_text_is_read_in_pieces(spark, labelled, monkeypatch):
    weight = np.zeros(1 << 18, np.float32)
    doc, bucket = toxicity.subwords(*arrays(["moron"]), bits=18)
    weight[bucket] = 100
    rows = spark.createDataFrame([(1, "na " * 900 + "moron " + "na " * 900), (2, "na " * 1800)], "doc_id long, text string")
    monkeypatch.setattr(toxicity, "PIECE", 1000)
    monkeypatch.setattr(toxicity, "OVERLAP", 300)
    got = {r.doc_id: r.score for r in toxicity.score(rows, weight, -5.0).collect()}
    assert got[1] > 0.99 and got[2] < 0.01


def test_no_rows_no_labels(spark, labelled):
    docs, labels = labelled
    assert toxicity.score_documents(docs.limit(0), labels.limit(0)).count() == 0
    got = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert len(got) == 900 and all(r.predicted == 0 for r in got)
