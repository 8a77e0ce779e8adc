"""Each operator against a plain version on awkward rows, and on an empty table."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array

from storecast.llm import bitslices, decontaminate, jaccard, language, lm, packing, pii, queries, secrets, shards, suffixes

from .conftest import prose


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def keyed(rows):
    return sorted(rows, key=repr)


# 1 personal data

def plain_pii(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 16, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m.group())
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_on_random_texts():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice("a1b2.@+-_% ()09:4x5;é") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == plain_pii(text)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 100_000):
        pii.base_spans(text)
        list(pii.candidate_spans(text))


def test_pii_digest(docs, corpus, empty):
    got = keyed((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.pii_digest(docs).collect())
    want = []
    for i, t in corpus:
        spans = plain_pii(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        want.append((i, *[sum(s[0] == k for s in spans) for k in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    assert got == keyed(want)
    assert pii.pii_digest(empty).count() == 0


def test_redaction_keeps_columns(docs):
    got = pii.redact(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    row = [r for r in got.collect() if r.text and "call" in r.text][0]
    assert row.text == "mail [EMAIL], ip [IP] and 300.1.1.1, card [CARD], call [PHONE]" and row.n_chars == len(row.text)


def test_judge_adds_likely_spans(spark):
    """The base form takes the address behind a phone into one run of too many digits, and
    drops it; the judge knows such a phone by its format. Other numbers stay."""
    rng = random.Random(2)
    def phone():
        return f"+{rng.randint(1, 9)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    def address():
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    rows = [(i, f"reach {phone()} now or {address()}") for i in range(400)] + [(1000 + i, f"item {rng.randint(10**7, 10**9)} sold") for i in range(400)]
    hidden = {5000 + i: (phone(), address()) for i in range(20)}
    rows += [(i, f"reach {a} {b} now") for i, (a, b) in hidden.items()]
    got = {r.doc_id: r for r in pii.pii_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_phone == 1 and got[1000 + i].spans == "" for i in range(400))
    for i, (a, b) in hidden.items():
        assert got[i].n_phone == 0 and got[i].n_ip == 1
        assert got[i].spans == f"ip:{7 + len(a)}:{7 + len(a) + len(b)},phone:6:{6 + len(a)}"


def test_thresholds_equal_a_plain_search():
    """Every p as a limit, counted anew."""
    rng = np.random.default_rng(4)
    for n in (1, 5, 60, 400):
        for clear in (False, True):
            label = rng.choice([pii.YES, pii.NO, pii.OPEN], n, p=[0.6, 0.2, 0.2])
            p = np.round(np.clip((label == pii.YES) * (0.8 if clear else 0.5) + rng.random(n) * (0.15 if clear else 0.5), 0, 1), 2)
            calibrated = p ** 2
            best = 2.0
            if (label == pii.YES).any():
                real = np.minimum(1, calibrated / calibrated[label == pii.YES].mean())
                for limit in sorted(set(p)):
                    taken = p >= limit
                    hits = sum(r if y == pii.OPEN else y == pii.YES for r, y in zip(real[taken], label[taken], strict=True))
                    if real[p == limit][0] >= 0.5 and pii.lower_bound(hits, taken.sum()) >= 0.9:
                        best = (limit + max(p[p < limit], default=0.0)) / 2
                        break
            assert pii.threshold(p, calibrated, label, 0.9) == pytest.approx(best)


def test_copies_do_not_fill_the_sample(spark):
    """A text that is there 500 times is learned from once; the others all are."""
    rng = random.Random(8)
    texts = [f"reach +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} or 10.{i % 250}.{rng.randint(1, 250)}.7 for {rng.randint(10**7, 10**8)}" for i in range(200)]
    few = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    many = spark.createDataFrame(list(enumerate(texts + texts[:1] * 500)), "doc_id long, text string")
    one, two = (pii.fit_judge(pii.find(t).where("base is null")) for t in (few, many))
    assert one.thresholds == two.thresholds and one.thresholds[pii.IP] <= 1


def test_a_long_text_of_numbers_leaves_in_batches(spark):
    """A megabyte of numbers in one text: at most eleven proposals a start, none held as a
    whole; one-digit numbers give none."""
    assert list(pii.candidate_spans("1 " * 500_000)) == []
    text = "12 3456 789 " * 85_000
    found = pii.find(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string"))
    rows = found.selectExpr("base is not null as whole", "start").groupBy("whole").agg({"*": "count", "start": "max"}).collect()
    got = {r["whole"]: (r["count(1)"], r["max(start)"]) for r in rows}
    assert got[True][0] == 3 and 255_000 < got[False][0] <= 255_000 * 11 and got[False][1] > 1_000_000


def test_numbers_within_a_run_are_proposed():
    for text, kind, spans in (("call 555-123-4567, 555-987-6543, 555-222-1111", pii.PHONE, ["555-123-4567", "555-987-6543", "555-222-1111"]),
                              ("2023-05-01 020 7946 0958", pii.PHONE, ["020 7946 0958"]), ("on 3 (319) 555-5132", pii.PHONE, ["(319) 555-5132"]),
                              ("10.0.0.1:8080", pii.IP, ["10.0.0.1"]), ("12 4111 1111 1111 1111 9999", pii.CARD, ["4111 1111 1111 1111"]),
                              ("+33 6 12 34 56 78 9", pii.PHONE, ["+33 6 12 34 56 78"])):
        assert set(spans) <= {text[a:b] for k, a, b in pii.candidate_spans(text) if k == kind}


def test_judge_keeps_a_rare_kind_open(spark):
    """One kind of 600 proposals beside another of 60,000."""
    x = "array_repeat(cast({} as double), 24)"
    rare = spark.range(600).selectExpr("id as h", "3 as kind", "0 as start", "9 as end", "int(id % 2) as label", x.format("id % 2") + " as x")
    other = spark.range(60_000).selectExpr("id as h", "2 as kind", "5 as start", "9 as end", "0 as label", x.format("0") + " as x")
    judge = pii.fit_judge(rare.unionByName(other), rows=2_000)
    assert judge.thresholds[3] <= 1 < judge.thresholds[2]


def test_judge_learns_from_all_proposals(spark):
    """A kind with 120 base spans among 60,000 other proposals of it: a third of the base
    spans would be too few for the confidence bound."""
    x = "array_repeat(cast({} as double), 24)"
    table = spark.range(60_120).selectExpr("id as h", "3 as kind", "0 as start", "9 as end", "int(id < 120) as label", x.format("int(id < 120)") + " as x")
    judge = pii.fit_judge(table)
    assert judge.thresholds[pii.PHONE] <= 1


def test_judge_splits_where_all_proposals_say(spark):
    """64,000 proposals of 640 values, right from an exact border on: borders of some of the
    rows lie beside it, and a bin then holds right and wrong ones."""
    table = spark.range(64_000).selectExpr("id as h", "3 as kind", "0 as start", "9 as end", "int(id % 640 >= 480) as label",
                                           "array(cast(id % 640 as float), cast(7 as float)) as x")
    judge = pii.fit_judge(table)
    assert [b for c, b in judge.borders if c == 0] == [20 * k - 0.5 for k in range(1, 32)] and {c for c, _ in judge.borders} == {0}
    features = table.select("label", pii.beyond(judge.borders))
    p = judge.model.transform(features)
    least, most = (p.where(f"label = {y}").select(vector_to_array("probability")[1].alias("p")).selectExpr("min(p)", "max(p)").first() for y in (1, 0))
    assert least[0] > most[1]


def test_cuts():
    """Few values: a border between any two. Many: runs of nearly equal weight; a very common value takes none from the others."""
    assert pii.cuts([0.0, 1.0, 5.0], [9, 1, 1], 32) == [0.5, 3.0]
    assert pii.cuts([4.0], [9], 32) == []
    common = pii.cuts([float(v) for v in range(100)], [10_000] + [1] * 99, 12)
    assert common[0] == 0.5 and len(common) == 11 and set(np.diff(common)) <= {8.0, 9.0, 10.0}


def test_judge_is_free_of_partitioning(spark):
    """It learns from the same rows, and takes the same spans, however the table is dealt."""
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["call +44 20 7946 0958 today", "phone 020 7946 0958 now", "item 1234567890 sold", "mail a@b.co or c at d dot org"])
                      for _ in range(4)) for _ in range(400)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    one, many = (sorted((r["doc_id"], r["spans"]) for r in pii.pii_digest(table.repartition(n)).collect()) for n in (1, 6))
    assert one == many


# 2 language-model scores

def test_lm_scores(docs, corpus, empty):
    got = keyed((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in lm.score_documents(docs).collect())
    def tokens(t):
        return (t or "").encode().lower().split() + [None]
    count = collections.Counter(x for i, t in corpus if fold(i, 7) != 2 for x in tokens(t))
    n, v = sum(count.values()), len(count)
    want = [(i, fold(i, 7) == 2, len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), n,
             round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in tokens(t)), 4)) for i, t in corpus]
    assert got == keyed(want)
    assert lm.score_documents(empty).count() == 0


def test_model_scores_equal_a_plain_model(spark):
    """With a wide filter no probe goes wrong, and the score is that of the quantised counts."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 30))) for _ in range(150)]
    got = {r.doc_id: r.score for r in lm.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bits=64).collect()}
    one, two = collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        if fold(i, 7) != 2:
            line = ["<s>", *t.split(), "</s>"]
            one.update(line)
            two.update(zip(line, line[1:], strict=False))
    n, v = sum(one.values()) - one["<s>"], len(one) - 1
    def about(c):
        return 0 if not c else (2 ** (math.floor(math.log2(c))) + 2 ** (math.floor(math.log2(c)) + 1) - 1) / 2
    for i, t in enumerate(texts):
        line = ["<s>", *t.split(), "</s>"]
        want = sum(math.log10(min(1, (min(about(two[h, w]), about(one[h])) + 60 * (about(one[w]) + 1) / (n + v + 1)) / (about(one[h]) + 60)))
                   for h, w in zip(line, line[1:], strict=False))
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_parts_grow_with_the_text(spark):
    """Twice the documents, twice the blocks: the parts of the base score double and do not quadruple."""
    rng = random.Random(7)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(12)) for _ in range(4000)]
    def entries(rows, blocks):
        table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) fp", "true learn", "text")
        closed = table.coalesce(1).mapInArrow(lm._emit_counts(blocks, 20_000), lm.COUNTS).groupBy("block").applyInPandas(lm._close_block(10, blocks), lm.BLOCK)
        return closed.selectExpr("sum(octet_length(doc) / 4)").first()[0]
    half, whole = entries(texts[:2000], 40), entries(texts, 80)
    assert whole <= 2.2 * half and whole <= 12 * 4000


def test_filter_passes_agree(docs):
    one = keyed((r.doc_id, r.n_tokens, round(r.score, 6)) for r in lm.score_documents(docs).collect())
    many = keyed((r.doc_id, r.n_tokens, round(r.score, 6)) for r in lm.score_documents(docs, broadcast_bytes=8000).collect())
    assert one == many and all(s <= 0 for _, _, s in one)


def test_filter_never_underestimates():
    rng = np.random.default_rng(0)
    key, count = rng.integers(0, 2**63, 3000).astype(np.uint64), rng.integers(1, 500, 3000)
    bits = lm.filter_block(key, count, 10)
    table = lm.Filter(1, np.array([0]), np.zeros(1, np.uint64), np.array([len(bits) * 8], np.uint64), bits.tobytes())
    level = table.level(key)
    assert (level >= lm.levels_of(count)).all() and (level == lm.levels_of(count)).mean() > 0.95
    assert (table.level(rng.integers(0, 2**63, 3000).astype(np.uint64)) > 0).mean() < 0.04


# 3 secrets

def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == []
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert all(set(c) for r in secrets.BASE[:2] for ors in secrets.trigram_query(r.pattern) for c in ors)


def test_secrets(docs, corpus, empty):
    got = keyed((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in secrets.secret_digest(docs).collect())
    want = []
    for i, t in corpus:
        spans = sorted((m.start(), n, m.end(), r.kind) for n, r in enumerate(secrets.BASE + secrets.EXTRA)
                       for m in secrets.compiled[r.kind].finditer(t or "") if len(m.group(r.group)) >= r.least)
        kinds = [s[3] for s in spans]
        want.append((i, *[kinds.count(k) for k in ("assign", "access", "hex")], ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)))
    assert got == keyed(want)
    assert secrets.secret_digest(empty).count() == 0


# 4 top-k

def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(150)]
    rows += [(200, None), (220, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (240, [float("nan")] * 6), (260, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(300 + i, rows[3][1]) for i in range(30)] + [(20, rows[20][1]), (400, [9.0, 9.0]), (401, [-3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in good if i % 20 == 0}:
        near = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v)))[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    got = bitslices.top_k(df, df.where("vec_id % 20 = 0"), rows_per_block=64, queries_per_block=3)
    assert keyed(map(tuple, got.collect())) == keyed(want)
    assert bitslices.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [2, 30])
def test_repeated_query_in_one_block(spark, copies):
    rng = np.random.default_rng(14)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(1, 200)]
    rows += [(0, [9.0] * 6)] * copies + [(500 + i, [9.0] * 6) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    near = sorted((-sum(math.floor(64 * 9.0) * math.floor(64 * float(np.float32(x))) for x in v), i) for i, v in rows if i)[:20]
    got = bitslices.top_k(df, df.where("vec_id = 0")).collect()
    assert sorted(map(tuple, got)) == [(0, n + 1, i, -s) for n, (s, i) in enumerate(near)]


def test_top_k_of_wide_vectors(spark):
    """Components of 2**24 and more after scaling, beside small ones."""
    rng = np.random.default_rng(24)
    rows = [(i, [float(x) for x in rng.normal(size=4) * size]) for i, size in enumerate([1.0] * 60 + [3e5] * 60 + [4e6] * 20)]
    rows += [(200, [2.0**24, 0.0, 0.0, 0.0]), (220, [-(2.0**24), 1.0, 0.0, 0.0]), (240, [2.0**26, 0.0, 0.0, 0.0]), (241, [0.0, 0.0, 2.0**58, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    asked = [r for r in rows if r[0] % 20 == 0] + [(300, [0.0, 1.0, 0.0, 0.0])]
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows[:-1]]
    want = []
    for q, v in [(i, [math.floor(64 * x) for x in v]) for i, v in asked]:
        near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q)[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    got = bitslices.top_k(df, spark.createDataFrame(asked, df.schema), rows_per_block=1024, queries_per_block=3)
    assert keyed(map(tuple, got.collect())) == keyed(want)
    with pytest.raises(OverflowError):
        bitslices.inner(np.full((1, 2), 1 << 40), np.full((1, 2), 1 << 40))
    big = np.array([[-(1 << 62), 1 << 62, 1]])
    assert bitslices.inner(big, np.array([[2, 2, 5]])).tolist() == [5]


# 5 language

def test_language(docs, corpus, empty):
    got = language.identify_documents(docs).collect()
    assert keyed((r.doc_id, r.held_out) for r in got) == keyed((i, fold(i, 5) == 0) for i, _ in corpus)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert {i for i, t in corpus if t in (None, "", "!!! ???")} - {None} <= und
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und") for r in got)
    assert language.identify_documents(empty).count() == 0
    assert language.keep_identified(docs).columns == docs.columns


def test_ranks_of_very_long_texts():
    doc, gram = np.array([0, 0, 0, 0, 1, 1]), np.array([1, 2, 3, 4, 1, 2], np.uint64)
    for count in ([70_000, 200_000, 100_000, 5, 1, 2], [70, 200, 100, 5, 1, 2]):
        own, names, rank = language.ranked(doc, gram, np.array(count), 3)
        assert own.tolist() == [0, 0, 0, 1, 1] and names.tolist() == [2, 3, 1, 2, 1] and rank.tolist() == [0, 1, 2, 0, 1]


def test_language_filter_memory(spark, docs):
    """Rows reach the filter once, their n-grams are counted in small slices, and the rows
    that stay are those of the predictions."""
    kept = language.keep_identified(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "named_struct" not in plan
    profiles = language.learn_profiles(docs.where(language.fold("doc_id", 5) != 0))
    good = {r.doc_id for r in language.identify(docs, profiles).where("lang_pred != 'und' and score >= 0.2").collect()}
    assert good and sorted(kept.collect(), key=repr) == sorted((r for r in docs.collect() if r.doc_id in good and r.text), key=repr)
    texts = pa.array([prose(random.Random(5), 2000)] * 300)
    predict = language._predictor(spark, profiles, 400)
    predict(texts[:1])
    tracemalloc.start()
    predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000


def test_languages_are_told_apart(spark):
    rng = random.Random(0)
    bank = {"aa": "the and ing tion ould whi".split(), "bb": "sch ung ein der keit über".split()}
    rows = [(i, " ".join("".join(rng.choices(bank[x], k=2)) for _ in range(30)), x) for i in range(200) for x in [("aa", "bb")[i % 2]]]
    got = language.identify_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {i: x for i, _, x in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in got)


# 6 Jaccard join

def plain_classes(corpus):
    sets = []
    for _, t in corpus:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    n, links, root = len(sets), [0] * len(sets), list(range(len(sets)))
    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 10 >= 8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    names = collections.defaultdict(list)
    for x in range(n):
        names[top(x)].append(corpus[x][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in names.items()}
    return [(corpus[x][0], least[top(x)], links[x]) for x in range(n)]


@pytest.mark.parametrize("block", [512, 2])
def test_jaccard(docs, corpus, block):
    got = jaccard.similar_groups(docs, block=block).select("doc_id", "class_id", "n_links").collect()
    assert keyed(map(tuple, got)) == keyed(plain_classes(corpus))


def test_keep_one(docs, corpus, empty):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    free = sum(1 for _, t in corpus if not (t or "").split())
    assert kept.count() == len({c for (_, c, _), (_, t) in zip(plain_classes(corpus), corpus, strict=True) if (t or "").split()}) + free
    assert jaccard.keep_one(empty).count() == 0


def test_pruning_bound():
    least = jaccard.least_matches(0.8, 1e-7)
    assert all(0 < m < 0.8 * n for m, n in zip(least, jaccard.STEPS, strict=True)) and least == sorted(least)


# 7 decontamination

def plain_alignment(a, b):
    last, best = [0] * (len(a) + 1), 0
    for y in b:
        row = [0]
        for j, x in enumerate(a):
            row.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, row[j] - 1))
        last, best = row, max(best, *row)
    return best


def test_alignment():
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 5, rng.integers(0, 30)).astype(np.uint64) for _ in range(80)]
    b = [rng.integers(0, 5, rng.integers(1, 20)).astype(np.uint64) for _ in range(80)]
    assert decontaminate.align(a, b).tolist() == [plain_alignment(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)]


def test_decontamination(spark, docs, corpus):
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 400)}" for _ in range(40)]
    edited = [("changed" if i % 9 == 4 else w) for i, w in enumerate(words)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, ""), (4, "two words"), (1, " ".join(words))], "item_id long, text string")
    rows = [(1000, "start " + " ".join(words).upper() + " end"), (1001, " ".join(edited)), (1002, " ".join(words[:6])), (1000, "start " + " ".join(words).upper() + " end")]
    more = docs.unionByName(spark.createDataFrame([(i, t, None, "s", 0, "", 1) for i, t in rows], docs.schema))
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(more, items).collect()}
    assert set(got) == {(1000, 1), (1001, 1)} and got[1000, 1] == 1.0 and got[1001, 1] < 1
    kept = decontaminate.drop_contaminated(more, items)
    assert kept.columns == docs.columns and kept.count() == len(corpus) + 1
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [1, 30])
def test_edited_copies_beside_a_whole_one(spark, copies):
    """A whole copy makes the trigrams that the edited ones lost the rarest of their item."""
    rng = random.Random(11)
    cuts = [set(range(step - 1, 40, step)) for step in (4, 5, 6)]
    cuts += [set(rng.sample(range(40), 40 * share // 100)) for share in (15, 20, 25) for _ in range(5)]
    items, rows, want = [], [], {}
    for e, cut in enumerate(cuts):
        words = [f"e{e}w{i}" for i in range(40)]
        edited = ["changed" if i in cut else w for i, w in enumerate(words)]
        items.append((e, " ".join(words)))
        held = any(not cut & {i, i + 1, i + 2} for i in range(38))
        for text in [words] + [edited] * copies:
            score = plain_alignment(text, words) / 80
            if held and score >= 0.5:
                want[len(rows), e] = score
            rows.append((len(rows), " ".join(text)))
    assert sum(v < 1 for v in want.values()) >= 12 * copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == want and len(got) == len(want)


def test_items_without_or_with_one_id(spark):
    one, two = " ".join(f"u{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    items = spark.createDataFrame([(7, one), (None, two), (7, "x y z v0 v1 v2 v3 v4"), (7, one)], "item_id long, text string")
    docs = spark.createDataFrame([(1, one), (2, two), (3, one + " " + two)], "doc_id long, text string")
    got = [(r.doc_id, r.item_id, r.score) for r in decontaminate.contaminated(docs, items).collect()]
    assert keyed(got) == keyed([(1, 7, 1.0), (2, None, 1.0), (2, 7, 0.625), (3, 7, 1.0), (3, None, 1.0)])


# 8 repeats

def plain_repeats(texts, least=400):
    count = collections.Counter(t[p:p + least] for t in texts for p in range(len(t) - least + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, int)
        for p in range(len(t) - least + 1):
            if count[t[p:p + least]] > 1:
                cover[p] += 1
                cover[p + least] -= 1
        on = np.cumsum(cover)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~on])
        out.append((len(t), int(on.sum()), int((np.diff(np.concatenate(([0], on.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_repeats(spark, corpus, seed):
    rng = random.Random(seed)
    bank = "".join(rng.choice("the on an ré ing") for _ in range(2500))
    rows = list(corpus)
    for i in range(60):
        text = ""
        for _ in range(rng.randint(1, 3)):
            at = rng.randint(0, 2000)
            text += bank[at:at + rng.choice([380, 398, 399, 400, 401, 415, 430, 600])] + rng.choice(["", "X", "Y"])
        if i % 4 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + "Q" + text[at + 1:]
        rows.append((2000 + i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.remove_repeats(df, with_text=True).collect()
    want = [(i, *w) for (i, _), w in zip(rows, plain_repeats([(t or "").encode() for _, t in rows]), strict=True)]
    assert keyed((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == keyed(want)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_repeats_of_nothing(empty):
    assert suffixes.remove_repeats(empty).count() == 0
    assert suffixes.remove_repeats(empty, passage=51).count() == 0


def plain_shared(rows, least):
    texts = {(i, t): re.split("[ \\t-\\r]+", (t or "").strip(" \t\n\x0b\x0c\r")) for i, t in rows}
    homes = collections.defaultdict(set)
    for k, w in texts.items():
        for p in range(len(w) - least + 1):
            homes[tuple(w[p:p + least])].add(k)
    out = {}
    for k, w in texts.items():
        on = np.zeros(len(w), bool)
        for p in range(len(w) - least + 1):
            if len(homes[tuple(w[p:p + least])]) > 1:
                on[p:p + least] = True
        out[k] = int(on.sum())
    return [(i, out[i, t]) for i, t in rows]


@pytest.mark.parametrize("seed", [0, 1])
def test_shared_words(spark, corpus, seed):
    rng = random.Random(seed)
    bank = prose(rng, 400).split()
    rows = list(corpus)
    for i in range(80):
        words = []
        for _ in range(rng.randint(1, 4)):
            at = rng.randint(0, 330)
            words += bank[at:at + rng.choice([20, 50, 51, 52, 60, 70])] + prose(rng, rng.randint(0, 60)).split()
        rows.append((3000 + i, "".join(w + rng.choice(["  ", "\n", "\t ", " "]) for w in words) + rng.choice(["", "\u00a0x"])))
    rows += [(4000 + i, " ".join([w] * n)) for i, (w, n) in enumerate([("na", 300), ("so", 50), ("so", 60), ("la", 51), ("la", 120)])]
    rows += [(4100, prose(rng, 70) + " " + " ".join(bank)), (4100, " ".join(["alone"] * 200)), (4101, " ".join(bank[:60] + bank[:60]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_shared_words) for r in suffixes.remove_repeats(df, passage=51).collect()]
    assert keyed(got) == keyed(plain_shared(rows, 51))


def test_short_passages_show(spark, tmp_path):
    """Passages of over 50 words and under 400 bytes: too short to go, counted in each document that holds them."""
    rng = random.Random(4)
    passage = " ".join(f"w{i}" for i in range(55))
    texts = [prose(rng, 80) + " " + passage + " " + prose(rng, 40), passage + " " + prose(rng, 90), prose(rng, 200), prose(rng, 30) + " here " * 70]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_removed, r.n_shared_words) for r in queries.op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert len(passage) < 400 and got == {0: (0, 55), 1: (0, 55), 2: (0, 0), 3: (420, 0)}


# 9 packing

def test_packing_round_trip(docs, corpus, empty):
    rows = packing.pack_documents(docs, group_tokens=3000).collect()
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        used = sum(r.length for r in own)
        assert own[0].used == used and own[0].capacity == min(c for c in packing.CAPACITIES if c >= used)
    assert sum(r.length for r in rows) == sum(len((t or "").split()) + 1 for _, t in corpus)
    assert sum(r.piece == 0 for r in rows) == len(corpus)
    assert packing.pack_documents(empty).count() == 0


# 10 sharding

def test_sharding(spark, corpus, empty):
    rows = corpus * 3 + [(9000 + i, "a third of all rows has this text") for i in range(150)]
    got = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), grain=8).collect()
    assert keyed((r.doc_id, r.size, r.text_crc32) for r in got) == keyed(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in range(8):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
    assert {r.law for r in got} == {"bytes"} and shards.shard_documents(empty).count() == 0


def test_shards_are_even(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(1, 400)) for i in range(4000)] + [(5000 + i, "hot" * 40) for i in range(2000)]
    got = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = [r[1] for r in got.groupBy("shard").sum("size").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.01 * sum(sizes) / 8
