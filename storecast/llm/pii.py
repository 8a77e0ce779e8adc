"""Personal data: high-recall candidates, a boosted-tree judge, calibrated thresholds."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import staged

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The run of digits before the first dot is taken whole: a later start within it
# would fail or match alike, and a long run stays linear.
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start: leftmost matches that never overlap
    within a kind and pass the kind's test. Linear in the text."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        run = text[end:at]
        start = end + len(run.rstrip(_LOCAL))
        found = _domain.match(text, at + 1) if start < at else None
        if found:
            out.append((EMAIL, start, found.end()))
            end = found.end()
        else:
            end = at + 1
        at = text.find("@", end)
    if not _digit.search(text):
        return out
    for m in _ip.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((IP, m.start(), m.end()))
    for m in _card.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((CARD, m.start(), m.end()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append((PHONE, m.start(), m.end()))
    return out


_mail_like = re.compile(
    r"[\w.+-]{1,64}(?:\s?(?:@|\(at\)|\[at\])\s?|\sat\s)[\w-]{1,63}(?:(?:\s?(?:\.|\(dot\)|\[dot\])\s?|\sdot\s)[\w-]{1,63}){1,6}", re.I)
_mail_hint = re.compile(r"@|\(at\)|\[at\]|\sdot\s", re.I)
_number_like = re.compile(r"[+(]?[0-9](?:[0-9]|[\x20().,:_/-]{1,2}(?=[0-9(])|\((?=[0-9]))*+")
_groups = re.compile(r"[0-9]+")
_hints = tuple(re.compile(p, re.I) for p in (r"mail|contact|write", r"\bip\b|host|server|addr", r"card|visa|pay|credit|konto|tarjeta", r"tel|phone|call|mobil|fax|numéro"))


def _number_windows(text: str, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """Proposals of up to six consecutive groups of digits in a run, as it may hold
    several numbers, or a date or count beside one: four groups of at most three
    digits with more than blanks between them (ip), 13 to 19 digits (card), 7 to 15
    digits (phone). So a start has at most eleven."""
    held: deque[tuple[int, int, int]] = deque()  # (start of the proposal, start and end of the group)

    def of_first() -> Iterator[tuple[int, int, int]]:
        n, short, start = 0, True, held[0][0]
        for j, (_, a, end) in enumerate(held):
            n, short = n + end - a, short and end - a <= 3 and (j == 0 or not text[held[j - 1][2]:a].isspace())
            if n > 19:
                break
            if j == 3 and short:
                yield IP, start, end
            if 13 <= n:
                yield CARD, start, end
            if 7 <= n <= 15:
                yield PHONE, start, end
        held.popleft()

    for m in _groups.finditer(text, low, high):
        a, end = m.span()
        held.append((low if not held and a - low <= 1 else a - (a > low and text[a - 1] == "("), a, end))
        if len(held) == 6:
            yield from of_first()
    while held:
        yield from of_first()


def candidate_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Overlapping proposals of all kinds, far wider than the base forms."""
    if _mail_hint.search(text):
        for m in _mail_like.finditer(text):
            yield EMAIL, m.start(), m.end()
    if _digit.search(text):
        for m in _number_like.finditer(text):
            yield from _number_windows(text, m.start(), m.end())


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span, and the characters and words around it."""
    span, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 2]
    groups = _groups.findall(span)
    lengths = [len(g) for g in groups] or [0]
    whole = "".join(groups)
    prev, nxt = before[-1:], after[:1]
    return [
        *[float(kind == k) for k in range(4)], float(len(span)), float(len(whole)), float(len(groups)), float(max(lengths)), float(min(lengths)),
        float(lengths[0]), float(lengths[-1]), float(len(set(whole))), *[float(span.count(c)) for c in ".- (@"], float(sum(c.isalpha() for c in span)),
        float(span[:1] == "+"), float(13 <= len(whole) <= 19 and luhn(whole)), float(max(map(int, groups)) if 0 < max(lengths) <= 3 else 999),
        float(prev.isalnum()), float(nxt.isalnum()), float(prev.isspace() or not prev), float(nxt.isspace() or not nxt),
        float(prev in "=/_:\"'#") if prev else 0.0, float(bool(prev) and prev in "+-.("), float(nxt in "-./:" and after[1:].isdigit()) if nxt else 0.0,
        *[float(bool(h.search(before))) for h in _hints]]


#: What is known of a proposal: it is a base span of its kind; it touches base spans, but
#: is none; or it touches none, and nobody has said what it is.
YES, NO, OPEN = 1, 0, -1
_SPAN = "struct<kind:int,start:int,end:int>"
BATCH = 4096
STEPS = 1 << 14


def _labelled(text: str, sure: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(kind, start, end, label) of all proposals. A proposal is a base span where the two
    share nine tenths of what they cover together."""
    sure = sorted(sure, key=lambda s: s[1])
    starts = [s[1] for s in sure]
    reach = list(accumulate((s[2] for s in sure), max))
    for kind, a, b in candidate_spans(text):
        near = [s for s in sure[bisect_right(reach, a):bisect_left(starts, b)] if a < s[2]]
        same = any(k == kind and 10 * (min(b, e) - max(a, s)) >= 9 * (max(b, e) - min(a, s)) for k, s, e in near)
        yield kind, a, b, YES if same else NO if near else OPEN


def find(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Two sorts of rows. For each document the key column, its number `rid` and its `base`
    spans; for each proposal `rid`, kind, start, end, label, features `x`, and a
    fingerprint `h` of the text, with null `base`. Proposals leave a task some
    thousands at a time, so a text may hold any number of them."""
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    kind = dict(docs.dtypes)[key]

    def run(batches):
        from pyspark import TaskContext
        rid = TaskContext.get().partitionId() << 33

        def rows(keys, n, numbers, base=None, held=()):
            kinds, a, b, label, x, h = zip(*held, strict=True) if held else [[None] * n] * 6
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(numbers, pa.int64()), base if held == () else pa.nulls(n, span), *[pa.array(c, pa.int32()) for c in (kinds, a, b, label)],
                 pa.array(x, pa.list_(pa.float32())), pa.array(h, pa.int64())], names=[key, "rid", "base", "kind", "start", "end", "label", "x", "h"])

        for batch in batches:
            first, base, held, owner = rid, [], [], []
            for text, h in zip(batch.column(1), batch.column(2), strict=True):
                text, h = text.as_py() or "", h.as_py()
                sure = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in sure])
                for c in _labelled(text, sure):
                    held.append((*c, features(text, *c[:3]), h))
                    owner.append(rid)
                    if len(held) == BATCH:
                        yield rows(pa.nulls(BATCH, batch.column(0).type), BATCH, owner, held=held)
                        held, owner = [], []
                rid += 1
            if held:
                yield rows(pa.nulls(len(held), batch.column(0).type), len(held), owner, held=held)
            yield rows(batch.column(0), len(batch), range(first, rid), base=pa.array(base, span))

    return docs.select(key, "text", F.xxhash64("text").alias("h")).mapInArrow(
        run, f"{key} {kind}, rid long, base array<{_SPAN}>, kind int, start int, end int, label int, x array<float>, h long")


@dataclass(frozen=True)
class Judge:
    """A fitted model, the borders that its features ask for, and, for each kind, the
    probability from which a span is taken; above 1 where none is."""
    model: object
    borders: tuple[tuple[int, float], ...]
    thresholds: tuple[float, ...]


def lower_bound(hits: np.ndarray, n: np.ndarray, z: float = 1.64) -> np.ndarray:
    """Wilson's lower confidence bound of a share of hits in n."""
    p = hits / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def threshold(p: np.ndarray, calibrated: np.ndarray, label: np.ndarray, precision: float, count: np.ndarray | int = 1) -> float:
    """The probability from which proposals of a kind are taken, 2 if none. An entry
    stands for `count` proposals.

    `calibrated` is the chance that a proposal bears a base span. Open ones bear none
    even if they are real, so that chance over its mean among the base spans is the
    chance that an open one is real. Taken are all from the highest p down to the
    lowest one where that chance is at least a half and the share of real ones among
    those taken, open ones counted by their chance, is at least `precision` by its
    lower confidence bound. The limit lies midway to the next lower p."""
    if not (label == YES).any():
        return 2.0
    count = np.broadcast_to(count, len(p))
    real = np.minimum(1.0, calibrated / max(np.average(calibrated[label == YES], weights=count[label == YES]), 1e-9))
    order = np.argsort(-p, kind="stable")
    p, real, label, count = p[order], real[order], label[order], count[order]
    hits, n = np.cumsum(count * np.where(label == OPEN, real, label == YES)), np.cumsum(count)
    last = np.append(p[1:] < p[:-1], True)  # equal ones are taken together
    good = np.flatnonzero(last & (real >= 0.5) & (lower_bound(hits, n) >= precision))
    if not len(good):
        return 2.0
    at = good[-1]
    return float((p[at] + (p[at + 1] if at + 1 < len(p) else 0.0)) / 2)


def cuts(values: list[float], counts: list[int], bins: int) -> list[float]:
    """Borders between at most `bins` runs of the values, which rise. Each run takes an equal
    part of the rows that are left for it and the later ones, so a common value costs no border."""
    out, held, left = [], 0, sum(counts)
    for low, high, n in zip(values, values[1:], counts):
        held += n
        if len(values) <= bins or (len(out) < bins - 1 and held * (bins - len(out)) >= left):
            out.append((low + high) / 2)
            held, left = 0, left - held
    return out


def column_borders(proposals: DataFrame, bins: int = 32) -> tuple[tuple[int, float], ...]:
    """(column of `x`, border), from how many of all proposals hold each value. The columns are
    counts within a span of bounded length, and flags: under a thousand values each."""
    counts = proposals.select(F.posexplode("x").alias("column", "value")).groupBy("column", "value").count().collect()
    held: dict[int, list[tuple[float, int]]] = {}
    for column, value, n in sorted(tuple(r) for r in counts):
        held.setdefault(column, []).append((value, n))
    return tuple((column, cut) for column, of in held.items() for cut in cuts([v for v, _ in of], [n for _, n in of], bins)) or ((0, 0.0),)


def beyond(borders: tuple[tuple[int, float], ...]) -> Column:
    """Features for the trees: whether `x` lies beyond each border. They are marked as two-valued,
    as Spark's trees would choose the borders of numbers from some of the rows."""
    each = F.array(*[F.struct(F.lit(column + 1).alias("column"), F.lit(cut).alias("cut")) for column, cut in borders])
    marks = {"ml_attr": {"attrs": {"binary": [{"idx": i} for i in range(len(borders))]}, "num_attrs": len(borders)}}
    return array_to_vector(F.transform(each, lambda b: (F.element_at("x", b["column"]) > b["cut"]).cast("double"))).alias("features", metadata=marks)


def _likely(probability: str) -> Column:
    """The judge's probability of a base span, in steps of 1 / STEPS: thresholds then come
    from counts of all proposals by step, a table of bounded size."""
    return F.floor(vector_to_array(probability)[1] * STEPS) / STEPS


def fit_judge(proposals: DataFrame, rows: int = 20_000, precision: float = 0.95, folds: int = 3) -> Judge | None:
    """Boosted trees over all proposals (h, kind, start, end, label, x), equal ones of equal
    texts counted once; about `rows` of them make a partition, the same ones however
    the table is partitioned. The trees split at `column_borders`, which count all of them.
    Each fold of texts is judged by trees grown on the others;
    isotonic regression of all these probabilities calibrates each kind, and
    `threshold` sets its limit. The trees that judge in the end are grown on all
    folds. None where a class is missing."""
    own = ["h", "kind", "start", "end"]
    whole = proposals.groupBy(*own).agg(F.min("label").alias("label"), F.min("x").alias("x"))
    whole = whole.repartition(max(4, -(-proposals.count() // rows)), *own).sortWithinPartitions(*own)
    whole = staged(whole.select("kind", F.col("label").alias("known"), (F.col("label") == YES).cast("double").alias("label"),
                                "x", F.pmod(F.xxhash64("h"), F.lit(folds)).alias("part")), "pii-proposals")
    seen = {(r["part"], r["label"]) for r in whole.groupBy("part", "label").count().collect()}
    if any({y for part, y in seen if part != k} != {0.0, 1.0} for k in range(folds)):
        return None
    borders = column_borders(whole)
    whole = whole.select("kind", "known", "label", "part", beyond(borders))
    trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7)
    judged = [trees.fit(whole.where(F.col("part") != k)).transform(whole.where(F.col("part") == k)) for k in range(folds)]
    judged = staged(reduce(DataFrame.unionAll, judged).groupBy("kind", "known", "label", _likely("probability").alias("p"))
                    .agg(F.count(F.lit(1)).cast("double").alias("n")), "pii-judged")
    thresholds = []
    for k in range(len(KINDS)):
        of_kind = judged.where(F.col("kind") == k)
        table = of_kind.orderBy("p", "known").toPandas()  # three rows a step at most
        if not len(table):
            thresholds.append(2.0)
            continue
        curve = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="n").fit(of_kind)
        calibrated = np.interp(table["p"], curve.boundaries.toArray(), curve.predictions.toArray())
        thresholds.append(threshold(table["p"].to_numpy(), calibrated, table["known"].to_numpy(), precision, table["n"].to_numpy()))
    return Judge(trees.fit(whole), borders, tuple(thresholds))


def detect(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The key column and two arrays of (kind, start, end) by kind, then start: `base`, and
    `spans`, which adds the proposals that the judge takes and that touch no base
    span; of those that overlap within a kind, the first stays, and of those that
    start together the likeliest.

    Null text: as empty. Null doc_id: kept. Repeated rows: a result each; the judge
    learns from equal texts once. Very long texts: whole, in time linear in the text;
    proposals leave the task in batches. Empty table: no rows. Other columns are not
    read. Offsets are code points.
    """
    table = staged(find(docs, key), "pii-spans")
    found = table.where("base is not null").select("rid", key, "base")
    proposals = table.where("base is null").select("rid", "h", "kind", "start", "end", "label", "x")
    judge = fit_judge(proposals, **options)
    if judge is None:
        return found.select(key, "base", F.col("base").alias("spans"))
    bar = F.element_at(F.array(*[F.lit(t) for t in judge.thresholds]), F.col("kind") + 1)
    open_kinds = [k for k, t in enumerate(judge.thresholds) if t <= 1]
    asked = proposals.where((F.col("label") == OPEN) & F.col("kind").isin(open_kinds)).select("*", beyond(judge.borders))
    taken = (judge.model.transform(asked).withColumn("p", vector_to_array("probability")[1]).where(_likely("probability") >= bar)
             .groupBy("rid").agg(F.collect_list(F.struct("kind", "start", F.round(-F.col("p"), 6).alias("p"), (-F.col("end")).alias("end"))).alias("more")))
    none = F.array().cast(f"array<{_SPAN}>")

    def first_only(acc, s):
        last = F.element_at(acc, -1)
        span = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (-s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (last["kind"] == s["kind"]) & (s["start"] < last["end"]), acc).otherwise(F.concat(acc, F.array(span)))

    more = F.aggregate(F.array_sort("more"), none, first_only)
    return found.join(taken, "rid", "left").select(
        key, "base", F.array_sort(F.concat("base", F.coalesce(more, none))).alias("spans"))


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and digest, and all spans as text."""
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return detect(docs).select("doc_id", *[count(k) for k in range(4)],
                               F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with each span of `text` replaced by its kind in
    brackets; of overlapping spans the union is replaced once, named by the first.
    `n_chars`, where there is one, follows the new text. Null texts stay null."""
    columns = docs.columns
    whole = docs.select(F.struct(*columns).alias("__row"), "text")
    spans = detect(whole, "__row")
    text = F.col("__row.text")

    def join_up(acc, s):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]), grown).otherwise(F.concat(acc, F.array(s)))

    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    apart = F.aggregate(by_start, F.array().cast("array<struct<start:int,end:int,kind:int>>"), join_up)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def put(acc, s):
        return F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                                       F.element_at(names, s["kind"] + 1)).alias("out"))

    clean = F.aggregate(apart, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    done = spans.select("__row.*", F.when(F.size("spans") > 0, clean).otherwise(text).alias("__clean"), F.size("spans").alias("__n"))
    out = {"text": F.col("__clean")}
    if "n_chars" in columns:
        out["n_chars"] = F.when(F.col("__n") > 0, F.length("__clean")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"])
    return done.select(*[out.get(c, F.col(c)).alias(c) for c in columns])
