"""Secret scans through a trigram inverted index, in DataFrame operations only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import staged

try:  # the regex parser of the standard library, under its name by version
    from re import _constants as codes, _parser as parser
except ImportError:  # pragma: no cover
    import sre_constants as codes
    import sre_parse as parser


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts where `group` has at least `least` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three kinds that a caller counts on.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Public token formats that add spans to the base kinds.
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private", r"-----BEGIN [A-Z]*\x20?PRIVATE KEY-----"),
)

_MOST_TEXTS = 64


def _texts(items) -> tuple[set[str] | None, list[set[str]]]:
    """What a parsed pattern matches: the exact small set of texts if there is
    one, else None; and sets of texts of which one each must occur."""
    exact: set[str] | None = {""}
    whole = True
    must: list[set[str]] = []

    def end_run() -> None:
        nonlocal exact
        if exact and "" not in exact:
            must.append(exact)
        exact = {""}

    for op, arg in items:
        part: set[str] | None = None
        inner: list[set[str]] = []
        if op is codes.LITERAL:
            part = {chr(arg).lower()}
        elif op is codes.IN and all(o is codes.LITERAL for o, _ in arg):
            part = {chr(a).lower() for _, a in arg}
        elif op is codes.SUBPATTERN:
            part, inner = _texts(arg[3])
        elif op is codes.BRANCH:
            sides = [_texts(side) for side in arg[1]]
            part = set().union(*[s for s, _ in sides]) if all(s is not None for s, _ in sides) else None
            if part is None and all(m for _, m in sides):
                inner = [set().union(*[m[0] for _, m in sides])]
        elif op in (codes.MAX_REPEAT, codes.MIN_REPEAT):
            low, high, body = arg
            one, inside = _texts(body)
            if (low, high) == (0, 1) and one is not None:
                part = one | {""}
            elif low >= 1:
                inner = inside + ([one] if one and "" not in one else [])
        elif op is codes.AT:
            part = {""}
        if part is not None and exact is not None and len(part) * len(exact) <= _MOST_TEXTS:
            exact = {a + b for a, b in product(exact, part)}
        else:
            whole = False
            end_run()
            must += inner
            if part:
                exact = part
                end_run()
    if whole:
        return exact, must
    end_run()
    return None, must


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """The Boolean trigram query of a regex: an AND of ORs of ANDs of trigrams in
    small letters. Empty: no trigram is mandatory, the rule scans fully."""
    exact, must = _texts(parser.parse(pattern))
    query = []
    for texts in must + ([exact] if exact else []):
        clauses = {frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in texts}
        if frozenset() not in clauses:  # a text under three characters asks for nothing
            query.append(sorted(clauses, key=sorted))
    return query


def trigram_index(docs: DataFrame, grams: list[str], key: str = "k", text: str = "low") -> DataFrame:
    """Postings (gram, key) of the given trigrams: the index's rows that some rule can ask for."""
    here = F.array_compact(F.array(*[F.when(F.contains(F.col(text), F.lit(g)), F.lit(g)) for g in grams]))
    return docs.select(key, F.explode(here).alias("gram")).select("gram", key)


def candidates(index: DataFrame, rules: tuple[Rule, ...], key: str = "k") -> DataFrame:
    """(key, rules): for each document the rules whose trigram query its postings
    meet. A clause holds where the postings of all of its trigrams have the
    document, a part where one clause does, a query where all parts do."""
    spark = index.sparkSession
    wanted, parts = [], []
    for r, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query:
            parts.append((r, len(query)))
        wanted += [(r, p, c, g, len(clause)) for p, ors in enumerate(query) for c, clause in enumerate(ors) for g in sorted(clause)]
    asked = F.broadcast(spark.createDataFrame(wanted, "r int, p int, c int, gram string, need int"))  # as long as the rules
    counts = F.broadcast(spark.createDataFrame(parts, "r int, all_parts int"))
    met = (index.join(asked, "gram").groupBy(key, "r", "p", "c").agg(F.count_distinct("gram").alias("have"), F.first("need").alias("need"))
           .where("have = need"))
    whole = met.groupBy(key, "r").agg(F.count_distinct("p").alias("parts")).join(counts, "r").where("parts = all_parts")
    return whole.groupBy(key).agg(F.collect_set("r").alias("rules"))


def _spans(text: Column, rule: Rule) -> Column:
    """[(start, end)] of a rule's matches in code points: the lengths of what lies
    between matches and of the matches, added up."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= rule.least, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    zipped = F.filter(F.arrays_zip(between.alias("gap"), found.alias("hit"), parts.alias("part")), lambda x: x["hit"].isNotNull())
    walked = F.aggregate(zipped, first, step, lambda acc: acc["spans"])
    # Most texts have no match long enough; only the others are walked.
    return F.when(F.exists(parts, lambda p: F.length(p) >= rule.least), walked).otherwise(none)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """doc_id and `found`, an array of (kind, start, end) by start, then rule order.

    The index is restricted to the trigrams that the rules' queries hold; its
    postings are intersected by counting, and only candidates of a rule run its
    regex. Rules without mandatory trigrams run over every text.

    Null text: as empty. Null doc_id: kept. Repeated rows: a result each. Empty
    table: no rows. Matches are leftmost and never overlap within a kind; a
    match that is too short is dropped and not tried again from within. Other
    columns are not read.
    """
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = whole.withColumn("k", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"))
    grams = sorted({g for r in rules for ors in trigram_query(r.pattern) for clause in ors for g in clause})
    index = trigram_index(whole.select("k", F.lower("text").alias("low")).where("low != ''"), grams)
    hits = staged(candidates(index, rules), "secret-candidates")
    joined = whole.join(hits.hint("shuffle_hash"), "k", "left")

    def of_rule(r: int, rule: Rule) -> Column:
        spans = _spans(F.col("text"), rule)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("rules", F.lit(r)), spans)
        return F.transform(F.coalesce(spans, F.array().cast("array<struct<start:int,end:int>>")), lambda s: F.struct(
            s["start"].alias("start"), F.lit(r).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))

    out = [of_rule(r, rule) for r, rule in enumerate(rules)]
    return joined.select("doc_id", F.transform(F.array_sort(F.concat(*out)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("found"))


def joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base kinds, and all spans."""
    kinds = [r.kind for r in BASE]
    base = F.filter("found", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan_secrets(docs).select(
        "doc_id", *[count(k) for k in kinds],
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"), joined_spans(F.col("found")).alias("spans"))


# re is used by callers that compare with the rules in Python.
compiled = {r.kind: re.compile(r.pattern) for r in BASE + EXTRA}
