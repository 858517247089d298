"""Secret scans over a trigram inverted index.

Each rule is a regular expression. Its Boolean trigram query is derived from the parsed expression: for every part the strings that it can
match, begin with and end with are followed as far as they are few (``FEW``), and where they are not, the trigrams that each of them holds
are an AND, and the strings an OR. Parts that may be absent, and parts of many strings, demand nothing. The query is a
necessary condition; an expression that holds none (or that can't be parsed) scans every text.

The index holds a posting (trigram, document) for every trigram that some query uses; a query intersects and unites postings. Only such candidates are
verified by the regular expression. Trigrams are lower-cased, of texts and of expressions, so the case of either never loses a match.

Postings are sets of a document, so a query is evaluated by one aggregation by document, of the set of its
trigrams; no document's postings are gathered anywhere else. Candidates are joined back by document:
the planner broadcasts them only below its size limit, as they are read from a written table, and shuffles otherwise.

Spans are code points, end exclusive, leftmost and not overlapping within a kind: start of a match is the length of all
pieces between matches and all matches before it. Matches that fail the rule's length are dropped after matching.

Null texts are empty and have no spans. Repeated rows are scanned alike. An empty table gives an empty result. Other columns are ignored.
Only built-in column expressions are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace
from tidemark.llm.native import bind, starts

FEW = 12
ANY: tuple = ("all",)


def _tiles(x: str) -> frozenset[str]:
    """Trigrams that cover a string; with these few, fewer postings are kept than with all."""
    return frozenset(x[i : i + 3] for i in {*range(0, len(x) - 2, 3), len(x) - 3})


def _both(*parts: tuple) -> tuple:
    flat = {y for x in parts for y in (x[1] if x[0] == "and" else [x]) if y != ANY}
    return ANY if not flat else next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def _either(*parts: tuple) -> tuple:
    flat = {y for x in parts for y in (x[1] if x[0] == "or" else [x])}
    return ANY if ANY in flat or not flat else next(iter(flat)) if len(flat) == 1 else ("or", frozenset(flat))


def _holds(strings) -> tuple:
    """The query of texts that hold one of the strings."""
    return _either(*[ANY if len(x) < 3 else _both(*[("has", t) for t in _tiles(x)]) for x in strings])


@dataclass(frozen=True)
class _Part:
    """What a part of an expression can match: all of its strings, if they are few; what they begin and end with; its query."""

    exact: frozenset[str] | None
    head: frozenset[str]
    tail: frozenset[str]
    query: tuple = ANY

    @staticmethod
    def of(strings) -> _Part:
        strings = frozenset(strings)
        return _Part(strings, strings, strings) if 0 < len(strings) <= FEW else UNKNOWN

    def open(self) -> _Part:
        """The same without its exact strings, and with short ends."""
        query = self.query if self.exact is None else _both(self.query, _holds(self.exact))
        short = lambda xs, cut: frozenset(map(cut, xs)) if len(xs) <= FEW else frozenset([""])
        return _Part(None, short(self.head, lambda x: x[:2]), short(self.tail, lambda x: x[-2:] if x else ""), query)


UNKNOWN = _Part(None, frozenset([""]), frozenset([""]))
NOTHING = _Part(frozenset([""]), frozenset([""]), frozenset([""]))


def _cross(a, b) -> frozenset[str]:
    return frozenset(x + y for x, y in product(a, b)) if len(a) * len(b) <= FEW else frozenset()


def _then(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and (all_ := _cross(a.exact, b.exact)):
        return _Part(all_, all_, all_)
    meet = _cross(a.tail, b.head)
    query = _both(a.open().query, b.open().query, _holds(meet) if meet else ANY)
    head = (_cross(a.exact, b.head) if a.exact is not None else frozenset()) or a.head
    tail = (_cross(a.tail, b.exact) if b.exact is not None else frozenset()) or b.tail
    if a.exact is not None and a.exact == NOTHING.exact:
        head = b.head
    return _Part(None, head, tail, query) if max(len(head), len(tail)) <= FEW else _Part(None, head, tail, query).open()


def _or(parts: list[_Part]) -> _Part:
    if all(x.exact is not None for x in parts) and len(all_ := frozenset().union(*[x.exact for x in parts])) <= FEW:
        return _Part.of(all_)
    parts = [x.open() for x in parts]
    return _Part(None, frozenset().union(*[x.head for x in parts]), frozenset().union(*[x.tail for x in parts]), _either(*[x.query for x in parts])).open()


def _chars(items) -> _Part:
    out: set[str] = set()
    for op, x in items:
        lo, hi = (x, x) if str(op) == "LITERAL" else x if str(op) == "RANGE" else (0, 1 << 20)
        if hi > 127 or hi - lo > 60:
            return UNKNOWN
        out |= {chr(c).lower() for c in range(lo, hi + 1)}
    return _Part.of(out)


def _part(tree) -> _Part:
    out = NOTHING
    for op, x in tree:
        op = str(op)
        if op == "LITERAL":
            one = _Part.of([chr(x).lower()]) if x < 128 else UNKNOWN
        elif op == "IN":
            one = _chars(x)
        elif op == "SUBPATTERN":
            one = UNKNOWN if x[1] or x[2] else _part(x[3])
        elif op == "ATOMIC_GROUP":
            one = _part(x)
        elif op == "BRANCH":
            one = _or([_part(y) for y in x[1]])
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = int(x[0]), int(x[1]), _part(x[2])
            one = NOTHING
            for _ in range(min(least, 4)):
                one = _then(one, inner)
            if (least, most) == (0, 1):
                one = _or([inner, NOTHING])
            elif most > min(least, 4):
                one = _then(one, UNKNOWN)
        elif op in ("AT", "ASSERT", "ASSERT_NOT"):
            one = NOTHING
        else:
            one = UNKNOWN
        out = _then(out, one)
    return out


def trigram_query(regex: str) -> tuple:
    """The Boolean query that every match's text fulfils: ("all",), ("has", trigram), ("and", queries) or ("or", queries)."""
    from re import _parser

    try:
        tree = _parser.parse(regex)
    except (re.error, OverflowError, RecursionError):
        return ANY
    if tree.state.flags & re.VERBOSE:
        return ANY
    return _part(tree).open().query


def trigrams_of(query: tuple) -> set[str]:
    if query[0] == "has":
        return {query[1]}
    return set() if query == ANY else set().union(*map(trigrams_of, query[1]))


def fulfils(query: tuple, held: Column) -> Column:
    """The query over the set of a document's trigrams."""
    if query[0] == "has":
        return F.array_contains(held, query[1])
    parts = [fulfils(x, held) for x in sorted(query[1], key=repr)]
    out = parts[0]
    for x in parts[1:]:
        out = out & x if query[0] == "and" else out | x
    return out


def any_case(x: str) -> str:
    """The expression with every letter in either case, ASCII only."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in x)


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0  #: the group whose length counts
    least: int = 0
    base: bool = False

    @property
    def query(self) -> tuple:
        return trigram_query(self.regex)


WORDS = "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))
RULES = (
    Rule("assign", f"({WORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", "[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("ghp", "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+"),
)
# hex: a run of 24 or more is the same leftmost match as a whole run that is then held to 24, and shorter runs drop out.


def find(text: Column, rule: Rule) -> Column:
    """array<struct<start, kind_rank, kind, stop>> of a rule's matches; the texts' lengths are code points."""
    matches = F.regexp_extract_all(text, F.lit(f"({rule.regex})"), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(f"({rule.regex})"), F.lit(rule.group + 1 if rule.group else 0))
    gaps = F.split(text, rule.regex)
    kind, rank = F.lit(rule.kind), F.lit([r.kind for r in RULES].index(rule.kind))

    def spans(pairs: Column) -> Column:
        ends = starts(pairs, lambda x: F.length(x["gap"]) + F.length(x["m"]))
        begin = lambda x, at: (at + F.length(x["gap"])).cast("int")
        each = F.zip_with(pairs, ends, lambda x, at: F.struct(begin(x, at).alias("start"), rank.alias("kind_rank"), kind.alias("kind"), (begin(x, at) + F.length(x["m"])).alias("stop"), F.length(x["g"]).alias("g")))
        long = F.filter(each, lambda s: s["g"] >= rule.least)
        return F.transform(long, lambda s: F.struct(s["start"], s["kind_rank"], s["kind"], s["stop"]))

    found = bind(matches, lambda m: F.arrays_zip(m.alias("m"), sized.alias("g"), F.slice(gaps, 1, F.size(m)).alias("gap")))
    return bind(found, spans).cast(SPANS)


SPANS = "array<struct<start:int,kind_rank:int,kind:string,stop:int>>"


def postings(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, row): the inverted index of the trigrams that the rules' queries use."""
    wanted = sorted(set().union(*[trigrams_of(r.query) for r in rules]))
    low = F.lower("text")
    held = F.filter(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in wanted]).cast("array<string>"), lambda x: x.isNotNull())
    return rows.select("row", low.alias("low")).select("row", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kinds): for every row, the rules whose trigram query its postings satisfy."""
    got = index.groupBy("row").agg(F.collect_set("trigram").alias("held"))
    kinds = F.array(*[F.when(fulfils(r.query, F.col("held")), F.lit(r.kind)) for r in rules]).cast("array<string>")
    return got.select("row", F.filter(kinds, lambda x: x.isNotNull()).alias("kinds")).where(F.size("kinds") > 0)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text); spans array<struct<start, kind_rank, kind, stop>>, sorted."""
    ws = Workspace(docs.sparkSession, "secrets")
    indexed = tuple(r for r in rules if r.query != ANY)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("row", F.struct("doc_id", F.xxhash64("text").alias("h")))
    cand = ws.put(candidates(postings(rows, indexed).distinct(), indexed), "candidates")
    empty = F.array().cast(SPANS)
    joined = rows.join(cand, "row", "left")
    found = []
    for r in rules:
        if r in indexed:
            due = F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), r.kind)
            found.append(F.when(due, find(F.col("text"), r)).otherwise(empty))
        else:
            found.append(F.when(F.col("text").rlike(r.regex), find(F.col("text"), r)).otherwise(empty))
    out = ws.put(joined.select("doc_id", F.array_sort(F.concat(*found)).alias("spans")), "result")
    ws.keep("result")
    return out


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``spans``."""
    said = lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])
    base = [r.kind for r in RULES if r.base]
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    own = F.array_join(F.transform(F.filter("spans", lambda x: x["kind"].isin(base)), said), ",")
    return found.select("doc_id", *[count(k) for k in base], F.sha2(own, 256).alias("base_sha256"), F.array_join(F.transform("spans", said), ",").alias("spans"))


def oracle() -> str:
    """The query in DuckDB's SQL."""
    parts = []
    for i, r in enumerate(RULES):
        rx = r.regex.replace("'", "''")
        parts.append(f"""
SELECT rid, {i} AS rank, '{r.kind}' AS kind, start, start + length(m) AS stop FROM (
  SELECT rid, m, g, (list_sum(list_transform(gaps[:n], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[:n - 1], lambda x: length(x))), 0))::BIGINT AS start
  FROM (SELECT rid, ms, gaps, n, ms[n] AS m, gs[n] AS g FROM (SELECT rid, regexp_extract_all(t, '({rx})', 0) AS ms, regexp_extract_all(t, '({rx})', {r.group + 1 if r.group else 0}) AS gs,
    string_split_regex(t, '{rx}') AS gaps FROM d WHERE regexp_matches(t, '{rx}')), LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS n))
  WHERE length(g) >= {r.least})""")
    base = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)}),
a AS (SELECT rid, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS own,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM s GROUP BY rid)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)"""
