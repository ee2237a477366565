"""Secret scans over a trigram inverted index, in DataFrame functions only.

1. Each rule's regular expression yields a Boolean trigram query: the
   trigrams, of ASCII letters in lower case, that a match must hold, as an OR
   of ANDs (:func:`trigram_query`).
2. The index holds the posting lists of the trigrams that some query asks
   for. A list is cut into blocks by a hash, so none grows with the input.
3. In every block the posting lists of a clause are intersected and the
   clauses united; the rule's candidates come out.
4. Candidates are verified by the regular expression on the whole text. A
   rule without mandatory trigrams has no query and scans every text.

Documents are posted under a 64-bit hash of id and text; equal hashes only add
candidates. A match is found leftmost and non-overlapping for each rule, and
dropped afterwards when its value is too short. Offsets count code points, ends
are exclusive. A null text is empty; a null id is allowed; repeated rows are
reported each; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

BLOCK_ROWS = 4096


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules. A run of hex digits or key characters is maximal, so its least length stands in the pattern.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)

_ANY = frozenset([frozenset()])  # the query that every text answers
_MOST = 64


def _either(queries) -> frozenset:
    """The OR of queries, without clauses that another one implies."""
    clauses = frozenset().union(*queries)
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _both(a: frozenset, b: frozenset) -> frozenset:
    return _either([frozenset(x | y for x, y in product(a, b))])


def _of_strings(strings: set[str]) -> frozenset:
    return _either([frozenset([frozenset(s[k:k + 3].lower() for k in range(len(s) - 2))]) for s in strings])


def _walk(items) -> tuple[set[str] | None, frozenset]:
    """Of a parsed expression: its strings if they are few, and what any match must hold."""
    query, run, exact = _ANY, {""}, True
    for op, value in items:
        strings, own = None, _ANY
        name = str(op)
        if name == "LITERAL":
            strings = {chr(value)}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            strings = {chr(c) for _, c in value}
        elif name == "SUBPATTERN":
            strings, own = _walk(value[-1])
        elif name == "BRANCH":
            parts = [_walk(p) for p in value[1]]
            strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
            own = _either([_of_strings(s) if s is not None else q for s, q in parts])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            inner, q = _walk(value[2])
            if (value[0], value[1]) == (0, 1) and inner is not None:
                strings = inner | {""}
            elif value[0]:
                own = q if inner is None else _of_strings(inner)
        if strings is not None and len(strings) * len(run) <= _MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        query = _both(query, _of_strings(run))
        query, run, exact = _both(query, own if strings is None else _of_strings(strings)), {""}, False
    return (run, _of_strings(run)) if exact else (None, _both(query, _of_strings(run)))


def trigram_query(pattern: str) -> list[list[str]]:
    """An OR of ANDs of trigrams; empty if some match holds none."""
    strings, query = _walk(re._parser.parse(pattern))
    query = query if strings is None else _of_strings(strings)
    return [] if frozenset() in query else sorted(sorted(c) for c in query)


def candidates(rows: DataFrame, queries: dict[int, list[list[str]]]) -> DataFrame:
    """(key, rules): keys of ``rows`` (key, text) that answer a query, with the rules' bits."""
    asked = sorted({t for q in queries.values() for clause in q for t in clause})
    low = rows.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(k)) for k, t in enumerate(asked)]))
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    posted = low.select("key", F.pmod("key", F.lit(blocks)).alias("block"), F.explode(held).alias("trigram"))
    index = posted.groupBy("block", "trigram").agg(F.collect_set("key").alias("keys"))
    index = materialize(index, "trigram_index")
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))

    def answer(query: list[list[str]]) -> Column:
        clauses = [reduce(F.array_intersect, [F.coalesce(F.element_at("lists", F.lit(asked.index(t))), F.array().cast("array<bigint>"))
                                              for t in clause]) for clause in query]
        return reduce(F.array_union, clauses)
    found = lists.select(F.explode(F.array(*[F.struct(F.lit(1 << rule).alias("bit"), answer(q).alias("keys")) for rule, q in queries.items()])).alias("x"))
    found = found.select("x.bit", F.explode("x.keys").alias("key"))
    return found.groupBy("key").agg(F.bit_or("bit").alias("rules"))


def _spans(rule: Rule, number: int, asked: Column) -> Column:
    """The matches of a rule as (start, rule, end), from the gaps between them."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"), F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
                         F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("value"))
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")

    def step(state, part):
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.coalesce(F.char_length(part["match"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end")))
        kept = F.when(F.char_length(part["value"]) >= rule.least, F.concat(state["spans"], one)).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])
    return F.when(asked & F.col("text").rlike(rule.pattern), found).otherwise(none)


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document (doc_id, text): doc_id and spans, an array of (start, rule, end) by start and rule."""
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    if queries:
        rows = rows.join(candidates(rows.select("key", "text"), queries).hint("shuffle_hash"), "key", "left")
    else:
        rows = rows.withColumn("rules", F.lit(0))
    asked = [F.coalesce(F.col("rules").bitwiseAND(1 << k) != 0, F.lit(False)) if k in queries else F.lit(True) for k in range(len(rules))]
    spans = F.concat(*[_spans(r, k, asked[k]) for k, r in enumerate(rules)])
    return rows.select("doc_id", F.array_sort(spans).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts by kind, the digest of the spans and the spans as text."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", F.get(names, s["rule"]), s["start"], s["end"])), ",")
    numbers = F.transform("spans", lambda s: s["rule"])
    counts = [(F.size("spans") - F.size(F.array_remove(numbers, F.lit(k)))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(rules)]
    return found.select("doc_id", *counts, text.alias("spans")).withColumn("base_sha256", F.sha2(F.col("spans").cast("binary"), 256))
