"""Secret scans through a trigram inverted index.

Each rule's regular expression yields a Boolean query over trigrams that every
match must contain (Cox 2012). The index holds, for the trigrams the rules can
ask for, the documents they occur in, without regard to case. Intersected
postings name the candidate documents of a rule, where its expression is run;
rules without mandatory trigrams scan all documents. DataFrame functions only.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import table, unused
from rankforge.storage import materialize

MAX_EXACT = 64  # strings that one stretch of an expression may stand for
MAX_CLASS = 4  # characters of a class that is still spelled out
# Candidate keys sent to every executor: 8 bytes each and a short array. Beyond
# it, texts meet their candidates in a shuffle.
MAX_BROADCAST_CANDIDATES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping; those whose
    ``group`` has fewer than ``min_length`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0


# The base rules.
BASE_RULES = (
    Rule("assign",
         r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # runs are maximal, so the length may stand in the expression
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("code_host", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    # a key goes to the END line of its own kind, if that is the next BEGIN or END
    # line; else over the base64 that follows: long runs after any white space
    # (or its escapes), whole lines, and the lines of an encrypted key's header.
    # Repeated groups are possessive: Java would recurse for others.
    Rule("private_key",
         r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----"
         r"(?:(?:(?!-----(?:BEGIN|END) )[\s\S])*+-----END \1PRIVATE KEY-----"
         r"|(?:(?:\s|\\[nr])++[A-Za-z0-9+/]{20,}+={0,2}"
         r"|[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+[A-Za-z0-9+/]++={0,2}(?=[\x20\t\r]*+(?:\n|\\[nr]|$))"
         r"|(?:\s|\\[nr])++(?:Proc-Type|DEK-Info):[^\r\n]*+)*+)"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

# A query is a set of sets of trigrams: any of the sets, all of its trigrams.
# The query of everything has the empty set in it.
Query = frozenset
ALL: Query = frozenset([frozenset()])


def _absorbed(query: Query) -> Query:
    return frozenset(s for s in query if not any(t < s for t in query))


def _both(a: Query, b: Query) -> Query:
    return _absorbed(frozenset(x | y for x in a for y in b))


def _of_strings(strings: set[str]) -> Query:
    return _absorbed(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _characters(items) -> set[str] | None:
    """The characters of a class, if they are few and listed."""
    found: set[str] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            found.add(chr(value))
        elif str(op) == "RANGE" and value[1] - value[0] < MAX_CLASS:
            found.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return None
    return found if len(found) <= MAX_CLASS else None


def _walk(parsed) -> tuple[set[str] | None, Query]:
    """(all strings an expression stands for, if few; what any match contains)."""
    exact, query = {""}, ALL
    whole = True  # so far ``exact`` spells out everything
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            strings, inner = {chr(value)}, ALL
        elif name == "IN":
            strings, inner = _characters(value), ALL
        elif name == "AT":
            continue
        elif name == "SUBPATTERN":
            strings, inner = _walk(value[3])
        elif name == "BRANCH":
            parts = [_walk(p) for p in value[1]]
            strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
            inner = _absorbed(frozenset().union(*(q if s is None else _of_strings(s) for s, q in parts)))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, sub = value
            strings, inner = _walk(sub)
            if strings is not None and high == 1 and low == 0:
                strings = strings | {""}
            elif strings is not None and low == high and len(strings) ** int(low) <= MAX_EXACT:
                strings = {"".join(p) for p in itertools.product(strings, repeat=int(low))}
            elif low == 0:
                strings, inner = None, ALL
            else:
                inner = inner if strings is None else _of_strings(strings)
                strings = None
        else:
            strings, inner = None, ALL
        if strings is not None and len(exact) * len(strings) <= MAX_EXACT:
            exact = {(a + b).lower() for a in exact for b in strings}
            continue
        query = _both(_both(query, _of_strings(exact)), inner if strings is None else _of_strings(strings))
        exact, whole = {""}, False
    if whole:
        return exact, _of_strings(exact)
    return None, _both(query, _of_strings(exact))


def trigram_query(pattern: str) -> Query | None:
    """Sets of lower-case trigrams, one of which every match contains in whole;
    None if there is no such demand and everything has to be scanned."""
    query = _walk(regex_parser.parse(pattern))[1]
    return None if frozenset() in query else query


def doc_key(text: Column) -> Column:
    return F.xxhash64(text)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index ``(trigram, key)``, restricted to ``trigrams``: a row
    for each document (by the hash of its text) and trigram in it."""
    text = F.lower(F.coalesce("text", F.lit("")))
    lowered = docs.select(doc_key(F.coalesce("text", F.lit(""))).alias("key"), text.alias("text"))
    present = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("text"), t))
    return lowered.select("key", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``(key, kinds)``: the documents that the postings of a rule's trigrams
    have in common, for any of its sets, with the kinds of these rules."""
    held = index.groupBy("key").agg(F.collect_set("trigram").alias("held"))
    kinds = [
        F.when(
            F.greatest(*[
                F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(s))))) == len(s) for s in sorted(query, key=sorted)
            ], F.lit(False)), F.lit(kind))
        for kind, query in queries.items()
    ]
    found = held.select("key", F.filter(F.array(*kinds), lambda k: k.isNotNull()).alias("kinds"))
    return found.where(F.size("kinds") > 0)


SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """All matches with their places in code points. The text between matches
    comes from splitting by the same expression."""
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(whole)), F.arrays_zip(whole.alias("w"), group.alias("g")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("n"), F.length(m["g"]).alias("g")),
    )
    first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("found"))

    def add(done: Column, m: Column) -> Column:
        start = done["at"] + m["gap"]
        span = F.array(F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (start + m["n"]).alias("end")))
        return F.struct(
            (start + m["n"]).alias("at"),
            F.when(m["g"] >= rule.min_length, F.concat(done["found"], span)).otherwise(done["found"]).alias("found"))

    found = F.aggregate(steps, first, add, lambda done: done["found"])
    return F.when(F.rlike(text, F.lit(rule.pattern)), found).otherwise(F.expr(f"cast(array() as {SPAN})"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """``docs`` with the column ``name``: all rules' matches as (start, rank of
    the rule, kind, end), by start, then rule; places count code points.

    A null text counts as empty. Every row is scanned by itself, repeated rows
    alike; no rows give none. Other columns pass unchanged, whatever their
    names; a column called ``name`` is replaced.
    """
    docs = docs.drop(name)
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    key, kinds = unused(docs, "_scan_key"), unused(docs, "_scan_kinds")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn(key, doc_key(text))
    if queries:
        needed = sorted({t for q in queries.values() for s in q for t in s})
        found = materialize(candidates(postings(docs, needed), queries), "candidates").select(
            F.col("key").alias(key), F.col("kinds").alias(kinds))
        n = found.count()
        keyed = keyed.join(F.broadcast(found) if n <= MAX_BROADCAST_CANDIDATES else found, key, "left")
    else:
        keyed = keyed.withColumn(kinds, F.lit(None).cast("array<string>"))
    nothing = F.expr(f"cast(array() as {SPAN})")
    parts = [
        _spans(text, rule, rank) if rule.kind not in queries
        else F.when(F.array_contains(kinds, rule.kind), _spans(text, rule, rank)).otherwise(nothing)
        for rank, rule in enumerate(rules)
    ]
    return keyed.select(*docs.columns, F.array_sort(F.concat(*parts)).alias(name))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by ``mark`` once."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        return F.when(s["start"] >= done["at"], F.struct(
            s["end"].alias("at"), F.concat(done["parts"], F.array(gap, F.lit(mark))).alias("parts"),
        )).otherwise(F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["parts"].alias("parts")))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, first, add,
        lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )
