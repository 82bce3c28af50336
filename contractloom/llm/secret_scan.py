"""Secret scans: a trigram inverted index, in DataFrame functions only.

From each rule's regex a Boolean query over trigrams is derived: any text that the regex
can match holds all trigrams of one of its alternatives. The index holds, for the
trigrams of the rules, the texts they occur in; the postings of an alternative are
intersected by counting, and only texts that meet a rule's query are searched with its
regex. A rule without a mandatory trigram is searched in every text.

Texts are indexed once however many rows repeat them. The queries come from the rules
alone, so they are few and small; postings, candidates and texts meet in joins.

Defined results: a null text counts as empty and has no span. Repeated rows get the same
result each. Other columns are not carried.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, read, written


class Rule(NamedTuple):
    kind: str
    regex: str
    group: int = 0  # the group whose length counts
    least: int = 0  # characters in it, at least


# The three base rules.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # runs are maximal, so shorter ones need not be found to be dropped
)
MORE = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
RULES = BASE + MORE
MOST_STRINGS = 64  # alternatives that are spelled out; beyond, a part demands nothing

Query = frozenset[frozenset[str]]  # any of these sets of trigrams; {frozenset()} demands nothing
ALL: Query = frozenset([frozenset()])


def _least(q: Query) -> Query:
    return frozenset(s for s in q if not any(o < s for o in q))


def _and(a: Query, b: Query) -> Query:
    both = _least(frozenset(x | y for x in a for y in b))
    return both if len(both) <= MOST_STRINGS else min(a, b, key=len)


def _of(strings: set[str]) -> Query:
    """What a text demands that holds one of the strings (in small letters)."""
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _strings(op, arg) -> set[str] | None:
    """All strings an item can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        out = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])[0]
    if op is sre.BRANCH:
        parts = [_sequence(p)[0] for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 2:
        once = _sequence(arg[2])[0]
        return None if once is None else {"".join(p) for n in range(arg[0], arg[1] + 1) for p in itertools.product(once, repeat=n)}
    return None


def _demand(op, arg) -> Query:
    """What an item demands whose strings are many."""
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])[1]
    if op is sre.BRANCH:
        return _least(frozenset().union(*(_sequence(p)[1] for p in arg[1])))
    if op is sre.MAX_REPEAT and arg[0] >= 1:
        return _sequence(arg[2])[1]
    return ALL


def _sequence(items) -> tuple[set[str] | None, Query]:
    """The strings of a sequence, if they are few, and its demand."""
    run, demand, exact = {""}, ALL, True
    for op, arg in items:
        found = _strings(op, arg)
        if found is not None and len(run) * len(found) <= MOST_STRINGS:
            run = {a + b for a in run for b in found}
        else:
            demand, exact = _and(demand, _of(run)), False
            run = found if found is not None and len(found) <= MOST_STRINGS else {""}
            if found is None:
                demand = _and(demand, _demand(op, arg))
    demand = _and(demand, _of(run))
    return (run if exact else None), demand


def trigram_query(regex: str) -> Query:
    """The Boolean trigram query of a regex, in small letters: any of its sets, all of whose trigrams occur."""
    return _sequence(sre_parser.parse(regex))[1]


def spans_of(t: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches as ``array<struct<start, rank, end, kind>>``, in code points.

    Gaps and matches come in order, so positions are sums of their lengths.
    """
    regex = F.lit(rule.regex)
    cut = F.arrays_zip(
        F.split(t, rule.regex), F.regexp_extract_all(t, regex, F.lit(0)), F.regexp_extract_all(t, regex, F.lit(rule.group))
    ).cast("array<struct<gap:string,hit:string,counts:string>>")
    kind = "array<struct<start:int,rank:int,end:int,kind:string>>"

    def step(a, x):
        start = a["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))).cast(kind)
        return F.struct(
            end.alias("at"), F.when(F.coalesce(F.length(x["counts"]), F.lit(-1)) >= max(rule.least, 1), F.concat(a["out"], span)).otherwise(a["out"]).alias("out")
        )

    none = F.array().cast(kind)
    found = F.aggregate(cut, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    return F.when(t.rlike(rule.regex), found).otherwise(none)


def index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The postings ``trigram, id`` of ``texts`` (``id, text``): once for each text a trigram occurs in."""
    low = texts.select("id", F.lower("text").alias("low"))
    there = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams]))
    return low.select(F.explode(there).alias("trigram"), "id").distinct()


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``id, kinds``: the texts that meet a rule's query, with the rules they meet."""
    spark = postings.sparkSession
    parts = [(kind, n, len(s), g) for kind, q in queries.items() for n, s in enumerate(sorted(map(sorted, q))) for g in s]
    wanted = spark.createDataFrame(parts, "kind string, part int, need int, trigram string")  # bounded by the rules
    return (
        postings.join(F.broadcast(wanted), "trigram")
        .groupBy("id", "kind", "part", "need").agg(F.count(F.lit(1)).alias("n")).filter("n = need")
        .groupBy("id").agg(F.collect_set("kind").alias("kinds"))
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key, spans`` for every row; spans in order of start, then rule."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    listed = {k: q for k, q in queries.items() if frozenset() not in q}
    rank = {r.kind: i for i, r in enumerate(rules)}
    rows = docs.select(column(docs, key).alias("key"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.unhex(F.md5("text")))
    scanned = [spans_of(F.col("text"), r, rank[r.kind]) for r in rules if r.kind not in listed]
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    plain = rows.select("key", "id", F.concat(none, *scanned).alias("scanned"))
    if listed:
        postings = written(index(rows.select("id", "text"), sorted({g for q in listed.values() for s in q for g in s})), "secrets-index")
        met = candidates(postings, listed)
        found = [
            F.when(F.array_contains("kinds", r.kind), spans_of(F.col("text"), r, rank[r.kind])).otherwise(none)
            for r in rules if r.kind in listed
        ]
        verified = rows.select("id", "text").join(met, "id").select("id", F.concat(*found).alias("found")).filter(F.size("found") > 0)
        verified = written(verified, "secrets-verified").dropDuplicates(["id"])  # texts that rows repeat
        plain = plain.join(verified, "id", "left")
    else:
        plain = plain.withColumn("found", none)
    return plain.select("key", F.array_sort(F.concat("scanned", F.coalesce("found", none))).alias("spans"))


def _listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    return found.select(
        F.col("key").alias("doc_id"), *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(_listing(base), 256).alias("base_sha256"), _listing(F.col("spans")).alias("spans"),
    )
