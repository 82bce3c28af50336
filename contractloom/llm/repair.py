"""Conversation structure repair: Hirschberg's divide and conquer over four states.

A conversation's roles should read ``(s?(ua)+)?`` by their initials. The rows are edited at
least cost: Keep 0, Rerole to user or assistant 3, Delete 4 (a must for blank and repeated
rows), Insert an empty user or assistant anywhere 3, and 3 more for a truncated row that
stays. Of all cheapest edits the one whose audit, the string of initials, is least in
ASCII is taken.

The four states are: nothing yet, behind the system, behind a user, behind an assistant.
What a row can do is a table of states by states, each with a cost and the rank of its
audit among those of the same first state. Tables chain, so a forward vector (cost and rank
by state, from the first row on) and a backward vector (cost by state, from the last row
back) meet in the middle of a conversation. Of the states where their sum is least, the one
of the least rank is the crossing; then both halves are solved alike. The crossing is the
state right behind a row's own letter, so none of two audits up to it begins the other, and
ranks decide the order of whole audits. No more than two vectors are held at a time.

How it stays small: rows are dealt by ranges of (conversation, turn, role, text), so a
conversation of any length lies in pieces over many tasks, of ``PIECE`` rows at most. Each
piece is reduced to its table in parallel; per conversation only the tables are chained,
which gives the states at the edges of the pieces; then each piece is solved by itself.
The digest of the repaired text is taken from a sorted stream, row by row.

Defined results: null conversations form one; null turns stand first, null roles and texts
are one space. Rows of one turn stand in order of role and text. A role counts by its first
character; one that is none of ``s``, ``u`` and ``a`` cannot be kept. A conversation
without rows has zeros, an empty audit and the digest of nothing. An empty table
gives no row; other columns are not carried.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, written

SPACE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
PIECE = 1 << 16
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# What may be put in behind each state: the number of rows to reach another one.
_PUT_IN = {START: {START: 0, USER: 1, ASSISTANT: 2}, SYSTEM: {SYSTEM: 0, USER: 1, ASSISTANT: 2},
           USER: {USER: 0, ASSISTANT: 1}, ASSISTANT: {ASSISTANT: 0, USER: 1}}
_TO_END = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
_INITIALS = ("s", "u", "a", "")

Vector = dict  # state -> (cost, rank)


def row_edits(number: int) -> dict[int, dict[int, tuple[int, str]]]:
    """First state -> last state -> (cost, audit), the cheapest and then least, for what matters of a row.

    The number is three times the initial's place, plus 1 for a truncated row and 2 for one that must go.
    """
    initial, fault = _INITIALS[number // 3], number % 3
    out: dict[int, dict[int, tuple[int, str]]] = {}
    for first, reach in _PUT_IN.items():
        best: dict[int, tuple[int, str]] = {}
        for state, n in reach.items():
            put, stays = INSERT * n, TRUNCATED * (fault == 1)
            options = [(state, (put + DELETE, "I" * n + "D"))]
            if fault < 2:
                if state in _AFTER.get(initial, {}):
                    options.append((_AFTER[initial][state], (put + KEEP + stays, "I" * n + "K")))
                options += [(_AFTER[r][state], (put + REROLE + stays, "I" * n + "R")) for r in "ua" if state in _AFTER[r]]
            for last, edit in options:
                best[last] = min(best.get(last, edit), edit)
        out[first] = best
    return out


def ranked(edits) -> dict[int, Vector]:
    """The same with the rank of each audit among those of its first state."""
    out = {}
    for first, best in edits.items():
        order = sorted(best, key=lambda last: best[last][1])
        out[first] = {last: (best[last][0], order.index(last)) for last in best}
    return out


EDITS = [row_edits(k) for k in range(12)]
TABLES = [ranked(e) for e in EDITS]


def forward(tables, first: int) -> Vector:
    """Cost of each state behind the last table, and the rank of its least audit."""
    vector: Vector = {first: (0, 0)}
    for table in tables:
        best: dict[int, tuple[int, int, int]] = {}
        for state, (cost, rank) in vector.items():
            for last, (more, place) in table[state].items():
                new = (cost + more, rank, place)
                if last not in best or new < best[last]:
                    best[last] = new
        order = sorted(best, key=lambda last: best[last][1:])
        vector = {last: (best[last][0], order.index(last)) for last in best}
    return vector


def backward(tables, ends: dict[int, int]) -> dict[int, int]:
    """Least cost from each state before the first table to the ``ends``."""
    costs = dict(ends)
    for table in reversed(tables):
        costs = {
            first: min(options)
            for first, row in table.items()
            if (options := [cost + costs[last] for last, (cost, _) in row.items() if last in costs])
        }
    return costs


def crossing(front: Vector, back: dict[int, int]) -> int:
    """Of the states where the vectors' sum is least, the one of the least audit."""
    return min((cost + back[s], rank, s) for s, (cost, rank) in front.items() if s in back)[2]


def solve(tables, first: int, last: int) -> list[int]:
    """The state behind each table, from ``first`` to ``last``."""
    if len(tables) <= 1:
        return [last] if tables else []
    middle = len(tables) // 2
    at = crossing(forward(tables[:middle], first), backward(tables[middle:], {last: 0}))
    return solve(tables[:middle], first, at) + solve(tables[middle:], at, last)


def whole(tables) -> tuple[int, int]:
    """Cost and last state of the best way through all tables, with the rows put in behind them."""
    front = forward(tables, START)
    ends = {s: INSERT * n for s, n in _TO_END.items()}
    last = crossing(front, ends)
    return front[last][0] + ends[last], last


def audit_of(codes: bytes, first: int, last: int) -> str:
    """The audit of a piece between two states."""
    out = []
    for number, state in zip(codes, solve([TABLES[c] for c in codes], first, last)):
        out.append(EDITS[number][first][state][1])
        first = state
    return "".join(out)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that their keys choose: ``conv_id, turn, role, text``."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))
    return rows.filter("k <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _schema(df: DataFrame, columns: list[str], more: str) -> T.StructType:
    """The named columns as they are in ``df``, and more."""
    return T.StructType([df.schema[c] for c in columns] + T.StructType.fromDDL(more).fields)


def _pieces(batches):
    """The rows with their task and their place in it."""
    from pyspark import TaskContext

    part, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())],
            names=[*batch.schema.names, "part", "place"],
        )
        place += n


def placed(rows: DataFrame) -> DataFrame:
    """The rows in order, with first faults and the place of each: (conversation, part, place) sorts as the order does.

    Written once: the places hold only for one dealing of the rows.
    """
    ordered = rows.repartitionByRange(
        *(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text"))
    ).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")))
    return written(ordered.mapInArrow(_pieces, _schema(ordered, ordered.columns, "part long, place long")), "repair-rows")


def faults(rows: DataFrame) -> DataFrame:
    """``fault`` of each placed row: blank, duplicate, truncated or empty, the first that holds."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("same", same)
    # The first of equal rows, by an aggregate that combines before the shuffle; only rows that have an equal are joined.
    first = rows.groupBy("conv_id", "same").agg(F.min(F.struct("part", "place")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("_conv"), F.col("same").alias("_same"), "first")
    seen = rows.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left")
    body = F.btrim("text", F.lit(SPACE))
    fault = (
        F.when(body == "", "blank")
        .when(F.col("first").isNotNull() & (F.struct("part", "place") > F.col("first")), "duplicate")
        .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return seen.select("conv_id", "turn", "part", "place", "role", "text", fault.alias("fault"))


def pieces(rows: DataFrame) -> DataFrame:
    """``conv_id, part, piece, codes, firsts`` and the counts of each piece, without the texts.

    A piece holds ``PIECE`` rows of one conversation at most, so gathering its letters is bounded.
    """
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), F.instr(F.lit("sua"), initial) - 1).otherwise(3)
    gone = F.col("fault").isin("blank", "duplicate")
    number = kind * 3 + F.when(gone, 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    slim = rows.select("conv_id", "part", "place", F.floor(F.col("place") / PIECE).alias("piece"), initial.alias("initial"), "fault", number.alias("code"))
    gathered = slim.groupBy("conv_id", "part", "piece").agg(
        F.array_sort(F.collect_list(F.struct("place", "code", "initial"))).alias("all"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    letters = F.transform("all", lambda x: x["initial"])
    pairs = F.zip_with(F.slice(letters, 1, F.size("all") - 1), F.slice(letters, 2, F.size("all") - 1), lambda x, y: F.concat(x, y))
    return gathered.select(
        "conv_id", "part", "piece", "blank", "duplicate", "truncated",
        F.unhex(F.array_join(F.transform("all", lambda x: F.lpad(F.hex(x["code"]), 2, "0")), "")).alias("codes"),
        F.when(F.size("all") < 2, 0).otherwise(F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).cast("long").alias("illegal"),
        F.get(letters, F.lit(0)).alias("head"), F.get(letters, F.size("all") - 1).alias("tail"),
    )


def _with_tables(found: DataFrame) -> DataFrame:
    """The pieces with ``steps``: their tables as 32 numbers, cost and rank by first and last state (-1: no way)."""

    def run(batches):
        for batch in batches:
            steps = []
            for codes in batch.column(batch.schema.get_field_index("codes")).to_pylist():
                tables = [TABLES[c] for c in codes]
                ways = [forward(tables, s) for s in range(4)]
                steps.append([x for way in ways for s in range(4) for x in way.get(s, (-1, -1))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(steps, pa.list_(pa.int64()))], names=[*batch.schema.names, "steps"]
            )

    return found.mapInArrow(run, _schema(found, found.columns, "steps array<long>"))


def _table(steps: list[int]) -> dict[int, Vector]:
    return {s: {t: (steps[8 * s + 2 * t], steps[8 * s + 2 * t + 1]) for t in range(4) if steps[8 * s + 2 * t] >= 0} for s in range(4)}


def _chained(found: DataFrame) -> DataFrame:
    """Per conversation: counts, cost, and the states at the edges of its pieces. Holds tables only, no rows."""
    per = found.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
        F.array_sort(F.collect_list(F.struct("part", "piece", "steps", "head", "tail"))).alias("all"),
    )

    def run(batches):
        for batch in batches:
            cost, edges, between = [], [], []
            for parts in batch.column(batch.schema.get_field_index("all")).to_pylist():
                tables = [_table(p["steps"]) for p in parts]
                total, last = whole(tables)
                states = [START, *solve(tables, START, last)]
                cost.append(total)
                edges.append([
                    {"part": p["part"], "piece": p["piece"], "first": a, "last": b, "behind": _TO_END[last] if i == len(parts) - 1 else 0}
                    for i, (p, a, b) in enumerate(zip(parts, states, states[1:]))
                ])
                between.append(sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:])))
            illegal = [a + b for a, b in zip(batch.column(batch.schema.get_field_index("illegal")).to_pylist(), between)]
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("part", "piece", "first", "last", "behind")]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(illegal, pa.int64()), pa.array(cost, pa.int64()), pa.array(edges, kind)],
                names=["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "edges"],
            )

    edge = "struct<part:long,piece:long,first:long,last:long,behind:long>"
    return per.mapInArrow(run, _schema(found, ["conv_id"], f"blank long, duplicate long, truncated long, illegal long, cost long, edges array<{edge}>"))


def _audits(found: DataFrame, chained: DataFrame) -> DataFrame:
    """``conv_id, part, piece, audit``: each piece solved between the states at its edges."""
    edges = chained.select(F.col("conv_id").alias("_conv"), F.inline("edges"))
    edges = edges.select("_conv", F.col("part").alias("_part"), F.col("piece").alias("_piece"), "first", "last", "behind")
    both = found.select("conv_id", "part", "piece", "codes").join(
        edges, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("piece") == F.col("_piece"))
    ).select("conv_id", "part", "piece", "codes", "first", "last", "behind")

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3, 7)))
            audits = [audit_of(codes, first, last) + "I" * behind for codes, first, last, behind in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(audits, pa.string())], names=["conv_id", "part", "piece", "audit"])

    return both.mapInArrow(run, _schema(found, ["conv_id"], "part long, piece long, audit string"))


_NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_STATE = {"user": USER, "assistant": ASSISTANT}


def repaired_rows(audit: str, rows: list[tuple[str, str]], state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The edits of an audit applied to rows, and the state behind them."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            role = _NEXT[state]
            out.append((role, ""))
            state = _STATE[role]
            continue
        role, text = rows[at]
        at += 1
        if letter == "K":
            out.append((role, text))
            state = _AFTER[role[0]][state]
        elif letter == "R":
            role = _NEXT[state]
            out.append((role, text))
            state = _STATE[role]
    return out, state


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256`` from a stream sorted by conversation and place.

    Each piece's audit comes before its rows in the stream, so no more than one piece's audit
    is held, and one text at a time.
    """
    piece = F.floor(F.col("place") / PIECE)
    stream = rows.select("conv_id", "part", piece.alias("piece"), "place", "role", "text", F.lit(None).cast("string").alias("audit")).unionByName(
        audits.select("conv_id", "part", "piece", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    )
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece", "place")

    def run(batches):
        import hashlib

        nothing = object()
        now, digest, audit, written_any = nothing, None, [], False
        state, held, left = START, "", 0
        kind = None

        def put(made):
            nonlocal written_any
            for role, text in made:
                digest.update(((("\n" if written_any else "") + role + ":" + text)).encode("utf-8", "surrogatepass"))
                written_any = True

        def rest():
            """What is put in behind the last row."""
            nonlocal state
            made, state = repaired_rows(held[left:], [], state)
            put(made)

        def result():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], kind), pa.array(["".join(audit)], pa.string()), pa.array([digest.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"]
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, place, role, text, edits in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6))):
                if place < 0:
                    if now is nothing or conv != now:
                        if now is not nothing:
                            rest()
                            yield result()
                        now, digest, audit, written_any, state = conv, hashlib.sha256(), [], False, START
                    else:
                        rest()
                    audit.append(edits)
                    held, left = edits, 0
                    continue
                end = left
                while held[end] == "I":
                    end += 1
                made, state = repaired_rows(held[left : end + 1], [(role, text)], state)
                put(made)
                left = end + 1
        if now is not nothing:
            rest()
            yield result()

    return stream.mapInArrow(run, _schema(rows, ["conv_id"], "audit string, repaired_sha256 string"))


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps, counts of faults, cost, audit and digest of the repaired rows."""
    rows = written(faults(placed(conversations.select("conv_id", "turn", "role", "text"))), "repair-faults")
    found = written(_with_tables(pieces(rows)), "repair-pieces")
    chained = written(_chained(found), "repair-chained")
    done = _digests(rows, _audits(found, chained))
    turns = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    named = lambda df, k: df.withColumnRenamed("conv_id", f"_conv{k}")
    same = lambda k: F.col("conv_id").eqNullSafe(F.col(f"_conv{k}"))
    return (
        chained.join(named(turns, 1), same(1)).join(named(done, 2), same(2))
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    )


def op11_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole_table = read(spark, sf_dir, "conversations")
    fixed = repair(damaged(whole_table))
    ids = whole_table.select("conv_id").distinct()
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # sha256 of no bytes
    out = ids.join(fixed.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return out.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
