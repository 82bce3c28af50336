"""Conversation repair against brute force over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from contractloom.llm import repair
from contractloom.llm.common import read

TURNS = "conv_id long, turn int, role string, text string"
WHITE = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(WHITE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif body[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def accepts(state, role):
    return {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role, {}).get(state)


def cheapest(rows, faults):
    """Cost, audit and repaired rows by a search over (row, state), cheapest and then least audit first."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, made
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in ("user", "assistant"):
            to = accepts(state, role[0])
            if to is not None:
                heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*made, (role, ""))))
        if i < len(rows):
            _, _, old, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, made))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                to = accepts(state, old[:1])
                if to is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, to, (*made, (old, text))))
                for role in ("user", "assistant"):
                    to = accepts(state, role[0])
                    if to is not None:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, to, (*made, (role, text))))
    raise AssertionError


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for conv, group in groups.items():
        group = damage(group)
        faults = faults_of(group)
        cost, audit, made = cheapest(group, faults)
        turns = {r[1] for r in group if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(group, group[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return out


def by_spark(df, op=None):
    fixed = repair.repair(repair.damaged(df)) if op is None else op
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in fixed.collect()}


def rows_at_random(seed, conversations, most):
    rng = random.Random(seed)
    out = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "", None])
            text = rng.choice(["yes.", "no!", "cut", "a. ", "", " \t", None, f"t{turn}?", f"cut {turn}"])
            out.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return out


def expected(rows):
    want = by_hand(rows)
    return {k: v for k, v in want.items() if damage([r for r in rows if r[0] == k])}


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_matches_a_search_over_all_edits(spark, seed):
    rows = rows_at_random(seed, 150, 14)
    assert by_spark(spark.createDataFrame(rows, TURNS)) == expected(rows)


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 7)
    rows = rows_at_random(3, 2, 400) + [(9, None, None, None), (None, 1, "user", "a null conversation."), (None, 2, "assistant", "yes.")]
    df = spark.createDataFrame(rows, TURNS).withColumn("AUDIT", F.lit(1)).withColumn("part", F.lit("x"))
    assert by_spark(df) == expected(rows)


def test_hirschberg_takes_the_least_of_all_cheapest_audits():
    rng = random.Random(5)
    for _ in range(400):
        kinds = [(rng.choice("suat"), rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(0, 40))]
        codes = bytes("suat".index(r) * 3 + ("", "truncated", "blank").index(f) for r, f in kinds)
        cost, last = repair.whole([repair.TABLES[c] for c in codes])
        audit = repair.audit_of(codes, repair.START, last) + "I" * repair._TO_END[last]
        want = cheapest([(0, 0, r, "x.") for r, _ in kinds], [f for _, f in kinds])
        assert (cost, audit) == want[:2]


def test_query_over_the_table_and_empty_tables(spark, sf, tmp_path):
    table = read(spark, sf, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert by_spark(None, repair.op11_hirschberg_repair(spark, sf)) == by_hand(rows)
    spark.createDataFrame([], TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    assert repair.op11_hirschberg_repair(spark, str(tmp_path)).count() == 0


def test_a_conversation_without_rows_left(spark, tmp_path):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    rows = [(1, gone, "user", "hello.")]
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    assert by_spark(None, repair.op11_hirschberg_repair(spark, str(tmp_path))) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
