"""The n-gram join against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contractloom.llm import ngram_join
from contractloom.llm.common import read

DOCS = "doc_id long, text string"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def by_hand(rows):
    """``(id, n, component)`` of every row, by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i != j and 20 * len(a & b) >= 17 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(shingles(t)), None if i is None else find(i)) for i, t in rows), key=str)


def by_spark(df):
    return sorted(((r.id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(df).collect()), key=str)


def prose(rng, n, words=4000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**9)}"
    return out


def near_copies(seed=7):
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 40)
    for size in (5, 8, 14, 30, 60, 61, 200, 700):
        for _ in range(3):
            base = prose(rng, size)
            rows += [base, base[:-1], base[1:], base + ["more"], *(edited(rng, base, k) for k in (1, 1, 2, 3, size // 40, size // 25))]
            rows.append(base[: size // 2] + passage + base[size // 2 :])
    rows += [passage + prose(rng, 20) for _ in range(40)]
    rng.shuffle(rows)
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


def test_join_matches_brute_force(spark):
    rows = near_copies()
    want = by_hand(rows)
    assert 20 < sum(i != c for i, _, c in want) < len(rows)
    assert by_spark(spark.createDataFrame(rows, DOCS)) == want


def test_common_parts_are_left_out_without_loss(spark, monkeypatch):
    """Every part that two sets share counts as common; groups are opened one member at a time."""
    for name, value in (("MANY", 1), ("GROUP", 2), ("UNION", 100)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(8)
    assert by_spark(spark.createDataFrame(rows, DOCS)) == by_hand(rows)


def test_chains_rings_and_large_groups(spark):
    rng = random.Random(4)
    now, rows = prose(rng, 300), []
    for i in range(40):  # a chain: the ends are far apart
        rows.append((100 + i, " ".join(now)))
        now[rng.randrange(300)] = f"new{i}"
    base = prose(rng, 150)
    rows += [(1000 + i, " ".join(edited(rng, base, 2))) for i in range(150)]  # near copies around a text that is not there
    rows += [(3000 + i, " ".join(base[:100] + prose(rng, 50))) for i in range(100)]  # share two thirds, no links
    rows += [(i, "a b c d e f g h i j") for i in range(30, 10, -1)] + [(50, "A B c D e F g h i j"), (51, "a b c"), (52, "A b\tC"), (53, "a b")]
    assert by_spark(spark.createDataFrame(rows, DOCS).repartition(7)) == by_hand(rows)


def test_work_grows_with_the_rows_where_texts_share_passages(spark):
    """Texts of 14 of 20 passages, none linked: cells that are looked at."""
    passages = [prose(random.Random(k), 30) for k in range(20)]
    cells = {}
    for n in (100, 200):
        rng = random.Random(n)
        rows = [(i, " ".join(w for p in rng.sample(passages, 14) for w in p)) for i in range(n)]
        df = spark.createDataFrame(rows, DOCS)
        assert by_spark(df) == by_hand(rows)
        found = ngram_join.sketches(df, "doc_id", "text").select(F.col("row").alias("c"), "slacks", "parts")
        left, _ = ngram_join.buckets(found)
        cells[n] = left.groupBy("key").agg((F.count("*") * (F.count("*") - 1) / 2).alias("k")).agg(F.sum("k")).first()[0] or 0
    assert cells[200] <= 6 * max(cells[100], 50)


def test_parts_of_linked_sets_agree_more_often_than_the_slack():
    rng = np.random.default_rng(2)
    for n in (7, 13, 20, 77, 400, 5000):
        edges = ngram_join.size_classes(1 << 16)
        for _ in range(20):
            pool = np.unique(rng.integers(0, 2**63, 2 * n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            a = np.sort(rng.permutation(pool)[:n])
            gone = rng.integers(0, n * 15 // 100 + 1)
            b = np.sort(np.concatenate([a[gone:], pool[~np.isin(pool, a)][: rng.integers(0, 1 + (100 * (n - gone) - 85 * n) // 85)]]))
            common = len(np.intersect1d(a, b))
            assert 100 * common >= 85 * len(np.union1d(a, b))
            fa, fb = (set(ngram_join.families(len(x), edges)) for x in (a, b))
            if common == len(a) == len(b):
                continue
            f = min(np.searchsorted(edges, len(a)), np.searchsorted(edges, len(b)))
            assert f in fa & fb
            d = ngram_join.differing(int(edges[f]))
            same = np.intersect1d(ngram_join.parts(a, d, f), ngram_join.parts(b, d, f))
            assert len(same) > ngram_join.slack_of(d)


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\v\f\r"), (None, "one two three four five six"), (None, "one two three four five six"), (4, long), (14, long + " end"),
        (5, "same words " * 30), (5, "same words " * 30), (6, "Grüße aus Köln, 日本語 und mehr"), (7, "GRÜßE aus Köln, 日本語 und mehr"), (8, "grÜße aus köln, 日本語 und mehr"),
        (20, "a b c d e f g"), (20, "h i j k l m n"), (18, "h i j k l m n"), (29, "a b c d e f g"),
    ]
    df = spark.createDataFrame(rows, DOCS).withColumn("C", F.lit(1)).withColumn("key", F.lit("x"))
    want = by_hand(rows)
    assert by_spark(df) == want
    assert {i: c for i, _, c in want} == {1: 1, 2: 2, 3: 3, None: None, 4: 4, 14: 4, 5: 5, 6: 6, 7: 7, 8: 7, 20: 18, 18: 18, 29: 18}
    assert ngram_join.similar_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_query_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.op12_token_group_join(spark, sf).collect()), key=str)
    assert got == by_hand(rows)


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 13, 100, 12345])
def test_size_classes(n):
    edges = ngram_join.size_classes(1 << 16)
    own = np.searchsorted(edges, n)
    largest = n * 100 // 85
    assert np.searchsorted(edges, largest) - own in (0, 1)
