"""Phrase mining against plain Python."""

import re
from collections import Counter

from pyspark.sql import functions as F

from contractloom.llm import collocations

DOCS = "doc_id long, text string, lang string"


def mined(rows, least=10, top=2000):
    total, f = Counter(), {1: Counter(), 2: Counter(), 3: Counter()}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                f[k].update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for k in (2, 3) for p, a in f[k].items() if a >= least}
    out = []
    for (lang, *words), a in candidates.items():
        n = len(words)
        if any(len(o) - 1 > n and o[0] == lang and 100 * b >= 50 * a and any(list(o[i : i + n]) == words for i in range(1, len(o) - n + 1)) for o, b in candidates.items()):
            continue
        cuts = []
        for k in range(1, n):
            l, r = f[k][(lang, *words[:k])], f[n - k][(lang, *words[k:])]  # noqa: E741
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        out.append((lang, " ".join(words), a, l, r, total[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranks = Counter()
    ranked = []
    for row in out:
        ranks[row[0]] += 1
        if ranks[row[0]] <= top:
            ranked.append((row[0], ranks[row[0]], *row[1:]))
    return ranked


def found(df, **options):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in names) for r in collocations.collocations(df, **options).collect())


ROWS = [
    (1, "New York City, new york city. " * 12 + "new york\tminute; York city", "en"),
    (2, "a b a b a b a b a b a b a b a b a b a b a b a b", "en"),
    (2, "a b a b a b a b a b a b a b a b a b a b a b a b", "en"),
    (3, "Éa ÉA b  c\nÉa b c\rÉa b c\x0bÉa b c\x0c" * 11, None),
    (4, "x y z " * 30, "und"),
    (5, "aaa " * 40, "de"),
    (6, None, "de"), (7, "", None), (8, " \t\n.,;", "fr"), (None, "one two three " * 20, "en"),
    (9, "\U0001f600 日本 語 " * 15, "ja"),
    (10, " ".join(f"w{i % 700}" for i in range(60_000)), "long"),
]


def test_phrases_match_plain_python(spark):
    df = spark.createDataFrame(ROWS, DOCS).withColumn("W", F.lit(1)).withColumn("at", F.lit("x"))
    assert found(df.repartition(5)) == sorted(mined(ROWS))


def test_small_steps_and_a_shuffled_semi_join(spark, monkeypatch):
    monkeypatch.setattr(collocations, "STEP", 7)
    monkeypatch.setattr(collocations, "SMALL", 0)
    assert found(spark.createDataFrame(ROWS[:9], DOCS), top=3) == sorted(mined(ROWS[:9], top=3))


def test_empty_table(spark):
    assert found(spark.createDataFrame([], DOCS)) == []


def test_scores_beyond_64_bits_are_exact(spark):
    cases = [(999_999_999_999, 10**12, 10**12 + 7), (10**12, 10**12, 10**12), (12, 10**13, 10**12), (7 * 10**11, 8 * 10**11, 9 * 10**13)]
    df = spark.createDataFrame(cases, "a long, l long, r long").withColumn("score", collocations._score("a", "l", "r"))
    assert {(r.a, r.l, r.r): r.score for r in df.collect()} == {c: 10**6 * c[0] ** 2 // (c[1] * c[2]) for c in cases}


def test_words_that_share_a_number_are_numbered_anew(spark, monkeypatch):
    real = collocations._number
    monkeypatch.setattr(collocations, "_number", lambda lang, word, seed: 5 if seed == 0 else real(lang, word, seed))
    assert found(spark.createDataFrame(ROWS[:2], DOCS)) == sorted(mined(ROWS[:2]))


def test_words_are_counted_by_language_and_not_by_text(spark, monkeypatch):
    rows = [("en", "A b. A;b\tc"), (None, "a"), ("en", "\u00c4 a\x1ca\na"), ("de", None), ("", "a \u00e4 a")]
    docs = spark.createDataFrame(rows, "lang string, text string").fillna("und", ["lang"]).coalesce(1)
    monkeypatch.setattr(collocations, "_words", None)
    got = {(r.lang, r.word): r.f for r in collocations.vocabulary(docs, 0).collect()}
    assert got == {("en", "a"): 3, ("en", "b"): 2, ("en", "c"): 1, ("en", "\u00c4"): 1, ("en", "a\x1ca"): 1, ("und", "a"): 1, ("", "a"): 2, ("", "\u00e4"): 1}
