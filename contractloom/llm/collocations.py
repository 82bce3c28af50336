"""Phrase collocation mining by SETM: relations of occurrences, joined by piece and adjacent position.

Texts are cut into pieces at punctuation and line ends, pieces into words. The relation of
single words is persisted in order, one row a text: each word as a number, 0 where a piece
ends, so words of one piece are exactly those without a 0 between them. A word's place in
the whole relation is ``at`` plus its index.

For each length the same steps follow:

1. Occurrences of a phrase are merge-joined with the next ones by adjacent position. For two
   words both sides are the relation of words, so a task merges its own ordered rows with
   themselves one place further on; for three, Spark joins the pairs at a place with those
   at the next.
2. Groups are counted: within a batch first, so a very frequent phrase is one row a batch,
   then by a combining aggregate.
3. Occurrences of frequent groups alone (a semi-join) are persisted in order and go on. A
   phrase is as frequent as its parts at most, so nothing is lost by it.

Everything is per language, which is part of a word's number. Numbers are 64-bit hashes of
language and word; were two words to share one, all are numbered anew with another
seed, so counts are exact. Scores are made of decimals, whole and exact.

The semi-join is by broadcast only where the frequent groups are few (``SMALL`` rows of
24 bytes); else Spark shuffles both sides.

Defined results: a null text is empty, a null language is ``und`` (and shares it with such
rows). Repeated rows count each. A language without candidates gives no row, nor does an
empty table. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, read, written
from .minhash import slices

LEAST = 10  # occurrences of a candidate
TOP = 2000
COVERED = 50  # percent of a phrase's occurrences that lie in a longer candidate
SMALL = 1_000_000
STEP = 1 << 20  # words that a task merges at a time, a text at least
HELD = 150_000  # words whose numbers or counts a task holds
END = b"\xff"  # ends a piece; no byte of a text in UTF-8
# A-Z to a-z, all that ends a piece to one sign.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz" + END * 10)
_SPACED = bytes.maketrans(END, b" ")


def _plain(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)


def _words(text: str | None) -> list[bytes]:
    """The words in order, with ``END`` behind each piece."""
    out = _plain(text).replace(END, b" " + END + b" ").split()
    out.append(END)
    return out


def _number(lang: bytes, word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang + b"\0" + word, seed) or 1  # 0 ends a piece


def vocabulary(docs: DataFrame, seed: int) -> DataFrame:
    """``w, lang, word, f`` of every word; words are counted by batch before the shuffle."""

    def rows(item):
        lang, count = item
        key = lang.encode("utf-8", "surrogatepass")
        numbers = np.array([_number(key, word, seed) for word in count], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(numbers), pa.array([key.decode("utf-8", "replace")] * len(count), pa.string()),
                pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64()),
            ],
            names=["w", "lang", "word", "n"],
        )

    def run(batches):
        from collections import Counter, defaultdict

        count: defaultdict = defaultdict(Counter)  # by language
        for batch in (part for whole in batches for part in slices(whole, 1)):
            texts = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts[lang].append(_plain(text))
            for lang, plain in texts.items():
                count[lang].update(b" ".join(plain).translate(_SPACED).split())
            if sum(map(len, count.values())) > HELD:
                yield from map(rows, count.items())
                count = defaultdict(Counter)
        yield from map(rows, count.items())

    return docs.mapInArrow(run, "w long, lang string, word string, n long").groupBy("w", "lang", "word").agg(F.sum("n").alias("f"))


def words_in_order(docs: DataFrame, seed: int) -> DataFrame:
    """The relation of words: ``at, ws``, one row a text, in order of ``at``."""

    def run(batches):
        from pyspark import TaskContext

        at, known = TaskContext.get().partitionId() << 40, {}  # by language: word to number
        for batch in (part for whole in batches for part in slices(whole, 1)):
            ats, ends, numbers = [], [0], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _words(text)
                of = known.setdefault(lang, {END: 0})
                if new := set(words).difference(of):
                    if sum(map(len, known.values())) > HELD:
                        known = {lang: (of := {END: 0})}
                        new = set(words) - {END}
                    key = lang.encode("utf-8", "surrogatepass")
                    of.update((word, _number(key, word, seed)) for word in new)
                numbers += map(of.__getitem__, words)
                ats.append(at)
                at += len(words)
                ends.append(len(numbers))
            flat = pa.array(np.array(numbers, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["at", "ws"])

    return docs.mapInArrow(run, "at long, ws array<long>")


def _steps(batches):
    """Rows of ``STEP`` words or so at a time."""
    for batch in batches:
        sizes = np.diff(batch.column(1).offsets.to_numpy())
        step = (np.cumsum(sizes) - sizes) // STEP
        edges = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(sizes)] if len(sizes) else []
        for a, b in zip(edges, edges[1:]):
            yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns], names=batch.schema.names)


def _merged(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, word and next word of each two adjacent words of one piece."""
    ws, starts = batch.column(1), batch.column(0).to_numpy()
    flat = ws.flatten().to_numpy()  # of the slice alone
    sizes = np.diff(ws.offsets.to_numpy())
    place = np.repeat(starts, sizes) + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # Every text ends with a 0, so words of two texts never stand side by side.
    both = np.flatnonzero((flat[:-1] != 0) & (flat[1:] != 0)) if len(flat) else np.zeros(0, np.int64)
    return place[both], flat[both], flat[both + 1]


def pair_counts(relation: DataFrame) -> DataFrame:
    """``a, b, f`` of all pairs that occur ``LEAST`` times or more."""

    def run(batches):
        for batch in _steps(batches):
            _, a, b = _merged(batch)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(a)))
            yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(n)], names=["a", "b", "n"])

    counted = relation.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("f"))
    return counted.filter(F.col("f") >= LEAST)


def pairs_in_order(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """The relation of frequent pairs: ``at, p``."""

    def run(batches):
        for batch in _steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(batch)], names=["at", "a", "b"])

    ids = frequent.select("p", "a", "b")
    if frequent.count() <= SMALL:
        ids = F.broadcast(ids)
    return relation.mapInArrow(run, "at long, a long, b long").join(ids, ["a", "b"]).select("at", "p")


def triple_counts(pairs: DataFrame) -> DataFrame:
    """``p, q, f``: pairs that overlap in a word, ``LEAST`` times or more."""
    later = pairs.select((F.col("at") - 1).alias("at"), F.col("p").alias("q"))
    return pairs.join(later, "at").groupBy("p", "q").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= LEAST)


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)); decimals of 15 digits keep all products within 38."""
    return F.expr(
        f"CAST(1000000 AS DECIMAL(7,0)) * (CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)))"
        f" div (CAST({l} AS DECIMAL(15,0)) * CAST({r} AS DECIMAL(15,0)))"
    )


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of two and three words."""
    plain = docs.select(F.coalesce(column(docs, lang).cast("string"), F.lit("und")).alias("lang"), column(docs, text).cast("string").alias("text"))
    seed = 0
    while True:
        words = written(vocabulary(plain, seed), "setm-words")
        if words.groupBy("w").count().filter("count > 1").isEmpty():
            break
        seed += 1
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    relation = written(words_in_order(plain, seed), "setm-relation")
    counted = written(pair_counts(relation).withColumn("p", F.monotonically_increasing_id()), "setm-pairs")
    pairs = written(pairs_in_order(relation, counted).sortWithinPartitions("at"), "setm-pair-relation")
    triples = written(triple_counts(pairs), "setm-triples")

    word = lambda k: words.filter(F.col("f") >= LEAST).select(F.col("w").alias(k), F.col("word").alias(f"word_{k}"), F.col("f").alias(f"f_{k}"))
    of = words.filter(F.col("f") >= LEAST).select(F.col("w").alias("a"), "lang")
    two = written(
        counted.join(of, "a").join(word("a"), "a").join(word("b"), "b")
        .select("p", "lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), "f", "f_a", "f_b", "word_b"), "setm-two"
    )
    left = two.select("p", "lang", F.col("phrase").alias("start"), F.col("f").alias("f_p"), F.col("f_a").alias("f_first"))
    right = two.select(F.col("p").alias("q"), F.col("f").alias("f_q"), F.col("word_b").alias("end"), F.col("f_b").alias("f_last"))
    three = triples.join(left, "p").join(right, "q")

    # A pair within a longer candidate that holds half of its occurrences or more is dropped.
    longest = triples.select(F.explode(F.array("p", "q")).alias("p"), "f").groupBy("p").agg(F.max("f").alias("longer"))
    scored_two = (
        two.join(longest, "p", "left").filter(f"longer IS NULL OR 100 * longer < {COVERED} * f")
        .select("lang", "phrase", F.col("f").alias("a"), F.col("f_a").alias("l"), F.col("f_b").alias("r"), _score("f", "f_a", "f_b").alias("score"))
    )
    one, other = _score("f", "f_first", "f_q"), _score("f", "f_p", "f_last")
    scored_three = three.withColumn("one", one).withColumn("other", other).select(
        "lang", F.concat_ws(" ", "start", "end").alias("phrase"), F.col("f").alias("a"),
        F.when(F.col("one") <= F.col("other"), F.col("f_first")).otherwise(F.col("f_p")).alias("l"),
        F.when(F.col("one") <= F.col("other"), F.col("f_q")).otherwise(F.col("f_last")).alias("r"),
        F.least("one", "other").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored_two.unionByName(scored_three).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))
