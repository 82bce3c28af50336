"""MinHash near-dedup: HyperMinHash.

A document's set holds its distinct five-word shingles. One 64-bit hash deals the
shingles to buckets; each bucket keeps the smallest second hash as a register of 16
bits: the count of leading zeros and ten mantissa bits. Empty buckets take the register
of an occupied one, chosen by a fixed random priority, so short sets stay comparable.
Bands of five registers bring candidates together; the Jaccard estimate of a pair,
corrected for registers that agree by chance, screens them; the full sets decide.

How it stays whole and small:

* Documents with equal sets are one class from the start; only classes go on.
* A band's bucket never makes its pairs. It tests its members against one of them, the one
  that shares most buckets with others, so a group of copies meets in its middle. Links
  join into components; a bucket of one component is done.
* What is left of other buckets is tested by pairs where it is a dozen or fewer. Larger
  rests go to an exact join that needs no luck: shingles in order of rarity, a linked
  pair must share one among the rarest of both (as many as their sizes allow to
  differ). Pairs within a component are left out. So no pair that could still join two
  components is lost, and no bucket or partner is capped.
* Components are a loop of joins and aggregates on tables in the shared folder; only
  counts come to the driver.

With 64 bands of five registers a pair of similarity 0.75 is missed with a chance of
3e-8, a more similar one with less. The screen lets pass whatever is not six standard
deviations below the threshold.

Defined results: with fewer than five words the whole sequence is the one shingle; a
null or empty text has an empty set and is linked with nothing. Rows of one doc_id are
one document as to components. A null doc_id is linked with nothing, has a null
component and is kept. Other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, fresh_name, read, written

WORDS = 5
PERCENT = 75
BANDS, ROWS = 64, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
CLASS = 1.1  # ratio of the sizes of a class in the exact join
FEW = 12  # members of a bucket whose pairs are tested as they are; larger ones go to the exact join
SPREAD = math.ceil(math.log(100 / PERCENT) / math.log(CLASS))
DEVIATIONS = 6.0
SLICE_BYTES = 2 << 20
CACHE = 300_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_P = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of texts."""

    def __init__(self, size: int = WORDS):
        self.known: dict[bytes, int] = {}
        self.size = size

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        import xxhash

        words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]  # bytes.lower: A-Z only
        if len(self.known) > CACHE:
            self.known = {}
        known = self.known
        for w in {w for ws in words for w in ws}.difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        lengths = [len(ws) for ws in words]
        h = np.fromiter((known[w] for ws in words for w in ws), np.uint64, sum(lengths))
        size = self.size
        if len(h) >= size:
            n = len(h) - size + 1
            windows = h[:n].copy()
            for k in range(1, size):
                windows = windows * _P + h[k : k + n]
            windows = mix64(windows)
        out, at = [], 0
        for length in lengths:
            if length >= size:
                s = np.sort(windows[at : at + length - size + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif length:
                whole = np.uint64(length)
                with np.errstate(over="ignore"):
                    for x in h[at : at + length]:
                        whole = whole * _M3 + x
                out.append(mix64(np.array([whole])))
            else:
                out.append(np.zeros(0, np.uint64))
            at += length
        return out


def _priorities() -> np.ndarray:
    return np.random.default_rng(20).permuted(np.tile(np.arange(REGISTERS, dtype=np.uint16), (REGISTERS, 1)), axis=1)


def registers(s: np.ndarray, priorities: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of each bucket's smallest hash; of another's where it is empty."""
    bucket = ((s >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket, mix64(s * _M3 + _P))
    full = np.zeros(REGISTERS, bool)
    full[bucket] = True
    hi = np.maximum(least >> np.uint64(12), np.uint64(1)).astype(np.float64)  # 52 bits: exact as a double
    exponent = np.frexp(hi)[1]  # hi in [2^(exponent-1), 2^exponent)
    zeros = 52 - exponent
    mantissa = np.ldexp(hi, MANTISSA + 1 - exponent).astype(np.int64) & ((1 << MANTISSA) - 1)
    out = (zeros.astype(np.int64) << MANTISSA | mantissa).astype(np.uint16)
    if not full.all():
        there, empty = np.flatnonzero(full), np.flatnonzero(~full)
        out[empty] = out[there[priorities[np.ix_(empty, there)].argmin(1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of ``regs``."""
    r = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _M3 + np.zeros((len(regs), 1), np.uint64)
    for k in range(ROWS):
        key = mix64(key * _P + r[:, :, k])
    return key.view(np.int64)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The chance that registers of unrelated sets of sizes ``a`` and ``b`` agree."""
    k = np.arange(53)

    def zeros(n):
        load = np.maximum(n, 1)[:, None] / REGISTERS
        full = 1 - np.exp(-load)
        return (np.exp(-load * 0.5 ** (k + 1)) - np.exp(-load * 0.5**k)) / full

    return (zeros(a) * zeros(b)).sum(1) / (1 << MANTISSA)


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity by the share of equal registers, corrected for chance."""
    same, c = (ra == rb).mean(1), chance(na, nb)
    return (same - c) / (1 - c)


def screened(ra, rb, na, nb) -> np.ndarray:
    """False only where the estimate is far below the threshold for so many distinct registers."""
    goal = PERCENT / 100
    effective = np.minimum(REGISTERS, np.maximum(na, nb)).astype(float)
    return estimate(ra, rb, na, nb) >= goal - DEVIATIONS * np.sqrt(goal * (1 - goal) / np.maximum(effective, 1)) - 1 / REGISTERS


def slices(batch: pa.RecordBatch, at: int):
    import pyarrow.compute as pc

    begin, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _digest(s: np.ndarray) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, n, d1, d2, regs``: size, 128-bit digest and registers of each document's set."""

    def run(batches):
        import hashlib

        shingler, priorities = Shingler(), _priorities()
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingler.sets(part.column(1).to_pylist())
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                d = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]),
                        pa.array([registers(s, priorities).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["id", "n", "d1", "d2", "regs"],
                )

    plain = docs.select(column(docs, key).cast("long").alias("id"), column(docs, text).alias("text"))
    return plain.mapInArrow(run, "id long, n long, d1 long, d2 long, regs binary")


def bands(reps: DataFrame) -> DataFrame:
    """``key, id, component`` for each band of each representative (``id, regs, component``)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                keys = band_keys(regs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), *(pa.array(np.repeat(batch.column(i).to_numpy(), BANDS)) for i in (0, 2))],
                    names=["key", "id", "component"],
                )

    return reps.select("id", "regs", "component").mapInArrow(run, "key long, id long, component long")


def screen(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose estimate does not rule out a link."""
    one = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    two = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    # A pair of documents with several sets each (a repeated doc_id) comes once for each of them.
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ra", "rb")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                regs = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5)]
                sizes = [batch.column(i).to_numpy() for i in (2, 3)]
                keep = screened(*regs, *sizes)
                yield batch.filter(pa.array(keep)).select(["a", "b"])

    return full.mapInArrow(run, "a long, b long").distinct()


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs linked by their full sets. ``texts``: ``id, text`` of all ids in ``pairs``."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()

    def to_sets(batches):
        shingler = Shingler()
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingler.sets(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([_digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "h", "s"])

    sets = texts.join(needed, "id", "left_semi").mapInArrow(to_sets, "id long, h long, s binary")
    sets = written(sets.repartition("id").dropDuplicates(["id", "h"]).select("id", "s"), "minhash-sets")  # repeated rows once

    def linked(batches):
        for batch in batches:
            keep = []
            for sa, sb in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(sa.as_buffer(), np.uint64)
                y = np.frombuffer(sb.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    both = (
        pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
        .select("a", "b", "sa", "sb")
    )
    return both.mapInArrow(linked, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every end of the edges ``a, b``: the smallest id reachable.

    Large-star and small-star steps by turns, until every end hangs on a root of its
    own. Each links neighbours to the smallest one by an aggregate and a join.
    """
    edges = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "minhash-edges"
    )
    while True:
        # Stars already: no end has two roots, and no root is an end.
        ends = edges.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        if ends.filter("lo < hi").isEmpty() and edges.select(F.col("v").alias("u")).join(edges, "u", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u <> v").distinct(), "minhash-edges")


def _open(left: DataFrame) -> DataFrame:
    """``key, id, component, members`` of the buckets that hold more than one component."""
    keys = left.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"))
    return written(left.join(keys.filter("lo < hi").select("key", "members"), "key").select("key", "id", "component", "members"), "minhash-open")


def _class(n: str) -> Column:
    """The class of a size; sizes that a link allows are at most ``SPREAD`` classes apart."""
    return F.floor(F.log(n) / math.log(CLASS)).cast("int")


def _matched(left: DataFrame, reps: DataFrame) -> DataFrame:
    """``id, component`` of the members of buckets that meet another component of a size they could link with."""
    size = reps.select("id", "n").distinct()
    rows = left.select("key", "id", "component").join(size, "id").withColumn("own", _class("n"))
    # One row for each bucket and class of sizes, however many members it has.
    held = rows.groupBy("key", "own").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    near = held.select("key", "lo", "hi", F.explode(F.sequence(F.col("own") - SPREAD, F.col("own") + SPREAD)).alias("own"))
    near = near.groupBy("key", "own").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return rows.join(near, ["key", "own"]).filter("lo <> component OR hi <> component").select("id", "component").distinct()


def few_pairs(left: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs of different components, of sizes that could link, in buckets of ``FEW`` members at most."""
    rows = left.select("key", "id", "component").join(reps.select("id", "n").distinct(), "id")
    one, two = (rows.select(*[F.col(c).alias(f"{c}{k}") for c in ("key", "id", "component", "n")]) for k in "ab")
    near = (F.col("keya") == F.col("keyb")) & F.expr(
        f"ida < idb AND componenta <> componentb AND 100 * na >= {PERCENT} * nb AND 100 * nb >= {PERCENT} * na"
    )
    return one.join(two, near).select(F.col("ida").alias("a"), F.col("idb").alias("b"))


def middle_pairs(left: DataFrame) -> DataFrame:
    """Pairs of each bucket's middle, its member with most neighbours in all buckets, and its other members."""
    mass = left.groupBy("id").agg(F.sum("members").alias("mass"))
    rows = written(left.join(mass, "id"), "minhash-mass")
    most = rows.groupBy("key").agg(F.max("mass").alias("most"))
    middle = rows.join(most, "key").filter("mass = most").groupBy("key").agg(F.min("id").alias("c"))
    root = rows.select(F.col("id").alias("c"), F.col("component").alias("root")).distinct()
    pairs = rows.join(middle.join(root, "c"), "key").filter("component <> root")
    return pairs.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()


def rare_pairs(texts: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs of different components that may be linked, by their rarest shingles.

    Sets of sizes m and n are linked if they share t = 3/7 (m + n) shingles or more. Then,
    in any common order, the first m - t + 1 of the one and n - t + 1 of the other share
    one. The order is by rarity among ``members``; t is taken for the smallest size of
    the partner's class, so each row's count serves all partners of the class. How far along
    both orders a shared shingle stands bounds how much the sets can share.
    """

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingler.sets(part.column(1).to_pylist())
                n = np.array([len(s) for s in sets], np.int64)
                shingle = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                which = np.array([_digest(s) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(0).to_numpy(), n)), pa.array(np.repeat(n, n)), pa.array(np.repeat(which, n)), pa.array(shingle)],
                    names=["id", "n", "d", "s"],
                )

    # An id may come with several sets, even of one size: each is ranked by itself.
    rows = texts.join(members.select("id"), "id", "left_semi").mapInArrow(run, "id long, n long, d long, s long")
    rows = written(rows, "minhash-shingles")
    rarity = rows.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("id", "n", "d").orderBy("df", "s"))  # a set's own shingles
    # No prefix is longer than for a partner of the smallest size; a shingle of one set alone is never shared.
    ranked = rows.join(rarity, "s").withColumn("place", place).filter(f"df > 1 AND place <= ceil(n * {100 - PERCENT} / 100D) + 4")
    other = ranked.withColumn("own", _class("n")).withColumn("other", F.explode(F.sequence(F.col("own") - SPREAD, F.col("own") + SPREAD)))
    # One less than the class begins with, for logarithms that round to the other side.
    least = F.greatest(F.floor(F.pow(F.lit(CLASS), F.col("other"))) - 1, F.ceil(F.col("n") * PERCENT / 100) - 1, F.lit(1))
    share = F.ceil((F.col("n") + least) * PERCENT / (100 + PERCENT) - 1e-9)
    length = F.col("n") - share + 1
    # Slim rows: a shingle of a beginning and its place. What a pair shares is at most this one and what is behind it
    # in the shorter rest; a linked pair passes at the first shingle that both beginnings have.
    starts = written(
        other.withColumn("length", length).filter("place <= length").select("id", "n", "own", "other", "place", "s").join(members, "id"), "minhash-rare"
    )
    one, two = (starts.select(*[F.col(c).alias(f"{c}{k}") for c in ("s", "id", "component", "n", "own", "other", "place")]) for k in "ab")
    near = (F.col("sa") == F.col("sb")) & F.expr(
        "owna = otherb AND othera = ownb AND ida < idb AND componenta <> componentb"
        f" AND 100 * na >= {PERCENT} * nb AND 100 * nb >= {PERCENT} * na"
        f" AND {100 + PERCENT} * (1 + least(na - placea, nb - placeb)) >= {PERCENT} * (na + nb)"
    )
    return one.join(two, near).select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def _joined(label: DataFrame, pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The components after the links among ``pairs``."""
    size = reps.groupBy("id").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    two = pairs.join(size.select(F.col("id").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi")), "a").alias("p").join(
        size.select(F.col("id").alias("c"), F.col("lo").alias("blo"), F.col("hi").alias("bhi")),
        F.expr(f"p.b = c AND 100 * bhi >= {PERCENT} * alo AND 100 * ahi >= {PERCENT} * blo"),
    )
    likely = written(screen(two.select("a", "b"), reps), "minhash-pairs")
    if likely.isEmpty():
        return label
    links = written(confirm(likely, texts), "minhash-links")
    if links.isEmpty():
        return label
    # Components meet by their roots, so edges stay as few as the components that grow.
    top = lambda c, to: label.select(F.col("id").alias(c), F.col("component").alias(to))
    new = links.join(top("a", "ta"), "a", "left").join(top("b", "tb"), "b", "left").select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b"))
    return components(label.select(F.col("id").alias("a"), F.col("component").alias("b")).union(new))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``."""
    found = written(sketches(docs, key, text), "minhash-sketch")
    able = found.filter("id IS NOT NULL AND n > 0")
    classes = able.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("members"))
    classes = written(classes, "minhash-classes")
    reps = (
        able.join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).filter("id = rep")
        .dropDuplicates(["d1", "d2"]).select("d1", "d2", "id", "n", "regs")
    )
    reps = written(reps, "minhash-reps")

    # A doc_id that comes with several sets ties their classes.
    member = able.select("id", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("id", "rep")
    several = member.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("id")
    ties = written(
        member.join(several, "id", "left_semi").filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), "minhash-ties"
    )

    label = components(ties)
    left = _open(bands(reps.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))))
    if not left.isEmpty():
        plain = docs.select(column(docs, key).cast("long").alias("id"), column(docs, text).alias("text"))
        texts = plain.join(left.select("id").distinct(), "id", "left_semi").dropDuplicates(["id", "text"])
        texts = written(texts, "minhash-texts")  # of all that share a bucket
        reps = written(reps.join(left.select("id").distinct(), "id", "left_semi"), "minhash-near")
        label = _joined(label, middle_pairs(left), reps, texts)
        rest = _open(left.select("key", "id").join(label, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")))
        if not rest.isEmpty():
            many = written(_matched(rest.filter(F.col("members") > FEW), reps), "minhash-rest")
            pairs = few_pairs(rest.filter(F.col("members") <= FEW), reps).union(rare_pairs(texts, many)).distinct()
            label = _joined(label, pairs, reps, texts)
    rep_of = classes.select("d1", "d2", "rep").join(label.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        found.select("id", "n", "d1", "d2").join(rep_of, ["d1", "d2"], "left")
        .select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("id"))).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the smallest id of each component.

    Of several rows of one such id the one with the least digest of its text stays; rows without an id all stay.
    """
    gone, kept = fresh_name(docs, "_gone"), fresh_name(docs, "_kept")
    found = near_duplicates(docs, key, text).filter(F.col("id").isNotNull())
    drop = found.filter(~F.col("kept")).select(F.col("id").alias(gone)).distinct()
    many = written(found.filter("kept").groupBy("id").count().filter("count > 1").select(F.col("id").alias(kept)), "minhash-repeats")
    left = docs.join(drop, column(docs, key) == F.col(gone), "left_anti")
    if many.isEmpty():
        return left
    single = left.join(many, column(docs, key) == F.col(kept), "left_anti")
    place = fresh_name(docs, "_place")
    first = Window.partitionBy(column(docs, key)).orderBy(F.sha2(F.coalesce(column(docs, text), F.lit("")), 256))
    repeats = left.join(many, column(docs, key) == F.col(kept), "left_semi").withColumn(place, F.row_number().over(first))
    return single.unionByName(repeats.filter(column(repeats, place) == 1).drop(place))


def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
