"""Approximate nearest neighbours: a hash-prefix forest.

Each tree orders the vectors by a long hash string, whose bits are the sides of random
hyperplanes; the strings are kept in a sorted array. A query descends in every tree to
its longest prefix match by binary search, and then ascends in all trees at once, a bit
at a time, until the vectors under its prefixes are enough. Those are compared exactly,
in double precision on the original vectors.

The largest inner product is searched: for the hash only, stored vectors are brought to one
length by a further component, which is 0 in a query, so that the nearest by angle are
those of the largest product. A block is parted into bands of lengths that differ by
``BAND`` at most, each with arrays of its own: so the further component stays small and short
vectors do not blur the order of long ones.

Vectors are in blocks of bounded size, each with a forest of its own, and queries in
blocks as well; every block of queries visits every block of vectors, and each task
holds one pair. Of each query and block only the best go on, and the best of all blocks
are chosen by rank, limited before the shuffle. Equal vectors stand once in the index
with the ids that could be among the results, so a vector that a third of all rows
repeat is one entry.

Defined results: vectors that are null, of no or differing length, zero, or that hold
null or non-finite components take no part, neither as query nor as candidate; rows with
a null id neither. Ties go to the smaller id. Rows of one id and vector count once; an id
with several vectors is as many candidates, and may take as many ranks. An empty table
gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, read, written

TREES = 128
BITS = 32
NEIGHBOURS = 20
VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024
SHARE = 0.8  # of a block's vectors, counted in all trees, that end the ascent
BAND = 1.25
SEED = 11


def planes(dims: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims + 1, trees * bits))


def hash_strings(x: np.ndarray, longest: float, normals: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """The hash string of each vector in each tree, its first bit the highest; ``longest`` is 0 for queries."""
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0.0))
    out = np.empty((len(x), trees), np.uint32)
    weights = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)).astype(np.float64)
    for lo in range(0, len(x), 1024):
        side = np.column_stack([x[lo : lo + 1024], rest[lo : lo + 1024]]) @ normals > 0
        out[lo : lo + 1024] = (side.reshape(-1, trees, bits) @ weights).astype(np.uint32)
    return out


class Forest:
    """The sorted arrays of one block of vectors."""

    def __init__(self, vectors: np.ndarray, longest: float, normals: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.vectors, self.bits, self.trees = vectors, bits, trees
        strings = hash_strings(vectors, longest, normals, trees, bits)
        self.order = np.argsort(strings, axis=0, kind="stable").astype(np.int32)
        self.sorted = [strings[self.order[:, t], t].astype(np.uint64) for t in range(trees)]

    def ranges(self, strings: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, the range of the sorted array where the ascent ends."""
        n, trees = strings.shape
        lo = np.zeros((n, trees), np.int64)
        hi = np.full((n, trees), len(self.vectors), np.int64)
        open_ = np.ones(n, bool)
        for depth in range(self.bits, -1, -1):  # from whole strings upward, all trees in step
            at = np.flatnonzero(open_)
            if not len(at):
                break
            width = np.uint64(self.bits - depth)
            first = strings[at].astype(np.uint64) >> width << width
            after = first + (np.uint64(1) << width)
            for t in range(trees):
                lo[at, t] = np.searchsorted(self.sorted[t], first[:, t], "left")
                hi[at, t] = np.searchsorted(self.sorted[t], after[:, t], "left")
            open_[at[(hi[at] - lo[at]).sum(1) >= enough]] = False
        return lo, hi

    def search(self, queries: np.ndarray, normals: np.ndarray, share: float, least: int):
        """The candidates of each query, as row numbers of the block.

        The ascent ends with ``share`` of the block's size, counted over all trees, besides
        one entry a tree, which the query itself may be. With fewer than ``least``
        vectors by then it goes on to the roots.
        """
        strings = hash_strings(queries, 0.0, normals, self.trees, self.bits)
        lo, hi = self.ranges(strings, self.trees + int(share * len(self.vectors)))
        for q in range(len(queries)):
            seen = np.zeros(len(self.vectors), bool)
            for t in range(self.trees):
                if hi[q, t] > lo[q, t]:
                    seen[self.order[lo[q, t] : hi[q, t], t]] = True
            found = np.flatnonzero(seen)
            yield found if len(found) >= least else np.arange(len(self.vectors))


class Bands:
    """The forests of one block, by length of its vectors."""

    def __init__(self, vectors: np.ndarray, normals: np.ndarray, trees: int = TREES, bits: int = BITS):
        largest = np.abs(vectors).max(1)
        length = largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))
        band = np.floor((np.log(length) - np.log(length.min())) / np.log(BAND) + 1e-9).astype(int)
        self.rows = [np.flatnonzero(band == b) for b in np.unique(band)]
        # Sides of planes do not change with the scale, so the longest of a band is taken for 1.
        self.forests = [Forest(vectors[r] / length[r].max(), 1.0, normals, trees, bits) for r in self.rows]

    def search(self, queries: np.ndarray, normals: np.ndarray, share: float, least: int):
        """The candidates of each query in all bands, as row numbers of the block."""
        for found in zip(*(f.search(queries, normals, share, least) for f in self.forests)):
            yield np.concatenate([rows[at] for rows, at in zip(self.rows, found)])


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = NEIGHBOURS,
            share: float = SHARE, trees: int = TREES, bits: int = BITS, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, id, score`` for the queries, the rows whose key ``every`` divides."""
    v = F.col("v")
    sound = rows.select(column(rows, key).cast("long").alias("id"), column(rows, vector).cast("array<double>").alias("v"))
    sound = sound.filter(
        F.col("id").isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    dims = sound.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not dims:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    dims = dims[0]["d"]
    sound = sound.filter(F.size(v) == dims)
    # Equal vectors: one entry with the smallest k + 1 ids, which no result can go beyond.
    place = Window.partitionBy("v").orderBy("id")
    few = sound.distinct().withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = written(classes, "forest-vectors")
    total = classes.count()
    blocks = max(1, -(-total // vector_block))
    asked = written(sound.filter(F.col("id") % every == 0).distinct(), "forest-queries")
    parts = max(1, -(-asked.count() // query_block))
    lead = F.element_at("ids", 1)
    points = classes.select(
        F.pmod(F.xxhash64(lead), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "v", "ids"
    )
    askers = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "v"
    )

    def pair(points_: pa.Table, askers_: pa.Table) -> pa.Table:
        names = ["query_id", "id", "score"]
        matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        if not points_.num_rows or not askers_.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.int64(), pa.float64())], names)
        x, q = matrix(points_), matrix(askers_)
        normals = planes(dims, trees, bits)
        forest = Bands(x, normals, trees, bits)
        ids = points_.column("ids").to_pylist()
        lead = np.array([i[0] for i in ids])
        out = [[], [], []]
        asker = askers_.column("id").to_pylist()
        for n, found in enumerate(forest.search(q, normals, share, k + 1)):
            score = exact(x[found], q[n])
            if len(found) > k + 1:  # enough entries for k ids besides the query's own, with all ties
                cut = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                near = score >= cut
                found, score = found[near], score[near]
            best = np.lexsort((lead[found], -score))
            hits = []
            for j in best:
                if len(hits) >= k and score[j] < hits[k - 1][0]:
                    break
                hits += [(score[j], i) for i in ids[found[j]] if i != asker[n]]
            for s, i in sorted(hits, key=lambda h: (-h[0], h[1]))[:k]:
                out[0].append(asker[n]), out[1].append(i), out[2].append(float(s))
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names)

    found = points.groupBy("block", "part").cogroup(askers.groupBy("block", "part")).applyInArrow(pair, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "id", "score")


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the components, so that equal vectors tie."""
    return np.add.reduce(x * q, axis=1)


def op4_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
