"""N-gram Jaccard join: a token-group matrix over groups of similar documents.

A document's set holds its distinct four-word shingles; documents link at a Jaccard
similarity of 85 percent. Similar documents are partitioned into groups; each group stores
the union of its members' shingles, its row of the matrix. A query's overlap with that row
bounds its overlap with every member, so only groups that pass the bound are opened.

How it stays small, and exact:

* Documents with equal sets are one class from the start; only classes go on.
* Which cells of the matrix are looked at. By size, sets fall in classes; for the smaller
  one's class two linked sets differ in ``d`` shingles at most. Shingles are dealt by
  hash to ``d + 1 + slack`` parts, so at least ``slack + 1`` parts are equal in both. Each part
  is hashed whole: sets that share a passage seldom share a whole part, linked ones always do.
* A part that many sets have (a very common passage, or nothing) is left out where a set
  has no more than ``slack`` such parts: as many of the ``slack + 1`` equal ones are left then
  as it has fewer. Sets with more of them show these parts to each other. A set that shares
  fewer parts in all, and a query that shares fewer with a group, has no link there. So no
  link is lost and no bucket capped.
* Each bucket first tests its members against its middle, the one that shares most with
  others: a group of near copies meets there and is one component. Then only queries of
  one component against groups of another go on, one way round.
* A group is the members with one middle, split by hash into groups of some ``GROUP`` members and
  ``UNION`` shingles, so a union is bounded by a longest document. Queries stream past their
  group in tasks of some ``QUERIES``, in each of which the group stands first; texts travel,
  which compress, and are made sets again where they meet.

There is no chance in this: the result is that of comparing all pairs.

Defined results: with fewer than four words the whole sequence is the one shingle; a null or
empty text has an empty set and is linked with nothing. Rows of one doc_id are one document
as to components. A null doc_id is linked with nothing and has a null component. Other
columns play no part; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, read, written
from .minhash import Shingler, components, mix64, slices

WORDS = 4
PERCENT = 85
MANY = 64  # sets that share a part before it counts as common
GROUP = 32
UNION = 1 << 17
SMALL = 1_000_000  # class numbers that are broadcast, of 8 bytes each
QUERIES = 2000  # queries of one group that a task sees
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def size_classes(most: int) -> np.ndarray:
    """The largest size of each class, up to ``most``; linked sets are of one class or two next to each other."""
    out, begin = [], 1
    while not out or out[-1] < most:
        out.append(begin * 100 // PERCENT)
        begin = out[-1] + 1
    return np.array(out, np.int64)


def differing(largest: int) -> int:
    """The most shingles by which linked sets differ if the smaller one has ``largest`` at most."""
    return (100 - PERCENT) * (largest + largest * 100 // PERCENT) // (100 + PERCENT)


def slack_of(d: int) -> int:
    return 2 + d // 16


def parts(s: np.ndarray, d: int, family: int) -> np.ndarray:
    """The hash of each part of a sorted set; parts without a shingle too."""
    k = d + 1 + slack_of(d)
    at = ((s >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    total = np.zeros(k, np.uint64)
    np.add.at(total, at, mix64(s ^ _C))
    return mix64(total * _A + np.arange(1, k + 1, dtype=np.uint64) * _B + np.uint64(int(family + 1) * int(_C) % (1 << 64)))


def families(n: int, edges: np.ndarray) -> list[int]:
    """The classes of the smaller set under which a set of size ``n`` can meet others: its own and the one below."""
    own = int(np.searchsorted(edges, n))
    return [f for f in (own, own - 1) if f >= 0 and differing(int(edges[f])) > 0]


def plain(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, text, h``: with a hash that tells the texts of one id apart."""
    text = column(docs, text)
    return docs.select(column(docs, key).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, id, h, n, d1, d2, slacks, parts``: size and digest of each set, and slack and hashes for each family.

    ``row`` numbers the rows; it holds once they are written.
    """

    def run(batches):
        import hashlib

        from pyspark import TaskContext

        shingler, edges, row = Shingler(WORDS), size_classes(1 << 16), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingler.sets(part.column(1).to_pylist())
                longest = max(map(len, sets), default=0)
                if longest > edges[-1]:
                    edges = size_classes(longest)
                d = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), "<i8").reshape(-1, 2)
                slacks, hashes, inner, outer = [], [np.zeros(0, np.uint64)], [0], [0]
                for s in sets:
                    for family in families(len(s), edges) if len(s) else ():
                        differ = differing(int(edges[family]))
                        slacks.append(slack_of(differ))
                        hashes.append(parts(s, differ, family))
                        inner.append(inner[-1] + len(hashes[-1]))
                    outer.append(len(slacks))
                lists = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(np.concatenate(hashes).view(np.int64)))
                outer = pa.array(outer, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(row, row + len(sets)), pa.int64()), part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(d[:, 0]), pa.array(d[:, 1]), pa.ListArray.from_arrays(outer, pa.array(slacks, pa.int32())), pa.ListArray.from_arrays(outer, lists),
                    ],
                    names=["row", "id", "h", "n", "d1", "d2", "slacks", "parts"],
                )
                row += len(sets)

    return plain(docs, key, text).mapInArrow(run, "row long, id long, h long, n long, d1 long, d2 long, slacks array<int>, parts array<array<bigint>>")


def buckets(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, cf, members`` of the parts that several classes (``c, slacks, parts``) share, and ``cf, needed``.

    ``cf`` is a class with its family (0 or 1) as the last bit, ``needed`` how many of the rows
    that are given a link takes.
    """
    def of_family(what: str) -> DataFrame:
        return classes.select(F.posexplode(what).alias("family", "x"), "c").select((F.col("c") * 2 + F.col("family")).alias("cf"), "x")

    rows = of_family("parts").select("cf", F.explode("x").alias("key")).repartition("key")  # slim rows, dealt once for both sides
    members = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(rows.join(members, "key"), "ngram-shared")
    per = shared.groupBy("cf").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("members") > MANY).alias("common"))
    able = per.join(of_family("slacks").withColumnRenamed("x", "slack"), "cf").filter("all > slack").select(
        "cf", (F.col("common") > F.col("slack")).alias("shows"), F.when(F.col("common") > F.col("slack"), 1).otherwise(F.col("slack") + 1 - F.col("common")).alias("needed")
    )
    able = written(able, "ngram-able")
    left = shared.join(able, "cf").filter((F.col("members") <= MANY) | F.col("shows"))
    return written(left.select("key", "cf"), "ngram-left"), able.select("cf", "needed")


def open_buckets(left: DataFrame, label: DataFrame) -> DataFrame:
    """``key, cf, c, component, members`` of the buckets (``key, cf``) that hold more than one component."""
    rows = left.select("key", "cf", F.expr("cf div 2").alias("c")).join(label.select(F.col("id").alias("c"), "component"), "c", "left")
    rows = rows.withColumn("component", F.coalesce("component", "c"))
    keys = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"))
    return written(rows.join(keys.filter("lo < hi").select("key", "members"), "key"), "ngram-open")


def middles(left: DataFrame) -> DataFrame:
    """``key, middle, mass``: of each bucket the class that shares most with others."""
    mass = left.groupBy("c").agg(F.sum("members").alias("mass"))
    rows = written(left.select("key", "c").join(mass, "c"), "ngram-mass")
    most = rows.groupBy("key").agg(F.max("mass").alias("most"))
    return rows.join(most, "key").filter("mass = most").groupBy("key").agg(F.min("c").alias("middle"), F.max("mass").alias("mass"))


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """The number of common members of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def dealt(cells: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries ``c, component, g, salt`` and members alike: a group with many queries comes in several copies."""
    copies = cells.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("long").alias("k"))
    queries = cells.join(copies, "g").select("c", "component", "g", F.pmod(F.xxhash64("c"), F.col("k")).alias("salt"))
    members = groups.join(copies, "g").select("c", "component", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("salt"))
    return written(queries, "ngram-queries"), written(members, "ngram-members")


def opened(cells: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` of queries (``c, component, g``) with members of other components of their groups (``c, component, g``).

    In the stream of a task a group's members come before its queries: they make its row of
    the matrix, the union. A query whose overlap with the union leaves room for a link opens
    the group and is compared with its members.
    """
    queries, members = dealt(cells, groups)
    rows = [df.withColumn("role", F.lit(role)).join(texts, "c").select("g", "salt", "role", "c", "component", "text") for role, df in enumerate((members, queries))]
    stream = rows[0].unionByName(rows[1]).repartition("g", "salt").sortWithinPartitions("g", "salt", "role")

    def run(batches):
        shingler, now = Shingler(WORDS), None
        held: list = []
        for batch in batches:
            for part in slices(batch, 5):
                links: list[tuple[int, int]] = []
                g, salt, role, c, component = (part.column(i).to_pylist() for i in range(5))
                for k, x in enumerate(shingler.sets(part.column(5).to_pylist())):
                    if (g[k], salt[k]) != now:
                        now, held, union, least = (g[k], salt[k]), [], None, 0
                    if role[k] == 0:
                        held.append((c[k], component[k], x))
                        continue
                    if union is None:
                        union, least = np.unique(np.concatenate([m for _, _, m in held])), min(len(m) for _, _, m in held)
                    smallest = max(least, -(-PERCENT * len(x) // 100))  # no smaller partner links
                    if (100 + PERCENT) * overlap(x, union) < PERCENT * (len(x) + smallest):
                        continue
                    for member, other, y in held:
                        if other != component[k] and 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)):
                            common = overlap(x, y)
                            if 100 * common >= PERCENT * (len(x) + len(y) - common):
                                links.append((c[k], member))
                yield pa.RecordBatch.from_arrays([pa.array([link[i] for link in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return stream.mapInArrow(run, "a long, b long")


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components after new links; components meet by their roots."""
    top = lambda c, to: label.select(F.col("id").alias(c), F.col("component").alias(to))
    new = links.join(top("a", "ta"), "a", "left").join(top("b", "tb"), "b", "left").select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b"))
    return components(label.select(F.col("id").alias("a"), F.col("component").alias("b")).union(new))


def cells_of(rest: DataFrame, groups: DataFrame, needed: DataFrame) -> DataFrame:
    """``c, component, g``: queries and the groups of other components that share enough parts with them, one way round."""
    held = rest.join(groups.select("c", "g"), "c").groupBy("key", "g").agg(F.min("component").alias("lo"))
    met = rest.join(held, "key").filter("component > lo").groupBy("cf", "c", "component", "g").agg(F.count(F.lit(1)).alias("n"))
    return met.join(needed, "cf").filter("n >= needed").select("c", "component", "g").distinct()


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` for every row of ``docs``."""
    found = written(sketches(docs, key, text), "ngram-sketch")
    able = found.filter("id IS NOT NULL AND n > 0")
    classes = written(able.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.min("row").alias("c")), "ngram-classes")

    # A doc_id that comes with several sets ties their classes.
    member = able.select("id", "d1", "d2").join(classes.select("d1", "d2", "c"), ["d1", "d2"]).select("id", "c")
    ties = member.groupBy("id").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a < b").select("id", "a")
    label = components(written(member.join(ties, "id").select("a", F.col("c").alias("b")).distinct(), "ngram-ties"))

    own = classes.select("c")
    own = F.broadcast(own) if classes.count() <= SMALL else own
    reps = able.join(own, F.col("row") == F.col("c"))
    shared, needed = buckets(reps.select("c", "slacks", "parts"))
    left = open_buckets(shared, label)
    if not left.isEmpty():
        here = written(reps.select("c", F.col("id").alias("rep"), F.col("h").alias("rep_h"), "n").join(left.select("c").distinct(), "c"), "ngram-here")
        texts = plain(docs, key, text).join(here, (F.col("id") == F.col("rep")) & (F.col("h") == F.col("rep_h"))).select("c", "text")
        if not able.groupBy("id", "h").count().filter("count > 1").isEmpty():
            texts = texts.dropDuplicates(["c"])  # repeated rows
        texts = written(texts, "ngram-texts")
        led = written(_led(left), "ngram-led")
        cells = led.filter("c <> g").select("c", "component", "g")
        heads = cells.select("g").distinct().join(led.select(F.col("c").alias("g"), "component"), "g").select(F.col("g").alias("c"), "component", "g")
        label = _joined(label, written(opened(cells, heads, texts), "ngram-links"))
        rest = open_buckets(left, label)
        if not rest.isEmpty():
            groups = written(_groups(led, rest, here), "ngram-groups")
            cells = written(cells_of(rest, groups, needed), "ngram-cells")
            label = _joined(label, written(opened(cells, groups, texts), "ngram-links"))

    of_class = classes.join(label.select(F.col("id").alias("c"), "component"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    smallest = of_class.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = of_class.join(smallest, "component").select("d1", "d2", "component_id")
    return found.select("id", "n", "d1", "d2").join(of_class, ["d1", "d2"], "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))).alias("component_id"),
    )


def _led(left: DataFrame) -> DataFrame:
    """``c, component, g``: each class with the middle of most weight among those of its buckets."""
    at = written(left.join(middles(left), "key").select("c", "component", "middle", "mass").distinct(), "ngram-middles")
    most = at.groupBy("c").agg(F.max("mass").alias("mass"))
    return at.join(most, ["c", "mass"]).groupBy("c", "component").agg(F.min("middle").alias("g"))


def _groups(led: DataFrame, rest: DataFrame, sizes: DataFrame) -> DataFrame:
    """``g, c, component``: the classes of the rest by their middle, split by hash into groups of bounded size."""
    here = rest.select("c", "component").distinct().join(led.select("c", F.col("g").alias("middle")), "c").join(sizes.select("c", "n"), "c")
    split = here.groupBy("middle").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("n") / UNION)).cast("long").alias("k"))
    group = F.concat_ws("-", F.col("middle").cast("string"), F.pmod(F.xxhash64("c"), F.col("k")).cast("string"))
    return here.join(split, "middle").select(group.alias("g"), "c", "component")


def op12_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
