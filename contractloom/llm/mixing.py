"""Mixing sources to target weights: systematic sampling, in DataFrame functions only.

Every document of a source is expected in as many copies as the target of the source
has sizes of it. The prefix sums of the expected copies within the source, plus one
random offset, cross whole numbers; a document comes once for each one crossed. Rows
stand in order of size, half of them (by hash) up and then the other half down, which
spreads the copies evenly over short and long documents: what the offset adds on the
way up it takes away on the way down.

No source is gathered: rows are counted by source, class and block, the counts are
prefix-summed (a source has as many of them as classes and blocks, not as rows), and
rows are numbered within their block only. Blocks grow in number with the table.

Defined results: a null text has size 0; null is a source of its own, the last one. A
source without words has target 0. Repeated rows are sampled each for itself; their
order among each other makes no difference to the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, column, fresh_name, read, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2.0
SEED = "mix-1"
BLOCK_ROWS = 100_000  # rows to a pair of blocks, one for either side


def targets(sizes: DataFrame, share: float = SHARE, ceiling: float = CEILING, weights=WEIGHTS) -> DataFrame:
    """``source, source_size`` (a row a source) with ``target``.

    Weights repeat in the order of the sources. A source stops at ``ceiling`` times its
    size; the level that the others reach by weight is where the whole share is given out:
    sources in order of ceiling to weight stop as long as that level lies above them. The
    first level below its source's stop is the one, and the largest of those that are.
    """
    every = Window.orderBy(F.col("source").isNull(), F.col("source"))
    stops = Window.orderBy("_at", "_rank")
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    after = stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    ranked = (
        sizes.withColumn("_rank", F.row_number().over(every))
        .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(ceiling))
        .withColumn("_at", F.col("_cap") / F.col("_w"))
        .withColumn("_all", F.sum("source_size").over(whole) * F.lit(share))
    )
    level = (
        ranked.withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.sum("_w").over(after))
        .withColumn("_level", F.when(F.col("_level") < F.col("_at"), F.col("_level")))
        .withColumn("_level", F.max("_level").over(whole))
    )
    reach = F.col("_w") * F.col("_level")
    return level.select(
        "source", "source_size",
        F.when(F.col("_level").isNull() | (F.col("_at") <= F.col("_level")), F.col("_cap")).otherwise(reach).alias("target"),
    )


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
        share: float = SHARE, ceiling: float = CEILING, weights=WEIGHTS, seed: str = SEED) -> DataFrame:
    """Every row: ``key, source, size, source_size, target, copies, taken``."""
    sized = written(
        docs.select(
            column(docs, key).alias("key"), column(docs, source).alias("source"),
            F.coalesce(F.regexp_count(column(docs, text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    return _copies(sized, share, ceiling, weights, seed)


def _copies(sized: DataFrame, share, ceiling, weights, seed) -> DataFrame:
    rows = sized.count()
    blocks = 2 * (1 + rows // BLOCK_ROWS)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("size"))
    block = F.conv(F.substring(F.md5(named), 1, 12), 16, 10).cast("long") % blocks
    octave = F.length(F.bin(F.col("size") + 1))  # a size class is a quarter of an octave
    quarter = F.expr("shiftright(shiftleft(size + 1, 2), length(bin(size + 1)) - 1) & 3")
    placed = sized.select("*", block.alias("block"), (block % 2).alias("down"), (octave * 4 + quarter).alias("class"))
    placed = placed.withColumn("class", F.when(F.col("down") == 1, -F.col("class")).otherwise(F.col("class")))
    counts = placed.groupBy("source", "down", "class", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("down", "class", "block").rowsBetween(Window.unboundedPreceding, -1)
    goal = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), share, ceiling, weights)
    offset = F.conv(F.substring(F.sha2(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))), 256), 1, 12), 16, 10).cast("double") / float(1 << 48)
    base = (
        counts.withColumn("_before", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .withColumnsRenamed({"source": "_source"})
        .join(goal, F.col("_source").eqNullSafe(F.col("source")))
        .select(
            F.col("source").alias("_source"), F.col("class").alias("_class"), F.col("block").alias("_block"), "_before", "source_size", "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"), offset.alias("_offset"),
        )
    )
    size = F.when(F.col("down") == 1, -F.col("size")).otherwise(F.col("size"))
    inside = Window.partitionBy("source", "class", "block").orderBy(size, "key")
    edge = lambda n: F.floor(n * F.col("_rate") + F.col("_offset"))
    return (
        placed.withColumn("_n", F.row_number().over(inside))
        .join(base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class")) & (F.col("block") == F.col("_block")))
        .withColumn("_n", F.col("_n") + F.col("_before"))
        .withColumn("copies", edge(F.col("_n")) - edge(F.col("_n") - 1))
        .select("key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def sample(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows of one key, source and size are alike to the sampling; their copies are summed
    and dealt out among them by number, so that repeated keys lose and gain nothing.
    """
    chosen = mix(docs, source, key, text, **options)
    hits = chosen.groupBy("key", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    names = {n: fresh_name(docs, n) for n in ("_key", "_source", "_size", "_copies", "_rows", "_copy", "_of")}
    hits = hits.filter("copies > 0").select(
        F.col("key").alias(names["_key"]), F.col("source").alias(names["_source"]), F.col("size").alias(names["_of"]),
        F.col("copies").alias(names["_copies"]), F.col("rows").alias(names["_rows"]),
    )
    sized = docs.withColumn(names["_size"], F.coalesce(F.regexp_count(column(docs, text), F.lit(WORD)), F.lit(0)).cast("long"))
    found = sized.join(
        hits,
        column(docs, key).eqNullSafe(F.col(names["_key"])) & column(docs, source).eqNullSafe(F.col(names["_source"]))
        & (F.col(names["_size"]) == F.col(names["_of"])),
    )
    # Rows alike share their copies: the first ones have one more where these don't divide.
    alike = Window.partitionBy(names["_key"], names["_source"], names["_of"]).orderBy(column(docs, text))
    single, several = found.filter(F.col(names["_rows"]) == 1), found.filter(F.col(names["_rows"]) > 1)
    share = F.floor(F.col(names["_copies"]) / F.col(names["_rows"]))
    extra = F.col(names["_copies"]) - share * F.col(names["_rows"])
    several = several.withColumn(names["_copies"], share + F.when(F.row_number().over(alike) <= extra, 1).otherwise(0)).filter(F.col(names["_copies"]) > 0)
    both = single.unionByName(several)
    return both.withColumn(names["_copy"], F.explode(F.sequence(F.lit(1), F.col(names["_copies"]).cast("int")))).select(*[column(docs, c) for c in docs.columns])


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "copies")
