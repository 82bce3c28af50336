"""Sharding: extendible hashing, in DataFrame functions only.

Rows go by the leading bits of a hash of key and text. The directory begins with the
bits that the whole would need; a bucket above the byte limit splits on one more bit, the
others stay as shallow as they can. The directory has a slot for each prefix of that
length and names its bucket; where a slot itself is too large, only its rows go on to
longer prefixes.

The sizes of slots are summed before any shuffle; only counts come to the driver. A row
larger than the limit gets a shard of its own. Rows alike in key and text have one hash
and cannot be parted by bits: at the last bit they are dealt to pages, each within
the limit, by count, not by gathering them.

Defined results: a null text has 0 bytes; null keys are hashed as such. An empty table
gives no row and an empty directory. Repeated rows are placed each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, fresh_name, read, written

LIMIT = 1 << 20  # bytes of text to a shard
BITS = 60
SPARE = 3  # bits a slot is finer than the whole would need
STEP = 12  # more bits for slots that are too large


def hash_bits(key: Column, text: Column) -> Column:
    """60 bits by key and text."""
    joined = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, have: int, bits) -> Column:
    """The first ``bits`` of a prefix of ``have`` bits."""
    return F.expr(f"shiftright({h}, {have} - {bits})") if isinstance(h, str) else F.shiftright(h, have - bits)


def assign(rows: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` (``h`` and ``bytes`` among their columns): the rows with their shard, and the directory.

    Rows get ``depth, prefix, page, shard_bytes, shard_rows``; the directory has a row a
    slot: ``bits, slot`` and its bucket's ``depth, prefix, bytes, rows``.
    """
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE)
    floor, rest = 0, rows
    placed, directory = [], []
    while True:
        rest = rest.withColumn("slot", F.shiftright("h", BITS - bits))
        slots = written(rest.groupBy("slot").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-slots")
        levels = slots.select("slot", "bytes", "rows", F.explode(F.sequence(F.lit(floor), F.lit(bits))).alias("depth"))
        at = F.expr(f"shiftright(slot, {bits} - depth)").alias("prefix")
        sums = written(
            levels.select("depth", at, "bytes", "rows").groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")), "shard-levels"
        )
        fits = (F.col("bytes") <= limit) | (F.col("rows") == 1)
        if bits == BITS:
            fits = fits | (F.col("depth") == BITS)
        split = sums.filter(~fits).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        fit = sums.filter(fits).withColumn("parent", F.shiftright("prefix", 1))
        buckets = fit.join(split, ["depth", "parent"], "left_semi").drop("parent")
        if floor == 0:
            buckets = buckets.unionByName(fit.filter("depth = 0").drop("parent"))
        found = levels.select("slot", "depth", at).join(buckets, ["depth", "prefix"])
        found = written(found.select(F.lit(bits).alias("bits"), "slot", "depth", "prefix", "bytes", "rows"), "shard-directory")
        directory.append(found)
        placed.append(rest.join(found.drop("bits").withColumnsRenamed({"bytes": "shard_bytes", "rows": "shard_rows"}), "slot").drop("slot"))
        over = sums.filter(~fits & (F.col("depth") == bits)).select(F.col("prefix").alias("slot"))
        if bits == BITS or over.isEmpty():
            break
        rest = rest.join(over, "slot", "left_semi").drop("slot")
        floor, bits = bits, min(BITS, bits + STEP)
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    slots = directory[0]
    for d in directory[1:]:
        slots = slots.unionByName(d)
    return _paged(out, limit), slots


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows with ``page``: 0 where the bucket fits, else by the count of rows alike.

    Rows alike in every column are counted and dealt out again from the count.
    """
    too_large = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    whole = rows.filter(~too_large).withColumn("page", F.lit(0).cast("long"))
    names = rows.columns
    # Rows of one full hash are alike in key and text; other columns may part them: one page each then.
    alike = rows.filter(too_large).groupBy(*[column(rows, c) for c in names]).agg(F.count(F.lit(1)).alias("_n"))
    per_page = F.greatest(F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))), F.lit(1))
    kinds = [column(rows, c) for c in names if c not in ("h", "bytes", "depth", "prefix", "shard_bytes", "shard_rows")]
    first = F.pmod(F.xxhash64(*kinds), F.lit(1 << 30)) * (1 << 20) if len(kinds) > 1 else F.lit(0)
    dealt = alike.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    dealt = dealt.withColumn("page", (first + F.floor(F.col("_i") / per_page)).cast("long")).drop("_n", "_i")
    return whole.unionByName(dealt)


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """A row for each of ``docs``: ``key, bytes, h``, its shard (``depth, prefix, page``) and the shard's size."""
    rows = docs.select(
        column(docs, key).alias("key"), hash_bits(column(docs, key), column(docs, text)).alias("h"),
        F.coalesce(F.octet_length(column(docs, text)), F.lit(0)).cast("long").alias("bytes"),
    )
    return assign(written(rows, "shard-rows"), limit)[0]


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Writes ``docs`` to ``folder``, a directory a shard, and gives the directory of slots.

    The rows of a shard come to one task, which its limit bounds, and so does a directory entry to one file.
    """
    names = {n: fresh_name(docs, n) for n in ("shard",)}
    rows = docs.withColumn("h", hash_bits(column(docs, key), column(docs, text))) if "h" not in docs.columns else None
    if rows is None or {"bytes", "depth", "prefix", "slot", "rows", "page", "shard_bytes", "shard_rows"} & {c.lower() for c in docs.columns}:
        # Clashing names travel in one struct.
        rows = docs.select(F.struct(*[column(docs, c) for c in docs.columns]).alias("row"), hash_bits(column(docs, key), column(docs, text)).alias("h"))
        size = F.octet_length(F.col("row").getField(text))
    else:
        size = F.octet_length(column(docs, text))
    placed, slots = assign(rows.withColumn("bytes", F.coalesce(size, F.lit(0)).cast("long")), limit)
    name = F.concat_ws("-", F.col("depth"), F.col("prefix"), F.col("page")).alias(names["shard"])
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns] if "row" in placed.columns and "row" not in docs.columns else [column(docs, c) for c in docs.columns]
    placed.select(*columns, name).repartition(names["shard"]).write.partitionBy(names["shard"]).parquet(folder)
    return slots


def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(read(spark, sf_dir, "documents"))
    return placed.select(
        F.col("key").alias("doc_id"), "bytes", "depth", "prefix", "page", "shard_bytes", "shard_rows",
    )
