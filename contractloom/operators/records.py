"""Parsed records: types, fields, occurrence numbers, counts.

``records`` is ``file, line_no, record_type, record_desc, contract, raw``. Fields
are cut from ``raw`` where they are used, so a shuffle moves the line and not a
map of names and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractloom.functions.lines import contract_of, describe, detect_record_type, fields_map
from contractloom.sources.fixed_width import detail_records
from contractloom.spec.layouts import DETAIL_TYPES, LAYOUTS

NO_CONTRACT = "__NO_CONTRACT__"

# Lines per block when a group is numbered piecewise.
BLOCK_BITS = 20


def parse_records(lines: DataFrame) -> DataFrame:
    """The lines of a known record type. Details without a contract share one key."""
    contract = F.col("contract")  # a column first, so that it is cut once
    return (
        lines.select("file", "line_no", detect_record_type(F.col("value")).alias("record_type"),
                     F.col("value").alias("raw"))
        .filter(F.col("record_type").isNotNull())
        .withColumn("contract", contract_of(F.col("raw"), F.col("record_type")))
        .select(
            "file",
            "line_no",
            "record_type",
            describe(F.col("record_type")).alias("record_desc"),
            F.when(F.length("record_type") == 4, F.when(contract != "", contract).otherwise(NO_CONTRACT)).alias("contract"),
            "raw",
        )
    )


def with_fields(records: DataFrame) -> DataFrame:
    """Add ``fields``, a map of all field names to their values."""
    return records.withColumn("fields", fields_map(F.col("raw"), F.col("record_type")))


def number_in_group(df: DataFrame, keys: list[str], order: list[str], block: Column,
                    name: str) -> DataFrame:
    """The exact row number within ``keys``, without gathering a group in one task.

    ``block`` splits a group into ordered pieces of bounded size. Rows are
    numbered within their piece; the rows of the earlier pieces are added from
    a table that holds only groups of more than one piece.
    """
    pieces = df.withColumn("_block", block)
    local = Window.partitionBy(*keys, "_block").orderBy(*order)
    earlier = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        pieces.groupBy(*keys, "_block").count()
        .withColumn("_before", F.sum("count").over(earlier))
        .filter(F.col("_before") > 0)
        .drop("count")
    )
    return (
        pieces.withColumn("_local", F.row_number().over(local))
        .join(offsets, [*keys, "_block"], "left")
        .withColumn(name, (F.coalesce("_before", F.lit(0)) + F.col("_local")).cast("bigint"))
        .drop("_block", "_local", "_before")
    )


def occurrence_number(records: DataFrame) -> DataFrame:
    """Add ``occ``: the number of a detail record among those of its contract and type."""
    return number_in_group(
        detail_records(records),
        ["file", "contract", "record_type"],
        ["line_no", "raw"],
        F.shiftright("line_no", BLOCK_BITS),
        "occ",
    )


def record_type_counts(records: DataFrame) -> DataFrame:
    """Records per file and type, headers included."""
    return records.groupBy("file", "record_type", "record_desc").agg(F.count("*").alias("n"))


def max_occurrences(records: DataFrame) -> DataFrame:
    """Per type: the most records any contract has of it; lines without a contract count once."""
    return (
        detail_records(records)
        .groupBy("file", "contract", "record_type")
        .count()
        .groupBy("record_type")
        .agg(F.max(F.when(F.col("contract") == NO_CONTRACT, 1).otherwise(F.col("count"))).alias("max_occ"))
    )


def occurrence_limits(records: DataFrame) -> dict[str, int]:
    """``max_occurrences`` on the driver: at most one number per detail type."""
    rows = max_occurrences(records).collect()
    return {r["record_type"]: r["max_occ"] for r in rows}


def last_record_wins(records: DataFrame) -> DataFrame:
    """The last record per contract of every type that does not repeat."""
    single = [t for t in DETAIL_TYPES if not LAYOUTS[t].repeats]
    return (
        detail_records(records)
        .filter(F.col("record_type").isin(*single))
        .groupBy("file", "contract", "record_type")
        .agg(F.max_by(F.struct("line_no", "raw"), "line_no").alias("last"))
        .select("file", "contract", "record_type", "last.line_no", "last.raw")
    )
