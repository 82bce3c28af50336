"""Fixed-width text files: scan with line numbers, format detection, file metadata.

``lines`` below is a DataFrame of ``file string, line_no bigint, value string``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contractloom.functions.lines import detect_record_type, field_of
from contractloom.functions.text import filename_date, strip
from contractloom.sources.shared import written
from contractloom.spec.layouts import (
    EXTENDED_WIDTH,
    FAR_DETAIL_TYPES,
    HEADER_TYPES,
    LAYOUTS,
    POV_DETAIL_TYPES,
    STANDARD_WIDTH,
)

STANDARD, EXTENDED = "standard", "extended"


def scan_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Read text files as numbered lines, counted from 1 in each file.

    A row id grows within one block of a file, so the number of a line is its
    distance from the first row of its block plus the lines of the earlier
    blocks. One row per block is written to the shared folder first, as their
    number is not known before: else Spark would shuffle the lines to meet
    them. So the lines are shuffled only where the blocks are too many to broadcast.
    """
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        raw.groupBy("file", "block")
        .agg(F.count("*").alias("n"), F.min("row").alias("first_row"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .drop("n")
    )
    return raw.join(written(blocks, "blocks"), ["file", "block"]).select(
        "file",
        (F.col("before") + F.col("row") - F.col("first_row") + 1).alias("line_no"),
        F.make_valid_utf8("value").alias("value"),
    )


def format_verdict(line: Column) -> Column:
    """What one line says about the format of its file; null when it says nothing."""
    return (
        F.when(strip(line) == "", None)
        .when(line.startswith("HDR"), STANDARD)
        .when(F.substring(line, 2, 2).isin("10", "12"), STANDARD)
        .when(F.length(line) == EXTENDED_WIDTH, EXTENDED)
        .when(F.length(line) == STANDARD_WIDTH, STANDARD)
    )


def _format(sample_lines: int | None = None) -> Column:
    verdict = format_verdict(F.col("value"))
    if sample_lines is not None:
        verdict = F.when(F.col("line_no") <= sample_lines, verdict)
    return F.coalesce(
        F.min_by(verdict, F.when(verdict.isNotNull(), F.col("line_no"))), F.lit(STANDARD)
    )


def detect_format(lines: DataFrame, *, sample_lines: int | None = None) -> DataFrame:
    """One row per file: ``standard`` or ``extended``, by the first line that tells.

    All lines are looked at, unless the caller asks for the first ``sample_lines`` only.
    """
    return lines.groupBy("file").agg(_format(sample_lines).alias("file_format"))


def _quoted(text: Column) -> Column:
    """Text in quotes, double ones when it holds a single quote only."""
    double = text.contains("'") & ~text.contains('"')
    mark = F.when(double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(mark, text, mark)


def _unknown(lines: DataFrame) -> DataFrame:
    value = F.col("value")
    return lines.filter(detect_record_type(value).isNull() & (strip(value) != ""))


def rejects(lines: DataFrame, formats: DataFrame) -> DataFrame:
    """Lines of no known type. Frame lines of standard files are expected."""
    head = F.left(F.col("value"), F.lit(5))
    frame = (F.col("file_format") == STANDARD) & (
        F.col("value").startswith("HDR") | F.col("value").startswith("END")
    )
    return (
        _unknown(lines)
        .join(formats, "file", "left")
        .filter(~F.coalesce(frame, F.lit(False)))
        .select(
            "file",
            "line_no",
            head.alias("head"),
            F.concat(
                F.lit("Line "), F.col("line_no").cast("string"),
                F.lit(": unrecognised record type (first 5 chars: "), _quoted(head), F.lit(")"),
            ).alias("error"),
        )
    )


def _early_details(lines: DataFrame, k: int) -> DataFrame:
    """Per file: which kinds are among its first ``k`` details; the limit reaches the map side."""
    first = Window.partitionBy("file").orderBy("line_no")
    t = F.col("t")
    return (
        lines.select("file", "line_no", detect_record_type(F.col("value")).alias("t"))
        .filter(F.length("t") == 4)
        .withColumn("rn", F.row_number().over(first))
        .filter(F.col("rn") <= k)
        .groupBy("file")
        .agg(F.bool_or(t.isin(*POV_DETAIL_TYPES)).alias("has_pov"), F.bool_or(t.isin(*FAR_DETAIL_TYPES)).alias("has_far"))
    )


def line_facts(lines: DataFrame) -> DataFrame:
    """Add what each line says about its file: ``t``, ``verdict``, ``header_date``, ``unknown``, ``frame``."""
    value = F.col("value")
    typed = lines.withColumn("t", detect_record_type(value))
    unknown = F.col("t").isNull() & (strip(value) != "")
    return typed.select(
        "*",
        format_verdict(value).alias("verdict"),
        F.when(F.col("t") == "100", field_of(value, "100", "Valuation_Date")).alias("header_date"),
        F.coalesce(unknown, F.lit(False)).alias("unknown"),
        F.coalesce(unknown & (value.startswith("HDR") | value.startswith("END")), F.lit(False)).alias("frame"),
    )


def file_facts(said: DataFrame, early: DataFrame | None = None) -> DataFrame:
    """One row per file from the facts of its lines (``file, line_no`` and those of ``line_facts``).

    ``early`` tells which kinds are among the first details, where not all shall count.
    """
    t, line_no, verdict = F.col("t"), F.col("line_no"), F.col("verdict")
    kind = F.when(t == "100", "POV").when(t == "400", "FAR")
    counts = F.map_filter(
        F.create_map(*(c for k in LAYOUTS for c in (F.lit(k), F.count_if(t == k)))),
        lambda _, n: n > 0,
    )
    stats = said.groupBy("file").agg(
        F.coalesce(F.min_by(verdict, F.when(verdict.isNotNull(), line_no)), F.lit(STANDARD)).alias("file_format"),
        F.bool_or(t.isin(*POV_DETAIL_TYPES)).alias("has_pov"),
        F.bool_or(t.isin(*FAR_DETAIL_TYPES)).alias("has_far"),
        F.max_by(kind, F.when(kind.isNotNull(), line_no)).alias("header_kind"),
        F.max_by("header_date", F.when(t == "100", line_no)).alias("header_date"),
        F.count("*").alias("total_lines"),
        F.count("t").alias("parsed_lines"),
        F.count_if(t.isNull()).alias("skipped_lines"),
        F.count_if("unknown").alias("unknown"),
        F.count_if("frame").alias("frames"),
        counts.alias("record_type_counts"),
    )
    extended = F.col("file_format") == EXTENDED
    inferred = F.when(extended & F.col("has_pov"), "POV").when(extended & F.col("has_far"), "FAR")
    named = F.when(extended, filename_date(F.col("file")))
    if early is not None:
        stats = stats.drop("has_pov", "has_far").join(early, "file", "left")
    return stats.select(
        "file",
        F.coalesce("header_kind", inferred, F.lit("")).alias("file_type"),
        "file_format",
        F.coalesce(F.nullif("header_date", F.lit("")), named, F.lit("")).alias("valuation_date"),
        "total_lines",
        "parsed_lines",
        "skipped_lines",
        (F.col("unknown") - F.when(extended, 0).otherwise(F.col("frames"))).alias("error_count"),
        "record_type_counts",
    )


def file_metadata(lines: DataFrame, *, sample_details: int | None = None) -> DataFrame:
    """One row per file: format, kind, date, line counts and counts per record type.

    Without a header the kind is told by the details: by all of them, or by the first
    ``sample_details`` where the caller asks for that.
    """
    return file_facts(line_facts(lines), None if sample_details is None else _early_details(lines, sample_details))


def header_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("record_type").isin(*HEADER_TYPES))


def detail_records(records: DataFrame) -> DataFrame:
    return records.filter(~F.col("record_type").isin(*HEADER_TYPES))


def run_totals(files: DataFrame) -> DataFrame:
    """One row for a run: the sums of ``file_metadata`` over its files."""
    names = ("total_lines", "parsed_lines", "skipped_lines", "error_count")
    return files.agg(
        F.count(F.lit(1)).alias("files"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)
    )
