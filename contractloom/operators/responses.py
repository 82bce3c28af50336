"""Carrier responses: error breakdown, rates, categories, and the cross-reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractloom.functions.text import code_tag, error_codes, parse_errors, strip, strip_leading_zeros

# Patterns in the error codes of each category; a response may be in several.
CATEGORIES = {
    "data_issues": "2109|1004903053|2027|X173",
    "carrier_validation": "F058|A687|ET38|A452|E487|BA11",
    "transient": "300-System|3013",
}
NO_CODE = "UNKNOWN"


def with_errors(responses: DataFrame) -> DataFrame:
    """Add the error pairs of a response and its codes as text."""
    return responses.withColumn("error_pairs", parse_errors(F.col("Error_Descriptions"))).withColumn(
        "error_codes", error_codes(F.col("error_pairs")))


def response_summary(responses: DataFrame) -> DataFrame:
    """One row: totals, successes, failures, their shares, and results with warnings."""
    counts = responses.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("Status") == "Success").alias("success"),
        F.count_if(F.col("Result_code") == "2").alias("warnings"),
    )
    failure = F.col("total") - F.col("success")
    return counts.select(
        "total", "success", failure.alias("failure"),
        F.round(F.col("success") / F.col("total") * 100, 1).alias("success_pct"),
        F.round(failure / F.col("total") * 100, 1).alias("failure_pct"),
        "warnings",
    )


def _failed(responses: DataFrame) -> DataFrame:
    return with_errors(responses.filter(F.col("Status") == "Failure"))


def error_code_summary(responses: DataFrame, *, order: str = "Policy_Number") -> DataFrame:
    """Per error code: policies, the first description, the most frequent type, and advice.

    ``order`` says which description is first. A failure without any error is
    counted as UNKNOWN. The code with most policies comes first, ties by name.
    """
    whole = F.coalesce("Error_Descriptions", F.lit(""))
    pairs = F.when(F.size("error_pairs") > 0, F.col("error_pairs")).otherwise(
        F.array(F.struct(F.lit(NO_CODE).alias("code"), whole.alias("description"))))
    return (
        _failed(responses)
        .select("Policy_Number", "Withdrawal_Type", F.col(order).alias("_order"),
                F.posexplode(pairs).alias("_pos", "_e"))
        .select("Policy_Number", "Withdrawal_Type", F.struct("_order", "_pos").alias("_place"),
                strip(F.col("_e.code")).alias("error_code"),
                F.left("_e.description", F.lit(80)).alias("description"))
        .groupBy("error_code")
        .agg(
            F.count_distinct("Policy_Number").alias("policies"),
            F.min_by("description", "_place").alias("description"),
            F.mode("Withdrawal_Type", True).alias("top_withdrawal_type"),
        )
        .withColumn("tag", code_tag(F.col("error_code")))
        .orderBy(F.desc("policies"), "error_code")
    )


def success_by_type(responses: DataFrame) -> DataFrame:
    """Successes, responses and success rate per withdrawal type."""
    return (
        responses.filter(F.col("Withdrawal_Type").isNotNull())
        .groupBy("Withdrawal_Type")
        .agg(F.count_if(F.col("Status") == "Success").alias("success"),
             F.count("*").alias("total"))
        .withColumn("rate", F.round(F.col("success") / F.col("total") * 100, 1))
    )


def failure_categories(responses: DataFrame) -> DataFrame:
    """Failures per category, and those in none."""
    hits = {n: F.col("error_codes").rlike(p) for n, p in CATEGORIES.items()}
    any_hit = None
    for hit in hits.values():
        any_hit = hit if any_hit is None else any_hit | hit
    return _failed(responses).agg(
        *(F.count_if(hit).alias(n) for n, hit in hits.items()),
        F.count_if(~any_hit).alias("other"),
    )


# The columns of a response; files may have more.
RESPONSE_SCHEMA = "Policy_Number string, Withdrawal_Type string, Status string, Result_code string, Error_Descriptions string"


_BROKEN = "_broken"


def scan_responses(spark: SparkSession, path: str, *, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Delimited responses by column name, with ``file`` and, of a line that is none, its text in ``_broken``.

    The names come from the header, which all files must share. A line with more or fewer
    fields than it is broken. Files are split over tasks, unless fields hold line ends
    (``multi_line``), which ties a file to one task.
    """
    # Only a line that is read as a whole shows how many fields it has.
    options = {"header": True, "escape": '"', "encoding": encoding, "multiLine": multi_line, "columnPruning": False}
    have = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*have, _BROKEN]])
    lines = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, enforceSchema=False).schema(schema).csv(path)
    # Spark reads no file for its broken lines alone, so a field is looked at too; the test always holds.
    lines = lines.filter(F.coalesce(F.col(f"`{have[0]}`"), F.lit("")) >= "")
    wanted = [c.split() for c in RESPONSE_SCHEMA.split(", ")]
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        *((F.col(f"`{n}`") if n in have else F.lit(None)).cast(t).alias(n) for n, t in wanted), _BROKEN,
    )


def read_responses(spark: SparkSession, path: str, *, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Responses from delimited text with a header, by column name; absent columns are null. Broken lines are left out."""
    lines = scan_responses(spark, path, encoding=encoding, multi_line=multi_line)
    return lines.filter(F.col(_BROKEN).isNull()).drop("file", _BROKEN)


def response_rejects(spark: SparkSession, path: str, *, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """``file, line`` of what ``read_responses`` leaves out."""
    lines = scan_responses(spark, path, encoding=encoding, multi_line=multi_line)
    return lines.filter(F.col(_BROKEN).isNotNull()).select("file", F.col(_BROKEN).alias("line"))


def crossref_responses(responses: DataFrame, validation: DataFrame) -> DataFrame:
    """Responses with the audited rows of their policy; leading zeros do not count.

    A blank policy has no partner: rows without one are not multiplied with each other.
    """
    left = responses.withColumn(
        "_key", strip_leading_zeros(F.nullif(strip(F.col("Policy_Number")), F.lit(""))))
    right = validation.select(
        strip_leading_zeros(F.nullif(strip(F.col("PolNumber")), F.lit(""))).alias("_key"),
        *(F.col(c).alias(f"{c}_val") if c in responses.columns else F.col(c)
          for c in validation.columns),
    )
    return left.join(right.filter(F.col("_key").isNotNull()), "_key", "left").drop("_key")


def crossref_summary(crossed: DataFrame, validation: DataFrame) -> DataFrame:
    """One row: responses, those with an audited row, and predicted failures."""
    predicted = validation.select(
        F.lit(0).alias("response"), F.lit(0).alias("matched"),
        (F.col("Predicted_Error_Codes") != "").cast("int").alias("predicted"))
    seen = crossed.select(
        F.lit(1).alias("response"), F.col("PolNumber").isNotNull().cast("int").alias("matched"),
        F.lit(0).alias("predicted"))
    return seen.unionByName(predicted).agg(
        F.sum("response").alias("responses"), F.sum("matched").alias("matched"),
        F.sum("predicted").alias("predicted_failures"))
