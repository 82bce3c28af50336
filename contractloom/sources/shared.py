"""The shared folder for tables that cut a lineage or that several readers share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Readers deal whole files by their bytes, which say little of the work where rows compress unevenly: so no file has many rows.
ROWS_PER_FILE = 100_000  # of up to a hundred columns, fewer of wider rows


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a fresh local folder only where it is unset and Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="contractloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, spread: str | None = None, *, dictionary: bool = True) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    With ``spread``, rows go by the hash of that unique column to files of even size, as
    many as the shuffle makes of them. Without ``dictionary``, values are written as they are: for
    hundreds of columns that takes less time and, compressed, no more room.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if spread:
        df = df.repartition(spread)
    rows = max(1, ROWS_PER_FILE // (1 + len(df.columns) // 100))
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows).option("parquet.enable.dictionary", dictionary).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
