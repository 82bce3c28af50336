"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a run of characters other than ASCII white space. bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; one of our own only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = "/tmp/contractloom-shared"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    This cuts the lineage: a lost executor costs no more than the reading of a file.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column(df: DataFrame, name: str):
    """A column by its exact name, whatever characters the name holds."""
    return F.col(f"`{name.replace('`', '``')}`")
