"""A training corpus from raw documents: five stages, each of which works on what the one before it kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` writes each
result as Parquet to the shared folder and reads it again for the next, so a lost
executor costs no more than one stage.

All stages but the last give the columns of ``documents``. Their texts change in the
PII stage only. Null, empty and repeated rows are treated as the operators say: a row
without ten words goes in the first stage, and a repeated row is taken by the mix as a
row of its own.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractloom.llm import minhash, mixing, packing, pii, quality
from contractloom.llm.common import read, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near duplicates."""
    return minhash.deduplicate(docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    out = pii.pseudonymize(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.sample(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a document that comes twice is packed twice."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("PII", pii_surrogates),
    ("mixing sources to target weights", source_mix),
    ("packing", packed_sequences),
]

# Compression, similarity, keyed draws and tokenizers are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences made from the table ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/pipeline-{k}-{uuid.uuid4().hex}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
