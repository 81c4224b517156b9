"""Cleaning and packing of a text corpus: each stage works on what the one before it kept.

Toxic documents go; one document stays of each group of near copies; repeated passages are cut;
secrets are masked; what is left is packed into length buckets. Stages are written as Parquet to
the session's shared folder and read again. A stage's inner tables go when the next one starts, and its
output when that of the next is written.

Each stage keeps rows with a missing or empty text, ids that are missing or repeated, and columns
it does not know; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import jaccard_join, packing, secret_scan, suffix_dedup, toxicity
from eventlake.llm.work import delete, stage_tables, table
from eventlake.session import fresh_dir


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage_tables(spark):
        return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage_tables(spark):
        return jaccard_join.keep_one(docs, words=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage_tables(spark):
        return suffix_dedup.without_repeats(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage_tables(spark):
        return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage_tables(spark):
        return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard_join", one_of_near_copies),
    ("suffix_dedup", without_repeats),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The learned first stage has no SQL form; tests compare the others with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        found, folder = stage(spark, docs, sf_dir), fresh_dir(spark, f"pipeline-{name}")
        found.write.parquet(folder)
        docs = spark.read.schema(found.schema).parquet(folder)
        if before:
            delete(spark, before)
        before = folder
    return docs
