"""The corpus pipeline: each stage works on all that the one before kept, and the last one mixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm import decontaminate, langid, mixing, secrets, simhash
from riskspark.llm.base import id_remainder
from riskspark.sources.staging import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected; learned from the labelled rows outside the held-out fold.

    Null and letterless texts and texts unlike every learned language go; equal rows share their fate.
    """
    return langid.keep_known(docs, langid.fit(docs, id_remainder(F.col("doc_id"), 5) != 0))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id (null last), of each component of linked fingerprints; of equal ids one row stays."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; texts without words stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; ``n_chars`` follows the text, null ones stay null."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their number of copies and their source's target.

    The mix adds its own columns; columns of the input that are named like them are replaced.
    """
    return mixing.mix(docs).where(F.col("copies") > 0)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("mix", mixed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs)
    return docs
