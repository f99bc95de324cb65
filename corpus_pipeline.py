"""Documents to training tokens: toxic texts, copies, near copies and benchmark leaks go, the rest is encoded.

Every stage works on all that the stage before has kept. ``run`` writes each stage to the
shared folder, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.llm import bpe, decontamination, exact_dedup, near_dedup, toxicity
from rejoinder.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from these documents and the labels, does not call toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.distinct_documents(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the row with the smallest id."""
    return near_dedup.one_of_each(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, their ids, and the text they decode to."""
    encoded = bpe.encode_documents(docs)
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("exact dedup", distinct),
    ("near dedup", different),
    ("decontamination", unseen),
    ("tokens", tokens),
]

#: A learned classifier and hashed candidates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
