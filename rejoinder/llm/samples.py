"""Bounded samples of training rows; the rest of the corpus is never collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import held_out
from rejoinder.operators.joins import top_per


#: Rows of a value that are expected below its threshold: this many times the sample and this many more. That fewer
#: than the sample lie there has a probability below 1e-200.
TIMES, MORE = 2, 1000


def first_by_hash(rows: DataFrame, group: str, most: int, salt: int = 0) -> DataFrame:
    """At most ``most`` ids of every value of ``group``, the smallest by a hash of the id.

    Rows of each value are counted first; a threshold on the hash, set from the count, then leaves
    some ``TIMES * most + MORE`` of them to be ranked, however many rows and partitions there are. The
    counts, one row for each value, are broadcast: a model keeps far more for each value than that.
    """
    draw = F.xxhash64(F.col("doc_id"), F.lit(salt))
    counts = rows.groupBy(F.col(group).alias("_value")).agg(F.count("*").alias("_rows"))
    share = F.lit(float(TIMES * most + MORE)) / F.col("_rows")
    low = draw.cast("double") / F.lit(2.0**64) + F.lit(0.5) <= share
    near = rows.join(F.broadcast(counts), F.col(group).eqNullSafe(F.col("_value"))).where(low).select(*rows.columns)
    return top_per(near, [group], [draw, F.asc("doc_id")], most, "place").drop("place")


def with_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of a bounded sample of ids, one row for each id."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").groupBy(*sample.columns).agg(F.min("text").alias("text"))


def labelled(docs: DataFrame, labels: DataFrame, column: str, most: int) -> DataFrame:
    """Texts and one label of at most ``most`` ids of each label; held-out, null and unlabelled rows are left out."""
    told = (
        labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    )
    # ids that the labels name but this table lacks must not take a place in the sample
    here = told.join(docs.select("doc_id"), "doc_id", "left_semi")
    return with_texts(docs, first_by_hash(here, "label", most))


def unlabelled(docs: DataFrame, most: int) -> DataFrame:
    """Texts of at most ``most`` ids of the learning fold, whatever their labels."""
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.lit(0).alias("part"))
    return with_texts(docs, first_by_hash(ids.distinct(), "part", most, salt=1))


def report(docs: DataFrame, score: DataFrame, threshold: float) -> DataFrame:
    """Scores with their fold and their prediction."""
    value: Column = F.col("score")
    return score.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (value >= threshold).cast("int").alias("predicted"))
