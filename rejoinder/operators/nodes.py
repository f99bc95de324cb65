"""Evaluated pairs turned into paragraph, sentence and counter tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.functions.text import sentences
from rejoinder.operators.ordinals import joined_by_hash, with_ordinal, with_total_before

PARAGRAPH_COLUMNS = [
    "id", "content", "topic", "source_debate", "representativeness", "coherence", "harmfulness", "quality_score",
]
COUNTER_COLUMNS = [
    "id", "content", "topic", "counters_id", "directness", "evidence_quality", "persuasiveness", "quality_score",
    "assessment",
]


def split_sentences(paragraphs: DataFrame, key: str = "id", text: str = "content") -> DataFrame:
    """One row per sentence with its position, starting at 0."""
    return paragraphs.select(key, F.posexplode(sentences(F.col(text))).alias("position", "sentence")).withColumn(
        "position", F.col("position").cast("bigint")
    )


def _or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def resolve_scores(evaluated: DataFrame) -> DataFrame:
    """Flat scores of a nested ``evaluation``.

    Harmful scores come from ``harmful_content``, else from the older ``hate_speech``, whose
    ``specificity`` stands for harmfulness; anything missing is 0.
    """
    scores = F.col("evaluation.scores")
    new, old, reply = scores["harmful_content"], scores["hate_speech"], scores["counterspeech"]

    def harmful(field: str, old_field: str) -> Column:
        return _or_zero(F.when(new.isNotNull(), new[field]).otherwise(old[old_field]))

    return evaluated.withColumns(
        {
            "representativeness": harmful("representativeness", "representativeness"),
            "coherence": harmful("coherence", "coherence"),
            "harmfulness": harmful("harmfulness", "specificity"),
            "harmful_subtotal": harmful("subtotal", "subtotal"),
            "directness": _or_zero(reply["directness"]),
            "evidence_quality": _or_zero(reply["evidence_quality"]),
            "persuasiveness": _or_zero(reply["persuasiveness"]),
            "counter_subtotal": _or_zero(reply["subtotal"]),
            "assessment": F.coalesce(F.col("evaluation.assessment"), F.lit("")),
        }
    )


def assign_ids(evaluated: DataFrame, order_by: str = "pair_id") -> DataFrame:
    """Dense ids 1..N in input order; one debate is one pair, so the id is also its number."""
    return with_ordinal(evaluated, [order_by], "id", key=[order_by])


def build_paragraphs(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "id",
        F.col("content.proponent").alias("content"),
        "topic",
        F.col("id").alias("source_debate"),
        "representativeness", "coherence", "harmfulness",
        F.col("harmful_subtotal").alias("quality_score"),
    )


def build_sentences(paragraphs: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    """Sentences numbered over the whole table; ``embeddings (id, embedding)`` are joined by that number."""
    # A sentence's number is that of all sentences of the paragraphs before, plus its place; only counts are sorted.
    pieces = F.when(F.col("content").isNull(), 0).otherwise(F.size(sentences(F.col("content"))))
    before = with_total_before(paragraphs.select("id", pieces.alias("_pieces")), ["id"], "_pieces", "_before")
    numbered = (
        joined_by_hash(paragraphs.select("id", "content"), before.select("id", "_before"), ["id"])
        .select("_before", F.col("id").alias("paragraph_id"), F.posexplode(sentences(F.col("content"))).alias("_place", "content"))
        .select((F.col("_before") + F.col("_place") + 1).alias("id"), "content", "paragraph_id")
    )
    return numbered if embeddings is None else numbered.join(embeddings, "id", "left")


def build_counters(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "id",
        F.col("content.opponent").alias("content"),
        "topic",
        F.col("id").alias("counters_id"),
        "directness", "evidence_quality", "persuasiveness",
        F.col("counter_subtotal").alias("quality_score"),
        "assessment",
    )


def node_counts(paragraphs: DataFrame, sentence_table: DataFrame, counters: DataFrame) -> DataFrame:
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("node_table"), "rows")

    return (
        counted("hate_paragraphs", paragraphs)
        .unionByName(counted("hate_sentences", sentence_table))
        .unionByName(counted("counter_paragraphs", counters))
    )


def pairs_to_nodes(evaluated: DataFrame, embeddings: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three node tables of a table of evaluated pairs."""
    numbered = assign_ids(resolve_scores(evaluated))
    paragraphs = build_paragraphs(numbered)
    return {
        "paragraphs": paragraphs,
        "sentences": build_sentences(paragraphs, embeddings),
        "counters": build_counters(numbered),
    }
