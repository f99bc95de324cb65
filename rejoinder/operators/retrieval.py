"""Search results: merging, counter texts, the rows the assessment works on."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.operators import lexical, semantic
from rejoinder.operators.joins import BROADCAST_ROWS, broadcast_if_small, top_per
from rejoinder.session import written

METHODS = ("syntax", "semantic", "hybrid")


class KnowledgeBase(NamedTuple):
    topics: DataFrame
    paragraphs: DataFrame
    sentences: DataFrame
    counters: DataFrame


def dedupe_by_id(hits: DataFrame) -> DataFrame:
    """First row per (query, paragraph) in list order."""
    return top_per(hits, ["query_id", "id"], [F.asc("rank")], 1, "_first").drop("_first")


def merge_hits(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    """All of the first list, then new rows of the second, at most ``2k`` per query."""
    both = (
        first.withColumn("_source", F.lit(1))
        .unionByName(second.withColumn("_source", F.lit(2)), allowMissingColumns=True)
        .withColumn("rank", F.struct("_source", "rank"))
    )
    merged = top_per(dedupe_by_id(both), ["query_id"], [F.asc("rank")], 2 * k, "_rank")
    return merged.drop("rank", "_source").withColumnRenamed("_rank", "rank")


def hybrid_hits(
    queries: DataFrame, kb: KnowledgeBase, k: int = fixed.RESULTS_PER_LAYER, order_by: str = "similarity",
    asked: int | None = None,
) -> DataFrame:
    near = vector_or_topic_hits(queries, kb, k, order_by, asked)
    worded = lexical.phrase_hits(queries, kb.paragraphs, k).withColumnRenamed("score", "relevance_score")
    return merge_hits(near, worded, k)


def vector_or_topic_hits(
    queries: DataFrame, kb: KnowledgeBase, k: int = fixed.RESULTS_PER_LAYER, order_by: str = "similarity",
    asked: int | None = None,
) -> DataFrame:
    """Hits by vector; a query whose vector cannot be searched gets the paragraphs of topics that its text names.

    A vector can be searched if it is there, has as many numbers as most queries' (the fewest on a
    tie) and all of them are finite.
    """
    dimension = queries.filter(F.col("embedding").isNotNull()).agg(F.mode(F.size("embedding"), True)).first()[0]
    fault = semantic.vector_fault(dimension or 0)
    near = semantic.semantic_hits(queries, kb.sentences, kb.paragraphs, k, order_by=order_by, asked=asked, dimension=dimension)
    lacking = queries.filter(fault.isNotNull())
    if lacking.isEmpty():
        return near.drop("quality_score")
    named = semantic.topic_name_hits(lacking, kb.topics, kb.paragraphs, k)
    return near.unionByName(named.select(near.columns)).drop("quality_score")


def search(
    queries: DataFrame, kb: KnowledgeBase, method: str = "semantic",
    k: int = fixed.RESULTS_PER_LAYER, order_by: str = "similarity", asked: int | None = None,
) -> DataFrame:
    """Ranked hits ``query_id, id, layer, rank`` with a similarity or relevance score.

    By vector, alone or with keywords, queries without a usable vector fall back to topic names.
    """
    if method == "syntax":
        return lexical.phrase_hits(queries, kb.paragraphs, k).withColumnRenamed("score", "relevance_score")
    if method == "semantic":
        return vector_or_topic_hits(queries, kb, k, order_by, asked)
    if method == "hybrid":
        return hybrid_hits(queries, kb, k, order_by, asked)
    raise ValueError(f"method must be one of {METHODS}")


COUNTER_FIELDS = ["counter_id", "counter_content", "directness", "evidence_quality", "persuasiveness"]


def _lowest_counter(counters: DataFrame, key: str, wanted: DataFrame, rows: int | None) -> DataFrame:
    """(key, _counter): the counter with the lowest id per wanted key.

    Few wanted keys are broadcast and filter the counters where they lie. Otherwise every key
    is reduced to one row inside each partition before the join, so that a key with many
    counters never gathers in one task.
    """
    answers = counters.withColumnRenamed("id", "counter_id").withColumnRenamed("content", "counter_content")
    keys = wanted.select(key).distinct()
    first = F.min_by(F.struct(*COUNTER_FIELDS), "counter_id").alias("_counter")
    if rows is not None and rows <= BROADCAST_ROWS:
        return answers.join(F.broadcast(keys), key, "left_semi").groupBy(key).agg(first)
    return answers.groupBy(key).agg(first).join(keys, key, "left_semi")


def first_counters(counters: DataFrame, paragraph_ids: DataFrame, rows: int | None = None) -> DataFrame:
    """The counter with the lowest id of each wanted paragraph (column ``id``)."""
    wanted = paragraph_ids.select(F.col("id").alias("counters_id"))
    found = _lowest_counter(counters, "counters_id", wanted, rows)
    return found.select(F.col("counters_id").alias("id"), "_counter.*")


def expand_topic_counter(paragraphs: DataFrame, counters: DataFrame) -> DataFrame:
    """Topic and first counter of each paragraph, null where there is none."""
    found = first_counters(counters, paragraphs)
    return paragraphs.select("id", F.nullif("topic", F.lit("")).alias("topic")).join(found, "id", "left")


def attach_details(hits: DataFrame, kb: KnowledgeBase, rows: int | None = None) -> DataFrame:
    """Text, topic, quality and first counter of each hit. Only texts of hits are moved."""
    nodes = kb.paragraphs.select("id", "content", F.nullif("topic", F.lit("")).alias("topic"), "quality_score")
    found = broadcast_if_small(hits, rows).join(nodes, "id")
    return found.join(first_counters(kb.counters, hits, rows), "id", "left")


def fill_counters(results: DataFrame, counters: DataFrame, rows: int | None = None) -> DataFrame:
    """Give synthetic hits without a counter the lowest-id counter of their topic."""
    lacking = (F.col("layer") == 2) & F.col("counter_id").isNull() & F.col("topic").isNotNull()
    per_topic = _lowest_counter(counters, "topic", results.filter(lacking), rows)
    filled = results.join(per_topic, "topic", "left")
    return filled.withColumns(
        {f: F.when(lacking, F.col(f"_counter.{f}")).otherwise(F.col(f)) for f in COUNTER_FIELDS}
    ).drop("_counter")


def counter_context(results: DataFrame) -> DataFrame:
    """Hits that have a counter, as rows of the assessment."""
    similarity = F.col("similarity_score") if "similarity_score" in results.columns else F.lit(None).cast("double")

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0.0)).alias(name)

    return results.filter(F.col("counter_id").isNotNull()).select(
        "query_id", "rank", "counter_id",
        F.col("counter_content").alias("content"),
        "topic",
        F.col("id").alias("hate_paragraph_id"),
        or_zero("quality_score"),
        F.coalesce(similarity, F.lit(0.0)).alias("similarity_score"),
        or_zero("directness"), or_zero("evidence_quality"), or_zero("persuasiveness"),
    )


def retrieve_context(
    queries: DataFrame, kb: KnowledgeBase, method: str = "semantic",
    k: int = fixed.RESULTS_PER_LAYER, order_by: str = "similarity",
) -> DataFrame:
    """Search, details, counter fill and projection for a whole table of queries.

    The hits (at most ``2k`` per query) are written to the shared folder: several steps read
    them, and none of these should repeat the search.
    """
    asked = queries.count()
    rows = asked * 2 * k
    hits = written(search(queries, kb, method, k, order_by, asked), "hits")
    return counter_context(fill_counters(attach_details(hits, kb, rows), kb.counters, rows))
