"""Vector search: nearest sentences per query, rolled up to paragraphs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.operators.knowledge_base import layer
from rejoinder.operators.joins import broadcast_if_small, top_per
from rejoinder.operators.lexical import match_terms

# Numbers one broadcast query matrix may hold; more queries are searched block by block.
QUERY_BLOCK_VALUES = 8_000_000
# Similarities held at once inside a task.
TILE_VALUES = 2_000_000
SIMILARITY_DIGITS = 9

HIT_SCHEMA = "query_id bigint, sentence_id bigint, similarity double"


def _unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0.0, 1.0, norms)


def _keep_best(query, sentence, similarity, k: int):
    """The k best entries per query: highest similarity, then lowest sentence id."""
    order = np.lexsort((sentence, -similarity, query))
    query, sentence, similarity = query[order], sentence[order], similarity[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.array([], dtype=int)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    kept = place < k
    return query[kept], sentence[kept], similarity[kept]


def _local_nearest(shared, k: int):
    """Nearest sentences of one partition for every query of the block.

    Sentences come in tiles of several times ``k``; only entries that reach the k-th best value
    known for their query survive a tile, so memory stays at k entries per query plus one tile.
    Vectors with a null, infinite or undefined number have no similarity and are left out.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = shared.value
        floor = np.full(len(ids), -np.inf)
        best = (np.array([], dtype=np.int64), np.array([], dtype=np.int64), np.array([], dtype=np.float64))
        rows = max(4 * k, TILE_VALUES // max(1, len(ids)))
        for batch in batches:
            for start in range(0, len(batch), rows):
                tile = batch.iloc[start : start + rows]
                vectors = np.stack(tile["embedding"].to_numpy()).astype(np.float64)
                finite = np.isfinite(vectors).all(axis=1)
                values = np.round(matrix @ _unit_rows(vectors[finite]).T, SIMILARITY_DIGITS)
                if values.shape[1] > k:
                    reach = np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]
                    floor = np.maximum(floor, reach)
                query, column = np.nonzero(values >= floor[:, None])
                sentence = tile["id"].to_numpy()[finite][column]
                best = _keep_best(
                    np.r_[best[0], query], np.r_[best[1], sentence], np.r_[best[2], values[query, column]], k
                )
                many = np.bincount(best[0], minlength=len(ids))
                full = many == k
                floor[full] = best[2][np.cumsum(many)[full] - 1]
        if len(best[0]):
            yield pd.DataFrame({"query_id": ids[best[0]], "sentence_id": best[1], "similarity": best[2]})

    return search


def vector_fault(dimension: int) -> Column:
    """Why a vector cannot be searched: ``missing``, ``dimension`` or ``not finite``; null for a good one."""
    finite = F.coalesce(F.forall("embedding", lambda x: F.abs(x) < F.lit(float("inf"))), F.lit(False))
    return (
        F.when(F.col("embedding").isNull(), "missing")
        .when(F.size("embedding") != dimension, "dimension")
        .when(~finite, "not finite")
    )


def rejected_vectors(vectors: DataFrame, key: str, dimension: int) -> DataFrame:
    """(key, fault) of the queries or sentences that ``nearest_sentences`` leaves out."""
    return vectors.select(key, vector_fault(dimension).alias("fault")).filter(F.col("fault").isNotNull())


def nearest_sentences(
    queries: DataFrame, sentences: DataFrame, k: int, block_values: int = QUERY_BLOCK_VALUES,
    dimension: int | None = None,
) -> DataFrame:
    """The ``k`` sentences with the highest cosine per query, over the whole sentence table.

    ``queries`` has ``query_id, embedding``, ``sentences`` has ``id, embedding``. Queries are
    counted first: a block up to ``block_values`` numbers is broadcast as one matrix and each
    sentence partition returns its own k best per query, found by matrix products; more
    queries are cut by hash into such blocks. Similarities are rounded to nine digits so
    that equal vectors tie whatever the order of addition, and ties go to the lowest id.

    Vectors have ``dimension`` numbers; if it is not given, as many as most queries have (the
    fewest on a tie). ``rejected_vectors`` lists the others, which get no hits and are none.
    """
    spark = sentences.sparkSession
    asked = queries.filter(F.col("embedding").isNotNull()).select("query_id", "embedding")
    if dimension is None:
        dimension = asked.agg(F.mode(F.size("embedding"), True)).first()[0]
    asked = asked.filter(vector_fault(dimension or 0).isNull())
    count = asked.count() if dimension else 0
    if not count:
        return spark.createDataFrame([], HIT_SCHEMA + ", place int")
    per_block = max(1, block_values // dimension)
    blocks = math.ceil(count / per_block)
    if blocks > 1:
        blocks = 2 * blocks
        asked = asked.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    usable = sentences.filter(F.size("embedding") == dimension).select("id", "embedding")
    passes = []
    for block in range(blocks):
        part = asked.filter(F.col("_block") == block) if blocks > 1 else asked
        rows = part.select("query_id", "embedding").toPandas()
        if not len(rows):
            continue
        matrix = _unit_rows(np.stack(rows["embedding"].to_numpy()).astype(np.float64))
        shared = spark.sparkContext.broadcast((rows["query_id"].to_numpy(), matrix))
        passes.append(usable.mapInPandas(_local_nearest(shared, k), HIT_SCHEMA))
    found = passes[0]
    for more in passes[1:]:
        found = found.unionAll(more)
    return top_per(found, ["query_id"], [F.desc("similarity"), F.asc("sentence_id")], k, "place")


def above_threshold(hits: DataFrame, threshold: float = fixed.SIMILARITY_THRESHOLD) -> DataFrame:
    return hits.filter(F.col("similarity") >= threshold)


def rollup_to_paragraphs(
    hits: DataFrame, sentences: DataFrame, paragraphs: DataFrame, rows: int | None = None
) -> DataFrame:
    """Best similarity per (query, paragraph) of the sentence hits; hits without paragraph drop out.

    ``rows`` is the most rows ``hits`` can have, if known; few enough are broadcast, so that
    neither node table is shuffled.
    """
    parents = sentences.select(F.col("id").alias("sentence_id"), "paragraph_id")
    nodes = paragraphs.select(F.col("id").alias("paragraph_id"), layer().alias("layer"), "quality_score")
    placed = broadcast_if_small(hits, rows).join(parents, "sentence_id")
    return (
        broadcast_if_small(placed, rows)
        .join(nodes, "paragraph_id")
        .repartition("query_id")  # serves this and every later step per query; few rows each
        .groupBy("query_id", F.col("paragraph_id").alias("id"), "layer", "quality_score")
        .agg(F.max("similarity").alias("similarity_score"))
    )


def semantic_hits(
    queries: DataFrame, sentences: DataFrame, paragraphs: DataFrame,
    k: int = fixed.RESULTS_PER_LAYER, threshold: float = fixed.SIMILARITY_THRESHOLD,
    order_by: str = "similarity", asked: int | None = None, dimension: int | None = None,
) -> DataFrame:
    """Top ``k`` paragraphs per layer among the ``3k`` nearest sentences, then one list per query.

    ``asked`` is the number of queries and ``dimension`` that of their vectors, if the caller knows them."""
    if order_by not in ("similarity", "quality_score"):
        raise ValueError("order_by must be 'similarity' or 'quality_score'")
    key = "similarity_score" if order_by == "similarity" else "quality_score"
    fetch = fixed.VECTOR_OVERFETCH * k
    nearest = above_threshold(nearest_sentences(queries, sentences, fetch, dimension=dimension), threshold)
    found = rollup_to_paragraphs(nearest, sentences, paragraphs, (queries.count() if asked is None else asked) * fetch)
    order = [F.desc_nulls_last(key), F.asc("id")]
    top = top_per(found, ["query_id", "layer"], order, k, "_place").drop("_place")
    listed = Window.partitionBy("query_id").orderBy(F.desc_nulls_last(key), "layer", "id")
    return top.withColumn("rank", F.row_number().over(listed))


def topic_name_hits(
    queries: DataFrame, topics: DataFrame, paragraphs: DataFrame, k: int = fixed.RESULTS_PER_LAYER
) -> DataFrame:
    """Up to ``2k`` paragraphs of topics whose name contains the query; similarity is 1.

    Topic names are matched like texts, each under its lowest paragraph id. A query's ``2k``
    lowest ids lie in the ``2k`` matching topics that start lowest, and within the ``2k`` lowest
    ids of each; only those are joined, so neither a topic with many paragraphs nor a query
    found in many names multiplies.
    """
    limit = 2 * k
    named = paragraphs.filter(F.col("topic") != "").join(topics, F.col("topic") == F.col("name"), "left_semi")
    starts = named.groupBy("topic").agg(F.min("id").alias("id"))
    texts = starts.select("id", F.lit(0).alias("layer"), F.lower("topic").alias("text"))
    wanted = queries.select(
        "query_id", F.lower("query").alias("term"), F.lit(1).alias("weight"), F.lit(True).alias("qualifies")
    ).filter(F.col("term") != "")
    matched = top_per(match_terms(texts, wanted, keep=limit), ["query_id"], [F.asc("id")], limit, "_place")
    offered = top_per(
        named.select("id", "topic", "quality_score", layer().alias("layer")), ["topic"], [F.asc("id")], limit, "_place"
    ).drop("_place")
    hits = matched.join(starts, "id").select("query_id", "topic").join(offered, "topic").drop("topic")
    return top_per(hits.withColumn("similarity_score", F.lit(1.0)), ["query_id"], [F.asc("id")], limit)
