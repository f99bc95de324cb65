"""Inverted lists over sentence vectors: a search reads the lists near its queries instead of every vector.

The index is a folder of parquet files, one partition for each list, and the centroids of the lists. Centroids
are trained on a bounded sample of vectors; every usable vector is put into the list of its nearest
centroid and kept whole, so the similarities of the vectors that are read are exact and rank as in
``semantic.nearest_sentences``. How many lists a query reads is set when the index is built: the fewest, in powers
of two, with which a bounded sample of the vectors finds the wanted share of its true neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.operators.joins import top_per, top_per_merged
from rejoinder.operators.semantic import (
    HIT_SCHEMA, QUERY_BLOCK_VALUES, SIMILARITY_DIGITS, TILE_VALUES, _keep_best, _unit_rows, rejected_vectors, vector_fault,
)
from rejoinder.session import scratch_path

#: Vectors the centroids are trained on, and vectors that ask when the number of lists to read is set.
TRAINING_VECTORS = 20_000
ASKING_VECTORS = 64
MOST_LISTS = 1_024
TRAINING_ROUNDS = 12
WANTED_RECALL = 0.97

LIST_SCHEMA = "id bigint, embedding array<float>, list int"
ASKING_SCHEMA = "query_id bigint, embedding array<double>"


class VectorIndex(NamedTuple):
    path: str
    dimension: int
    centroids: np.ndarray
    probes: int


def train_centroids(vectors: np.ndarray, lists: int, rounds: int = TRAINING_ROUNDS, seed: int = 1) -> np.ndarray:
    """Unit centroids by k-means on the sphere; an empty list takes the vector that its centroid fits worst."""
    units = _unit_rows(vectors)
    lists = min(lists, len(units))
    chance = np.random.default_rng(seed)
    centroids = units[np.sort(chance.choice(len(units), lists, replace=False))]
    for _ in range(rounds):
        likeness = units @ centroids.T
        near = likeness.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, units)
        empty = np.flatnonzero(np.bincount(near, minlength=lists) == 0)
        if len(empty):
            sums[empty] = units[np.argsort(likeness.max(axis=1), kind="stable")[: len(empty)]]
        centroids = _unit_rows(sums)
    return centroids


def _lowest_by_hash(vectors: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` vectors, the lowest by a hash of the id."""
    chosen = top_per_merged(vectors.withColumn("_all", F.lit(0)), ["_all"], [F.xxhash64("id"), F.asc("id")], most, "_place")
    rows = chosen.select("embedding").toPandas()["embedding"]
    return np.stack(rows.to_numpy()).astype(np.float64) if len(rows) else np.zeros((0, 0))


def _assigned(shared):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centroids = shared.value
        rows = max(1, TILE_VALUES // max(1, len(centroids)))
        for batch in batches:
            for start in range(0, len(batch), rows):
                tile = batch.iloc[start : start + rows]
                units = _unit_rows(np.stack(tile["embedding"].to_numpy()).astype(np.float64))
                yield tile.assign(list=(units @ centroids.T).argmax(axis=1).astype(np.int32))

    return assign


def build_index(
    sentences: DataFrame, dimension: int, path: str | None = None, lists: int | None = None, k: int = 15, recall: float = WANTED_RECALL,
) -> tuple[VectorIndex, DataFrame]:
    """An index of all usable rows of ``sentences (id, embedding)``, and the rows that are not usable with their fault.

    The number of lists is the square root of the rows, at most ``MOST_LISTS``; a list that holds
    much of the table is many files and is read by many tasks.
    """
    spark = sentences.sparkSession
    path = path or scratch_path(spark, "vector-index")
    usable = sentences.select("id", "embedding").filter(F.col("id").isNotNull() & vector_fault(dimension).isNull())
    sample = _lowest_by_hash(usable, TRAINING_VECTORS)
    wanted = lists or int(np.clip(np.sqrt(usable.count()), 1, MOST_LISTS))
    centroids = train_centroids(sample, wanted) if len(sample) else np.zeros((0, dimension))
    if len(centroids):
        shared = spark.sparkContext.broadcast(centroids)
        usable.mapInPandas(_assigned(shared), LIST_SCHEMA).write.partitionBy("list").parquet(path)
        shared.destroy()
    index = VectorIndex(path, dimension, centroids, len(centroids))
    return index._replace(probes=_fewest_probes(spark, index, sample[:ASKING_VECTORS], k, recall)), rejected_vectors(sentences, "id", dimension)


def _fewest_probes(spark: SparkSession, index: VectorIndex, asking: np.ndarray, k: int, recall: float) -> int:
    """The lists to read, so that ``asking`` vectors find ``recall`` of what reading all lists finds."""
    if not len(asking):
        return len(index.centroids)
    queries = spark.createDataFrame([(n, vector.tolist()) for n, vector in enumerate(asking)], ASKING_SCHEMA)
    exact = {(r.query_id, r.sentence_id) for r in indexed_nearest(index, queries, k, len(index.centroids)).collect()}  # ASKING_VECTORS * k rows
    probes = 1
    while probes < len(index.centroids):
        found = {(r.query_id, r.sentence_id) for r in indexed_nearest(index, queries, k, probes).collect()}
        if len(found & exact) >= recall * len(exact):
            break
        probes *= 2
    return min(probes, len(index.centroids))


def _nearest_in_lists(shared, k: int):
    """The k best of one task for every query, among the lists that the query reads."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix, reads = shared.value
        best = (np.array([], dtype=np.int64), np.array([], dtype=np.int64), np.array([], dtype=np.float64))
        for batch in batches:
            for number, rows in batch.groupby("list"):
                asking = np.flatnonzero(reads[:, number])
                step = max(4 * k, TILE_VALUES // max(1, len(asking)))
                for start in range(0, len(rows) if len(asking) else 0, step):
                    tile = rows.iloc[start : start + step]
                    units = _unit_rows(np.stack(tile["embedding"].to_numpy()).astype(np.float64))
                    values = np.round(matrix[asking] @ units.T, SIMILARITY_DIGITS)
                    if values.shape[1] > k:
                        query, column = np.nonzero(values >= np.partition(values, values.shape[1] - k, axis=1)[:, -k, None])
                    else:
                        query, column = (x.ravel() for x in np.indices(values.shape))
                    best = _keep_best(
                        np.r_[best[0], asking[query]], np.r_[best[1], tile["id"].to_numpy()[column]], np.r_[best[2], values[query, column]], k
                    )
        if len(best[0]):
            yield pd.DataFrame({"query_id": ids[best[0]], "sentence_id": best[1], "similarity": best[2]})

    return search


def indexed_nearest(index: VectorIndex, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
    """The ``k`` nearest indexed sentences per query, with its place, among the ``probes`` lists nearest to the query.

    Columns as ``semantic.nearest_sentences``. Queries go to the tasks in bounded blocks; a block reads only the
    partitions of lists that one of its queries wants. Queries without a usable vector get no rows.
    """
    spark = queries.sparkSession
    probes = min(probes or index.probes, len(index.centroids))
    empty = spark.createDataFrame([], HIT_SCHEMA + ", place int")
    if not probes:
        return empty
    asked = queries.select("query_id", "embedding").filter(vector_fault(index.dimension).isNull())
    per_block = max(1, QUERY_BLOCK_VALUES // index.dimension)
    blocks = -(-asked.count() // per_block)
    if blocks > 1:
        blocks *= 2  # hashed blocks differ in size
    passes = []
    vectors = spark.read.schema(LIST_SCHEMA).parquet(index.path)
    for block in range(blocks):
        part = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        rows = part.toPandas()
        if not len(rows):
            continue
        matrix = _unit_rows(np.stack(rows["embedding"].to_numpy()).astype(np.float64))
        likeness = matrix @ index.centroids.T
        reads = np.zeros(likeness.shape, bool)
        np.put_along_axis(reads, np.argsort(-likeness, axis=1, kind="stable")[:, :probes], True, axis=1)
        shared = spark.sparkContext.broadcast((rows["query_id"].to_numpy(), matrix, reads))
        wanted = np.flatnonzero(reads.any(axis=0)).tolist()
        passes.append(vectors.filter(F.col("list").isin(wanted)).mapInPandas(_nearest_in_lists(shared, k), HIT_SCHEMA))
    if not passes:
        return empty
    found = passes[0]
    for more in passes[1:]:
        found = found.unionAll(more)
    return top_per(found, ["query_id"], [F.desc("similarity"), F.asc("sentence_id")], k, "place")


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, wanted, hits, recall): the share of the exact neighbours that were found, each counted once where ids repeat."""
    key = ["query_id", "sentence_id"]
    hit = exact.join(found.select(*key, F.lit(1).alias("_hit")).distinct(), key, "left")
    return hit.agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"), F.count("_hit").alias("hits"),
        (F.count("_hit") / F.count("*")).alias("recall"),
    )
