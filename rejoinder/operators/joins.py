"""Joins and limits shared by the search operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of narrow columns a broadcast side may have.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast ``df`` if it is known to have at most ``BROADCAST_ROWS`` rows, else leave it
    to Spark, which joins by shuffle and splits skewed partitions."""
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


def top_per(df: DataFrame, groups: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Spark applies the limit inside each partition before the
    shuffle, so a group's task sees ``k`` rows per partition at most."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


# Tasks that share the first merge of a group.
FIRST_MERGES = 256


def top_per_merged(df: DataFrame, groups: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """As ``top_per``, for few groups that hold very many rows: merged in two steps.

    The ``k`` rows per partition of a group first go to ``FIRST_MERGES`` tasks by the number of
    their partition, which leave ``k`` rows each, so the last task sees a fixed number of rows
    however many partitions there are. The rows do not depend on how partitions are numbered.
    """
    dealt = df.withColumn("_merge", F.spark_partition_id() % FIRST_MERGES)
    return top_per(top_per(dealt, [*groups, "_merge"], order, k, rank).drop("_merge", rank), groups, order, k, rank)
