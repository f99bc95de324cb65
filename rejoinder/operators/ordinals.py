"""Dense numbers and running totals over a whole table without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.session import written

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def with_ordinal(df: DataFrame, order_by: list, name: str = "ordinal", key: list[str] | None = None) -> DataFrame:
    """Number rows 1..N in the order of ``order_by`` (columns that are unique together).

    Rows are range partitioned, sorted inside partitions and written once to the shared
    folder, so a lost executor cannot change the partition bounds between the count and
    the numbering. Only one row per written partition takes part in the prefix sum.

    With ``key``, the names of the columns that ``order_by`` is made of, the rows are written as
    they lie and only these columns are sorted; the numbers are joined back by hash, so that
    other columns are in no sort and no range exchange. Where a key repeats after all, whole
    rows are numbered as without ``key``.
    """
    if key is None or set(key) == set(df.columns):
        return _numbered(df, order_by, name)
    rows = written(df, "rows")
    places = _numbered(rows.select(*key), order_by, name)
    if not places.groupBy(*key).count().filter("count > 1").isEmpty():
        return _numbered(rows, order_by, name)
    return joined_by_hash(rows, places, key).select(*df.columns, name)


def with_total_before(df: DataFrame, order_by: list, value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all rows that come before in ``order_by``; ``df`` should be narrow, as it is sorted."""
    placed = _placed(df, order_by)
    before = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
    offsets = _offsets(placed.groupBy("_part").agg(F.sum(value).alias("_sum")))
    return inside.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_inside")).cast("bigint").alias(name)
    )


def _numbered(df: DataFrame, order_by: list, name: str) -> DataFrame:
    placed = _placed(df, order_by)
    offsets = _offsets(placed.groupBy("_part").agg(F.count("*").alias("_sum")))
    # One offset per written partition: bounded by the partition count, not by the data.
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row") + 1).cast("bigint").alias(name)
    )


def _placed(df: DataFrame, order_by: list) -> DataFrame:
    in_order = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return (
        written(in_order.withColumn("_place", F.monotonically_increasing_id()), "ordinal")
        .withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1))
    )


def _offsets(sums: DataFrame) -> DataFrame:
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))


def joined_by_hash(rows: DataFrame, narrow: DataFrame, key: list[str]) -> DataFrame:
    """``narrow``, one row for each ``key``, joined to ``rows`` without a sort; null keys meet each other.

    A task holds the narrow rows of its share of the keys, so their number bounds its memory.
    """
    other = narrow.select(*[F.col(k).alias(f"_{k}") for k in key], *[c for c in narrow.columns if c not in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(other.hint("shuffle_hash"), same).drop(*[f"_{k}" for k in key])
