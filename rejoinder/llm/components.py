"""Connected components of a table of links, by alternating large and small stars.

No neighbourhood is collected: a star needs the smallest neighbour of each node, a partial
aggregate, and a join back, which the adaptive skew join may split at a hub. Each round is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import drop_path
from rejoinder.session import scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(u, root): for every node of ``links`` (columns u, v, of any order) that is not the smallest of its component, the smallest.

    Self links and repeated links do no harm; an empty table gives an empty table.
    """
    spark = links.sparkSession
    edges = links.select("u", "v").where("u <> v").distinct()
    last_path = None
    while True:
        path = scratch_path(spark, "stars")
        _small_star(_large_star(edges)).distinct().write.parquet(path)
        edges = spark.read.parquet(path)
        if last_path:
            drop_path(spark, last_path)
        last_path = path
        if _stars_only(edges):
            return edges.select("u", F.col("v").alias("root"))


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none if it is a smaller neighbour itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ups = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("root"))
    return ups.where("ups > 1 OR ups = 1 AND root = 1").isEmpty()
