"""Mitigation levels counted over a stream of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.session import scratch_path

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, pattern: str = "events*.parquet") -> DataFrame:
    """Events as a stream; each names the query it repeats."""
    stream = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", pattern).parquet(path)
    return stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("query_id"))


def level_counts(events: DataFrame, levels: DataFrame) -> DataFrame:
    """Running count per level. ``levels (query_id, mitigation_level)`` should be a written
    table, as every micro-batch reads it."""
    return events.join(levels, "query_id").groupBy("mitigation_level").agg(F.count("*").alias("queries"))


def daily_level_counts(events: DataFrame, levels: DataFrame, late: str | None = "1 hour") -> DataFrame:
    """Count per level and day; a day closes when the watermark passes its end. ``late`` is None if the events have a watermark."""
    return (
        (events.withWatermark("ts", late) if late else events)
        .join(levels, "query_id")
        .groupBy(F.window("ts", "1 day").alias("day"), "mitigation_level")
        .agg(F.count("*").alias("queries"))
        .select(F.col("day.start").alias("day"), "mitigation_level", "queries")
    )


def closed_daily_counts(events: DataFrame, levels: DataFrame, late: str = "1 hour") -> DataFrame:
    """As ``daily_level_counts``, with each ``event_id`` counted once.

    An event that is repeated counts once as long as its repeats arrive before the watermark passes it; later ones, like
    all events behind the watermark, are dropped. Days that are not closed yet are not told.
    """
    return daily_level_counts(events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]), levels, None)


def advance(counts: DataFrame, place: str) -> DataFrame:
    """Take in all events there are by now and return all rows told so far; ``place`` keeps rows and progress."""
    writer = counts.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{place}/progress")
    writer.format("parquet").option("path", f"{place}/rows").start().awaitTermination()
    return counts.sparkSession.read.schema(counts.schema).parquet(f"{place}/rows")


def run_to_end(counts: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Process all input there is and return the result table.

    The state and the progress are kept in the shared folder. Complete results go to memory:
    one row per level. Appended results are unbounded and go to files.
    """
    spark = counts.sparkSession
    place = scratch_path(spark, name)
    writer = counts.writeStream.outputMode(mode).trigger(availableNow=True)
    writer = writer.option("checkpointLocation", f"{place}/progress")
    if mode == "append":
        writer.format("parquet").option("path", f"{place}/rows").start().awaitTermination()
        return spark.read.schema(counts.schema).parquet(f"{place}/rows")
    table = place.rsplit("/", 1)[1].replace("-", "_")
    writer.format("memory").queryName(table).start().awaitTermination()
    return spark.table(table)
