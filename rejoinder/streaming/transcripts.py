"""Live transcripts: messages that arrive late, repeated and out of order, paired as the batch walk pairs them.

Each debate has its own state: the messages that wait for their turn, the last message said by one of the two
roles, and how far the debate has come. A message waits until the watermark has passed its time; then all
waiting messages up to the watermark are walked in turn order. So a message may arrive as late as the watermark
allows, after messages of later turns; one that arrives still later is dropped, and so is a turn that was walked already.
Times have to grow with the turns of a debate.

State is kept in RocksDB below the checkpoint of the query, so a query that is started anew goes on
where it stopped and tells no pair twice (rows go to a sink with exactly-once files).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rejoinder.functions import fixed_values as fixed

MESSAGE_SCHEMA = "conv_id bigint, turn bigint, role string, content string, ts timestamp"
TOLD_SCHEMA = "conv_id bigint, kind string, turn bigint, proponent string, opponent string, messages bigint, last_role string"
SPEAKERS = ("proponent", "opponent")
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LiveDebate(StatefulProcessor):
    """Pairs and progress of one debate."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "turn bigint", "role string, content string, at bigint")
        self.before = handle.getValueState("before", "role string, content string")
        self.progress = handle.getValueState("progress", "messages bigint, turn bigint, last_role string, walked_to bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = self.progress.get()[1] if self.progress.exists() else None
        times = set()
        for batch in rows:
            at = batch["ts"].astype("datetime64[ms]").astype("int64")
            for turn, role, content, when in zip(batch["turn"], batch["role"], batch["content"], at, strict=True):
                if done is None or turn > done:
                    self.waiting.updateValue((int(turn),), (role, content, int(when)))
                    times.add(int(when))
        for when in times:
            self.handle.registerTimer(when)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        messages, turn, last_role, walked_to = self.progress.get() if self.progress.exists() else (0, -1, None, -1)
        if walked_to >= now:  # another timer of this debate has walked up to here
            return
        ready = sorted((k[0], *v) for k, v in self.waiting.iterator() if v[2] <= now)
        role, content = self.before.get() if self.before.exists() else (None, None)
        told = []
        for turn, speaker, text, _ in ready:
            self.waiting.removeKey((turn,))
            messages, last_role = messages + 1, speaker
            if speaker in SPEAKERS:
                if speaker == "opponent" and role == "proponent" and content:
                    told.append((key[0], "pair", turn, content, text, None, None))
                role, content = speaker, text
        self.progress.update((messages, turn, last_role, now))
        if ready:
            if role is not None:
                self.before.update((role, content))
            told.append((key[0], "state", turn, None, None, messages, last_role))
            yield pd.DataFrame(told, columns=["conv_id", "kind", "turn", "proponent", "opponent", "messages", "last_role"]).astype(
                {"messages": "Int64"}
            )

    def close(self) -> None:
        pass


def live_transcripts(messages: DataFrame, late: str) -> DataFrame:
    """Rows of kind ``pair`` and ``state`` from a stream of ``MESSAGE_SCHEMA``; ``late`` is how late a message may be."""
    held = messages.filter("conv_id is not null and turn is not null and ts is not null").withWatermark("ts", late)
    return held.groupBy("conv_id").transformWithStateInPandas(LiveDebate(), TOLD_SCHEMA, "Append", "EventTime")


def advance(told: DataFrame, place: str) -> DataFrame:
    """Take in all messages there are by now and return all rows told so far; ``place`` keeps rows and progress."""
    spark = told.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = told.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{place}/progress")
        writer.format("parquet").option("path", f"{place}/rows").start().awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.schema(told.schema).parquet(f"{place}/rows")


def pairs_told(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind") == "pair").select("conv_id", "turn", "proponent", "opponent")


def states_told(rows: DataFrame, max_turns: int = fixed.MAX_TURNS) -> DataFrame:
    """The latest state of each debate, as ``transcripts.next_turn_state`` tells it."""
    latest = rows.filter(F.col("kind") == "state").groupBy("conv_id").agg(
        F.max("messages").alias("messages"), F.max_by("last_role", "messages").alias("_last")
    )
    return latest.select(
        "conv_id", "messages",
        F.when(F.col("_last") == "proponent", "opponent").otherwise("proponent").alias("next_speaker"),
        F.least(F.floor(F.col("messages") / 2) + 1, F.lit(max_turns)).cast("bigint").alias("turn_number"),
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages as a stream from a folder that grows."""
    return spark.readStream.schema(MESSAGE_SCHEMA).parquet(path)
