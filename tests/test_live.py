"""Streams with late, repeated and unordered rows, restarts, and versions of the knowledge base."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rejoinder.operators import transcripts
from rejoinder.plans import grow_knowledge_base as grow
from rejoinder.streaming import mitigation
from rejoinder.streaming import transcripts as live

START = dt.datetime(2024, 5, 1)
ROLES = {"p": "proponent", "o": "opponent", "s": "system"}


def message(debate, turn, role, content):
    return debate, turn, ROLES[role], content, START + dt.timedelta(minutes=turn)


def debate(number, script):
    return [message(number, turn, role, None if role == "n" else f"{role}{number}.{turn}") for turn, role in enumerate(script)]


DEBATES = debate(1, "popo") + debate(2, "sppoosp") + debate(3, "o") + debate(4, "p" + "s" * 30 + "o" + "po" * 20)
EMPTY = [message(5, 0, "p", ""), message(5, 1, "o", "x"), message(6, 0, "p", None), message(6, 1, "o", "y"), message(7, 0, "p", "z"), message(7, 1, "o", None)]


def plain(row):
    """The rows with missing texts as None, whatever the streams make of them."""
    return tuple(None if x is None or x != x else x for x in row)


def test_stream_of_messages_equals_the_batch_walk(spark, tmp_path):
    rows = DEBATES + EMPTY
    folder, place = str(tmp_path / "in"), str(tmp_path / "live")
    arrivals = [rows[1::2] + rows[1::4], rows[::2][::-1] + rows[:3], [message(99, 500, "s", None)], rows[5:9]]
    steps = []
    for arrived in arrivals:
        spark.createDataFrame(arrived, live.MESSAGE_SCHEMA).write.mode("append").parquet(folder)
        told = live.advance(live.live_transcripts(live.read_messages(spark, folder), "3 hours"), place)
        steps.append(told.count())
    batch = spark.createDataFrame(rows, live.MESSAGE_SCHEMA)
    want = transcripts.extract_pairs(batch).select("conv_id", "turn", "proponent", "opponent")
    assert sorted(map(repr, map(plain, live.pairs_told(told).collect()))) == sorted(map(repr, map(plain, want.collect())))
    states = transcripts.next_turn_state(batch, batch.select("conv_id").distinct()).drop("turn_focus")
    assert sorted(live.states_told(told).collect()) == sorted(states.collect())
    assert steps[0] == 0 and steps[2] == steps[3]  # rows wait for the watermark; what comes after it changes nothing


def test_watermark_tells_pairs_on_the_way(spark, tmp_path):
    folder, place = str(tmp_path / "in"), str(tmp_path / "live")
    found = []
    for arrived in ([message(1, 1, "o", "b"), message(1, 2, "p", "c"), message(1, 0, "p", "a")], [message(1, 30, "s", "")], [message(1, 3, "o", "late"), message(1, 31, "o", "d"), message(1, 90, "s", "")]):
        spark.createDataFrame(arrived, live.MESSAGE_SCHEMA).write.mode("append").parquet(folder)
        told = live.advance(live.live_transcripts(live.read_messages(spark, folder), "10 minutes"), place)
        found.append(sorted((r.turn, r.proponent, r.opponent) for r in live.pairs_told(told).collect()))
    assert found == [[], [(1, "a", "b")], [(1, "a", "b"), (31, "c", "d")]]


def test_daily_counts_close_once(spark, tmp_path):
    levels = spark.createDataFrame([(1, "mild"), (2, "none")], "query_id bigint, mitigation_level string")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    folder, place = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda day, hour: dt.datetime(2024, 5, day, hour)
    steps = []
    for arrived in (
        [(1, at(1, 3), 1), (1, at(1, 3), 1), (2, at(1, 5), 2), (3, at(2, 5), 1), (9, at(2, 5), 7)],
        [(3, at(2, 5), 1), (4, at(1, 23), 1), (5, at(2, 23), 1), (6, at(4, 0), 2)],
        [(7, at(9, 0), 2)],
    ):
        spark.createDataFrame([(*r, "", 0.0, "") for r in arrived], schema).write.mode("append").parquet(folder)
        events = mitigation.read_events(spark, folder, "*.parquet")
        told = mitigation.advance(mitigation.closed_daily_counts(events, levels), place)
        steps.append(sorted((r.day.day, r.mitigation_level, r.queries) for r in told.collect()))
    first = [(1, "mild", 1), (1, "none", 1)]
    second = [*first, (2, "mild", 2)]
    assert steps == [first, second, [*second, (4, "none", 1)]]


@pytest.fixture
def nodes(spark):
    paragraphs = spark.createDataFrame(
        [(n, f"text {n}", f"t{n % 3}", n, 1.0, 1.0, 1.0, 1.0, n == 5) for n in range(1, 8)],
        "id bigint, content string, topic string, source_debate bigint, representativeness double, coherence double, harmfulness double, quality_score double, is_synthetic boolean",
    )
    sentences = spark.createDataFrame([(n, n, [1.0]) for n in range(1, 10)], "id bigint, paragraph_id bigint, embedding array<float>")
    counters = spark.createDataFrame([(1, 5, "c", "t1"), (2, 6, "c", "new")], "id bigint, counters_id bigint, content string, topic string")
    return {"paragraphs": paragraphs, "sentences": sentences, "counters": counters}


LINES = [(0, '{"topic": "new", "content": "one"}'), (1, "no json"), (2, '{"topic": "t1", "content": "two"}'), (3, '{"topic": "new"}'), (4, " ")]


def sizes(spark, version):
    return {r.name: r.rows for r in grow.counts(spark, version).collect()}


def test_versions_of_the_knowledge_base(spark, tmp_path, nodes):
    root = str(tmp_path / "kb")
    assert grow.current(spark, root) == grow.Version(0, {})
    first = grow.import_nodes(spark, nodes, root)
    lines = spark.createDataFrame(LINES, "line bigint, value string")
    second, stats, rejected = grow.grow(spark, root, lines)
    assert tuple(stats.first()) == (2, 2, 1)
    assert [r.value for r in rejected.collect()] == ["no json"]
    kb = grow.load(spark, root)
    assert sorted((r.id, r.content, r.topic) for r in kb.paragraphs.filter("id > 7").collect()) == [(8, "one", "new"), (9, "two", "t1")]
    assert sizes(spark, second)["counter_topic"] == 2 and sizes(spark, first)["counter_topic"] == 1
    third = grow.remove_synthetic(spark, root)
    assert [sizes(spark, v)["paragraphs"] for v in (first, second, third)] == [7, 9, 6]
    assert sizes(spark, third)["countered_with"] == 1 and sizes(spark, third)["topics"] == 4
    assert grow.current(spark, root) == third and grow.at(spark, root, 1) == first


def test_a_failed_run_leaves_the_old_version(spark, tmp_path, nodes):
    root = str(tmp_path / "kb")
    first = grow.import_nodes(spark, nodes, root)
    bad = spark.createDataFrame(LINES, "line bigint, value string").withColumn(
        "value", F.when(F.col("line") == 2, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("value"))
    )
    with pytest.raises(Exception, match="lost"):
        grow.grow(spark, root, bad)
    assert grow.current(spark, root) == first
    assert grow.load(spark, root).paragraphs.count() == 7


def test_two_writers_do_not_make_one_version(spark, tmp_path, nodes):
    root = str(tmp_path / "kb")
    first = grow.import_nodes(spark, nodes, root)
    second = grow.remove_synthetic(spark, root)
    with pytest.raises(grow.VersionTaken):
        grow._publish(spark, root, first, first.tables)
    assert grow.current(spark, root) == second
