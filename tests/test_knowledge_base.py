import json

import pytest
from pyspark.sql import functions as F

from rejoinder.operators import evaluation, knowledge_base as kb_ops, retrieval
from rejoinder.plans import build_knowledge_base as kb_build
from rejoinder.plans.fixtures import Inputs
from rejoinder.sources import files
from rejoinder.streaming import mitigation

SF = "/root/testdata/sf0.001"


def test_stats_of_empty_tables(spark):
    empty = spark.range(0)
    row = kb_ops.kb_stats(empty, spark.range(2), empty, empty).first()
    assert tuple(row) == (0, 2, 0, 0)


def test_unlinked(spark):
    paragraphs = spark.createDataFrame([(1,)], "id bigint")
    sentences = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id bigint, paragraph_id bigint")
    counters = spark.createDataFrame([(1, 1), (2, None), (3, 7)], "id bigint, counters_id bigint")
    found = {r.measure: r.rows for r in kb_ops.unlinked_nodes(sentences, counters, paragraphs).collect()}
    assert found == {"counters_with_id": 2, "sentences_unlinked": 2, "counters_unlinked": 2}


def test_page_after_id(spark):
    df = spark.range(50)
    assert [r.id for r in kb_ops.page_after_id(df, 9, 3).collect()] == [10, 11, 12]
    assert [r.id for r in kb_ops.page_by_id(df, 10, 3).collect()] == [10, 11, 12]


def test_rebuild_replaces(spark, tmp_path):
    kb = Inputs(spark, SF).kb()
    made = {"paragraphs": kb.paragraphs, "sentences": kb.sentences, "counters": kb.counters}
    kb_build.rebuild(made, str(tmp_path))
    kb_build.rebuild({**made, "paragraphs": kb.paragraphs.filter("id < 10")}, str(tmp_path))
    loaded = kb_build.load(spark, str(tmp_path))
    assert loaded.paragraphs.count() == 10
    assert loaded.sentences.count() == kb.sentences.count()


def test_pretty_json_array(spark, tmp_path):
    debate = {
        "topic": "t", "position": "p", "full_debate": [{"role": "proponent", "content": "a\nb"}, {"role": "opponent", "content": "c"}],
    }
    (tmp_path / "d.json").write_text(json.dumps([debate, {"topic": "u"}], indent=2))
    rows = files.scan_debates(spark, str(tmp_path / "d.json"), pretty=True).orderBy("topic").collect()
    assert [r.topic for r in rows] == ["t", "u"]
    assert rows[0].full_debate[0].content == "a\nb"
    assert files.scan_debates(spark, str(tmp_path / "missing.json")).count() == 0


def test_csv_texts_survive(spark, tmp_path):
    nasty = [(1, ' lead "quoted", and\ncomma '), (2, ""), (3, None), (4, "a\\b")]
    path = str(tmp_path / "c")
    files.write_csv(spark.createDataFrame(nasty, "id bigint, content string"), path)
    rows = files.load_typed_csv(spark, path, {"id": "bigint", "content": "string"}).orderBy("id").collect()
    assert [tuple(r) for r in rows] == nasty


def test_missing_topic_column(spark, tmp_path):
    files.write_csv(spark.range(3), str(tmp_path / "c"))
    assert files.distinct_topics(spark, str(tmp_path / "c")).count() == 0


def test_example_lines(spark):
    lines = [
        (1, '{"topic": " t ", "content": "a"}'), (2, ""), (3, "{broken"), (4, '{"topic": "  ", "content": "a"}'),
        (5, '{"topic": "t"}'), (6, '{"topic": "u", "content": "b"} extra'), (7, '{"topic": "a", "content": "c"}'),
    ]
    good, bad = files.parse_examples(spark.createDataFrame(lines, "line bigint, value string"))
    assert sorted((r.line, r.topic) for r in good.collect()) == [(1, "t"), (5, "t"), (7, "a")]
    assert sorted(r.line for r in bad.collect()) == [3, 6]
    stats = kb_ops.import_stats(good).first()
    assert tuple(stats) == (2, 2, 1)
    known = spark.createDataFrame([(40, "x", "old")], "id bigint, content string, topic string")
    added = kb_ops.import_examples(good, known).orderBy("id").collect()
    assert [(r.id, r.topic, r.content) for r in added] == [(41, "t", "a"), (42, "a", "c")]


def test_read_lines_in_file_order(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("\n".join(f"line {n}" for n in range(500)))
    rows = files.read_lines(spark, str(tmp_path / "x.jsonl")).orderBy("line").collect()
    assert [r.value for r in rows] == [f"line {n}" for n in range(500)]


def test_benchmark_names(spark):
    df = spark.createDataFrame([("a", "b")], "HATE_SPEECH string, other string")
    assert files.scan_benchmark(df).columns == ["hate_speech", "other"]
    with pytest.raises(ValueError):
        files.scan_benchmark(df.drop("HATE_SPEECH"))


def test_removed_edges(spark):
    paragraphs = spark.createDataFrame([(1, True), (2, False), (3, None)], "id bigint, is_synthetic boolean")
    edges = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "paragraph_id bigint, sentence_id bigint")
    kept, kept_edges, removed = kb_ops.remove_synthetic(paragraphs, edges)
    assert sorted(r.id for r in kept.collect()) == [2, 3]
    assert sorted(r.sentence_id for r in kept_edges.collect()) == [20, 30]
    assert removed.first().removed == 1


def test_fill_takes_lowest_counter_of_topic(spark):
    results = spark.createDataFrame(
        [(1, 1, 2, 5, "t"), (1, 2, 1, 6, "t"), (1, 3, 2, 7, None), (1, 4, 2, 8, "u")],
        "query_id bigint, rank int, layer int, id bigint, topic string",
    )
    for name, kind in (("counter_id", "bigint"), ("counter_content", "string"), ("directness", "double"),
                       ("evidence_quality", "double"), ("persuasiveness", "double")):
        results = results.withColumn(name, F.lit(None).cast(kind))
    counters = spark.createDataFrame(
        [(9, "t", "nine", 1.0, 1.0, 1.0), (3, "t", "three", 2.0, 2.0, 2.0)],
        "id bigint, topic string, content string, directness double, evidence_quality double, persuasiveness double",
    )
    found = {r.id: r.counter_id for r in retrieval.fill_counters(results, counters, 4).collect()}
    assert found == {5: 3, 6: None, 7: None, 8: None}


TOX = "pair_id bigint, hate_scores map<string, double>, counter_scores map<string, double>, error string"


def test_toxicity_with_errors_and_zero_base(spark):
    rows = [
        (1, None, None, "x"),
        (2, {"a": 0.0, "b": 0.5}, {"a": 0.0, "b": 0.1}, None),
        (3, {"a": 0.0, "b": 0.2}, {"a": 0.4, "b": 0.2}, None),
    ]
    df = spark.createDataFrame(rows, TOX)
    means = {(r.side, r.attribute): (r.avg_all, r.avg_valid) for r in evaluation.toxicity_averages(df).collect()}
    assert means[("hate", "b")] == (pytest.approx(0.7 / 3), pytest.approx(0.35))
    drops = {r.attribute: r for r in evaluation.toxicity_reduction(df).collect()}
    assert drops["a"].avg_reduction_percent == -50.0
    assert drops["b"].samples_with_reduction == 0.5


def test_strata_quota(spark):
    df = spark.range(300).select(
        "id", F.when(F.col("id") < 100, "hot").when(F.col("id") < 290, "warm").otherwise(None).alias("s")
    )
    got = evaluation.stratified_sample(df, "s", "id", n=31).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"hot": 10, "warm": 19, None: 1}


def test_quality_summary_of_nothing(spark):
    df = spark.createDataFrame([], "harmful_subtotal double, counter_subtotal double")
    row = evaluation.quality_summary(df).first()
    assert (row.total_pairs, row.average_counterspeech_score, row.high_quality_share) == (0, 0.0, 0.0)


def test_stream_equals_batch_and_daily_windows_close(spark):
    i = Inputs(spark, SF)
    levels = i.text_queries().select("query_id", F.when(F.col("query_id") % 2 == 0, "none").otherwise("mild").alias("mitigation_level"))
    events = mitigation.read_events(spark, SF)
    streamed = mitigation.run_to_end(mitigation.level_counts(events, levels), "counts")
    batch = i.table("events").join(levels, F.col("user_id") == F.col("query_id")).groupBy("mitigation_level").count()
    expected = {r.mitigation_level: r["count"] for r in batch.collect()}
    assert {r.mitigation_level: r.queries for r in streamed.collect()} == expected
    daily = mitigation.run_to_end(mitigation.daily_level_counts(mitigation.read_events(spark, SF), levels), "daily", "append")
    closed = daily.groupBy("mitigation_level").agg(F.sum("queries").alias("n")).collect()
    assert all(0 < r.n <= expected[r.mitigation_level] for r in closed)


def test_stamp(spark):
    row = files.stamp_run(spark.range(1), {"a": "b"}).first()
    assert row.run_arguments == {"a": "b"} and row.run_version == "1.0.0"
    assert files.stamp_run(spark.range(1), {}).first().run_arguments == {}
