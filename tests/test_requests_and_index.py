import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rejoinder.operators import requests, retrieval, semantic, vector_index
from rejoinder.session import scratch_path, written, written_by

VECTORS = "id bigint, embedding array<float>"


def vectors(count, seed=0, dimension=16, groups=12):
    """Vectors around a few directions; a third of them around one."""
    chance = np.random.default_rng(seed)
    heads = chance.normal(size=(groups, dimension))
    group = np.where(chance.random(count) < 1 / 3, 0, chance.integers(0, groups, count))
    return (heads[group] + 0.4 * chance.normal(size=(count, dimension))).astype(np.float32)


def frame(spark, rows, first=0):
    return spark.createDataFrame([(first + n, [float(x) for x in v]) for n, v in enumerate(rows)], VECTORS)


def test_index_reaches_the_wanted_recall_with_few_lists(spark):
    sentences = frame(spark, vectors(4000)).repartition(5).cache()
    asked = frame(spark, vectors(60, seed=9)).withColumnRenamed("id", "query_id").cache()
    index, rejected = vector_index.build_index(sentences, 16, scratch_path(spark, "index"), k=15)
    assert rejected.count() == 0
    assert index.probes < len(index.centroids) / 2
    stored = spark.read.parquet(index.path)
    assert stored.count() == stored.select("id").distinct().count() == 4000
    exact = semantic.nearest_sentences(asked, sentences, 15)
    assert vector_index.recall_of(vector_index.indexed_nearest(index, asked, 15), exact).first().recall >= 0.95
    every = vector_index.indexed_nearest(index, asked, 15, probes=len(index.centroids))
    key = ["query_id", "sentence_id", "similarity", "place"]
    assert sorted(every.select(key).collect()) == sorted(exact.select(key).collect())


def test_index_is_built_in_a_session_without_arrow(spark):
    name = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        sentences = frame(spark, vectors(300))
        index, rejected = vector_index.build_index(sentences, 16, scratch_path(spark, "index"), k=5)
        asked = sentences.filter("id < 20").withColumnRenamed("id", "query_id")
        exact = semantic.nearest_sentences(asked, sentences, 5)
        told = vector_index.recall_of(vector_index.indexed_nearest(index, asked, 5), exact).first()
        assert rejected.count() == 0
        assert (told.queries, told.wanted) == (20, 100) and told.recall >= 0.9
    finally:
        spark.conf.set(name, before)


def test_index_of_hard_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0]), (6, [float("nan"), 1.0]), (7, [0.0, 1.0])]
    index, rejected = vector_index.build_index(spark.createDataFrame(rows, VECTORS), 2, scratch_path(spark, "index"), lists=2)
    assert sorted(map(tuple, rejected.collect())) == [(4, "missing"), (5, "dimension"), (6, "not finite")]
    asked = spark.createDataFrame([(1, [2.0, 0.0]), (2, None), (3, [1.0, 2.0, 3.0])], "query_id bigint, embedding array<float>")
    found = vector_index.indexed_nearest(index, asked, 2, probes=2).collect()
    assert [(r.query_id, r.sentence_id, r.place) for r in found] == [(1, 1, 1), (1, 2, 2)]
    none, _ = vector_index.build_index(spark.createDataFrame([], VECTORS), 2, scratch_path(spark, "index"))
    assert vector_index.indexed_nearest(none, asked, 2).collect() == []


def test_recall_counts_a_neighbour_once_where_ids_repeat(spark):
    exact = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 3)], "query_id bigint, sentence_id bigint")
    found = exact.filter("sentence_id < 3")
    assert tuple(vector_index.recall_of(found, exact).first()) == (1, 4, 3, 0.75)


def test_search_falls_back_for_queries_without_a_usable_vector(spark):
    paragraphs = spark.createDataFrame(
        [(n, f"text {n}", "News today" if n % 2 else "Sports", 5.0, None) for n in range(40)],
        "id bigint, content string, topic string, quality_score double, is_synthetic boolean",
    )
    sentences = frame(spark, vectors(40)).withColumn("paragraph_id", F.col("id"))
    good = [float(x) for x in vectors(40)[3]]
    queries = spark.createDataFrame(
        [(1, "sports", good), (2, "news", None), (3, "SPORTS", good[:4]), (4, "no topic", None), (5, "today", [float("inf")] * 16), (6, "x", good)],
        "query_id bigint, query string, embedding array<float>",
    )
    kb = retrieval.KnowledgeBase(paragraphs.select(F.col("topic").alias("name")).distinct(), paragraphs, sentences, None)
    found = retrieval.search(queries, kb, "semantic").collect()
    by_vector = {r.query_id for r in found if r.similarity_score < 1.0}
    assert by_vector == {1, 6}
    named = {q: sorted(r.id for r in found if r.query_id == q) for q in (2, 3, 4, 5)}
    assert named == {2: list(range(1, 21, 2)), 3: list(range(0, 20, 2)), 4: [], 5: list(range(1, 21, 2))}


@pytest.fixture
def wanted(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, ""), (5, None), (6, "c" * 100_000)], "n int, t string")
    both = [requests.as_requests(rows, kind, F.col("t"), F.col("n")) for kind in ("embedding", "toxicity")]
    return both[0].unionByName(both[1])


def test_equal_texts_are_asked_once(spark, wanted, tmp_path):
    path = str(tmp_path / "ledger")
    empty = spark.createDataFrame([], requests.LEDGER_SCHEMA)
    first = requests.open_requests(wanted, empty).collect()
    assert sorted((r.kind, r.payload[:1], r.owners, r.tries) for r in first) == [
        (kind, t, n, 0) for kind in ("embedding", "toxicity") for t, n in (("a", 2), ("b", 1), ("c", 1))
    ]
    requests.append_ledger(requests.asked(requests.open_requests(wanted, empty), F.when(F.col("payload") == "b", "failed").otherwise("done")), path)
    again = requests.open_requests(wanted, spark.read.parquet(path)).collect()
    assert sorted((r.kind, r.payload, r.tries) for r in again) == [("embedding", "b", 1), ("toxicity", "b", 1)]
    for _ in range(2):
        requests.append_ledger(requests.asked(requests.open_requests(wanted, spark.read.parquet(path)), F.lit("failed")), path)
    assert requests.open_requests(wanted, spark.read.parquet(path)).collect() == []


def shuffles_of_texts(df):
    """The exchanges above the scan of the payload in the plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(n for n, line in enumerate(lines) if "Scan" in line and "payload" in line)
    depth, found = re.search(r"\w", lines[at]).start(), 0
    for line in reversed(lines[:at]):
        here = re.search(r"\w", line).start()
        if here < depth:
            depth, found = here, found + ("Exchange" in line)
    return found


def test_texts_written_by_their_key_are_not_shuffled_again(spark, wanted):
    twice = wanted.unionByName(wanted.filter("owner = '1'")).repartition(3)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        ledger = spark.createDataFrame([], requests.LEDGER_SCHEMA)
        plain = requests.open_requests(written(twice, "requests"), ledger)
        dealt = requests.open_requests(written_by(twice, requests.TEXT_KEY, "requests"), ledger)
        assert (shuffles_of_texts(plain), shuffles_of_texts(dealt)) == (1, 0)
        told = [sorted((r.kind, r.payload, r.owners, r.tries) for r in df.collect()) for df in (plain, dealt)]
        assert told[0] == told[1] and [r[2] for r in told[0]] == [3, 1, 1] * 2
    finally:
        spark.conf.set(name, before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("requests")]


def test_criteria_request(spark):
    pairs = spark.createDataFrame([(1, "p", "o"), (2, None, "o")], "pair_id int, proponent string, opponent string")
    one, none = requests.criteria_requests(pairs).orderBy("pair_id").collect()
    assert "message: p\nreply: o\n" in one.prompt and one.prompt.endswith("}")
    assert none.prompt is None
