import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rejoinder.operators import lexical, retrieval, semantic
from rejoinder.operators.ordinals import with_ordinal
from rejoinder.plans.fixtures import Inputs

SF = "/root/testdata/sf0.001"


def texts(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, content string, is_synthetic boolean")
    return df


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["tree", "trees", "river", "of", "the", "it", "is", "so", "stone", "Éclair", "at", "rivers"]
    docs = [
        (n, rng.choice([" ", "  "]).join(rng.choice(words) for _ in range(rng.randint(1, 30))), rng.choice([None, True, False]))
        for n in range(80)
    ]
    docs += [(900 + n, docs[0][1], None) for n in range(40)]  # a third of the texts are copies
    queries = [(1, "The river of stone"), (2, "it is"), (3, "tree TREE river"), (4, "éclair"), (5, "it is  so"), (6, "the"), (7, "zzzz")]
    return docs, queries


def by_hand(docs, queries, version):
    from rejoinder.functions import fixed_values as fixed
    from test_functions import phrases_of

    found = {}
    for qid, query in queries:
        low = query.lower()
        words = low.split()
        keys = [w for w in words if len(w) > 3 and (version == 1 or w not in fixed.STOP_WORDS)]
        phrases = phrases_of(words) if version == 2 else []
        for doc, content, synthetic in docs:
            body = content.lower()
            if not (any(t in body for t in keys + phrases) if keys + phrases else low in body):
                continue
            score = (5 if version == 1 else 10) * (low in body)
            score += 3 * sum(p in body for p in phrases) + sum(k in body for k in keys)
            found[(qid, doc)] = (2 if synthetic else 1, score)
    return found


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("block_chars", [12, 10_000])
def test_lexical_equals_brute_force(spark, corpus, version, block_chars):
    docs, queries = corpus
    q = spark.createDataFrame(queries, "query_id bigint, query string")
    score = lexical.score_v1 if version == 1 else lexical.score_v2
    found = score(q, texts(spark, docs), block_chars=block_chars).collect()
    assert {(r.query_id, r.id): (r.layer, r.score) for r in found} == by_hand(docs, queries, version)
    assert len(found) == len({(r.query_id, r.id) for r in found})


@pytest.mark.parametrize("hits_at_once", [5, 100_000])
def test_top_hits_equal_brute_force(spark, corpus, hits_at_once, monkeypatch):
    monkeypatch.setattr(lexical, "HITS_AT_ONCE", hits_at_once)
    docs, queries = corpus
    queries = queries + [(100 + n, queries[0][1]) for n in range(4)]  # copies among the queries too
    q = spark.createDataFrame(queries, "query_id bigint, query string")
    expected = {}
    for (qid, doc), (layer, score) in by_hand(docs, queries, 2).items():
        expected.setdefault((qid, layer), []).append((-score, doc))
    lists = {}
    for (qid, layer), hits in sorted(expected.items()):
        lists.setdefault(qid, []).extend(doc for _, doc in sorted(hits)[:5])
    found = {}
    for r in lexical.phrase_hits(q, texts(spark, docs).repartition(3), 5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.id)
    assert found == lists


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    sentences = rng.normal(size=(150, 8)).astype(np.float32)
    sentences[100:] = sentences[7]  # a third of the vectors are copies
    queries = rng.normal(size=(9, 8)).astype(np.float32)
    queries[0] = sentences[7]
    return queries, sentences


@pytest.mark.parametrize("block_values, tile", [(8, 2_000_000), (10_000, 20), (10_000, 2_000_000)])
def test_nearest_equals_brute_force(spark, vectors, block_values, tile, monkeypatch):
    monkeypatch.setattr(semantic, "TILE_VALUES", tile)
    queries, sentences = vectors
    q = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    rows = [(n, v.tolist()) for n, v in enumerate(sentences)] + [(999, [1.0]), (998, None)]
    s = spark.createDataFrame(rows, "id bigint, embedding array<float>").repartition(3)
    found = {}
    for r in semantic.nearest_sentences(q, s, 6, block_values).orderBy("query_id", "place").collect():
        found.setdefault(r.query_id, []).append(r.sentence_id)
    a = queries.astype(float) / np.linalg.norm(queries.astype(float), axis=1, keepdims=True)
    b = sentences.astype(float) / np.linalg.norm(sentences.astype(float), axis=1, keepdims=True)
    sims = np.round(a @ b.T, 9)
    expected = {n: sorted(range(150), key=lambda j: (-sims[n, j], j))[:6] for n in range(9)}
    assert found == expected
    assert found[0] == [7, 100, 101, 102, 103, 104]


def test_bad_vectors_spoil_nothing(spark, vectors):
    queries, sentences = vectors
    schema = "query_id bigint, embedding array<float>"
    good = [(n, v.tolist()) for n, v in enumerate(queries)]
    bad = [(50, [1.0] * 9), (51, [1.0] * 7 + [None]), (52, [1.0] * 7 + [float("nan")]), (53, None)]
    rows = [(n, v.tolist()) for n, v in enumerate(sentences)]
    holes = [(300 + n, [None] + [1.0] * 7) for n in range(20)] + [(400, [float("inf")] * 8), (401, [1.0] * 9)]

    def nearest(asked, known, **options):
        s = spark.createDataFrame(known, "id bigint, embedding array<float>").coalesce(1)
        found = semantic.nearest_sentences(spark.createDataFrame(asked, schema), s, 6, **options)
        return sorted((r.query_id, r.place, r.sentence_id) for r in found.collect())

    assert nearest(good + bad, holes + rows) == nearest(good, rows)
    assert nearest(good + bad, holes + rows, dimension=9) == [(50, 1, 401)]
    told = semantic.rejected_vectors(spark.createDataFrame(good + bad, schema), "query_id", 8).collect()
    assert {r.query_id: r.fault for r in told} == {50: "dimension", 51: "not finite", 52: "not finite", 53: "missing"}


def test_no_queries(spark):
    q = spark.createDataFrame([], "query_id bigint, embedding array<float>")
    s = spark.createDataFrame([(1, [1.0])], "id bigint, embedding array<float>")
    assert semantic.nearest_sentences(q, s, 3).count() == 0


def test_order_by_is_checked(spark):
    with pytest.raises(ValueError):
        semantic.semantic_hits(None, None, None, order_by="other")
    with pytest.raises(ValueError):
        retrieval.search(None, None, "other")


@pytest.mark.parametrize("method", ["syntax", "semantic", "hybrid"])
def test_hits_are_few_and_unique(spark, method):
    i = Inputs(spark, SF)
    hits = retrieval.search(i.queries(), i.kb(), method).collect()
    per_query = {}
    for r in hits:
        per_query.setdefault(r.query_id, []).append(r)
    assert per_query
    for rows in per_query.values():
        assert len(rows) <= 10
        assert len({r.id for r in rows}) == len(rows)
        assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1))


def test_threshold_keeps_a_subset(spark):
    i = Inputs(spark, SF)
    nearest = semantic.nearest_sentences(i.queries(), i.sentences(), 15)
    kept = semantic.above_threshold(nearest, 0.3)
    assert 0 < kept.count() < nearest.count()
    assert kept.agg(F.min("similarity")).first()[0] >= 0.3


def test_plans_have_no_pairwise_join_and_limit_before_the_shuffle(spark):
    i = Inputs(spark, SF)
    for hits in (
        lexical.phrase_hits(i.text_queries(), i.paragraphs()),
        semantic.nearest_sentences(i.queries(), i.sentences(), 15),
    ):
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "WindowGroupLimit" in plan


def test_ordinals_are_dense_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50).alias("key"), "id"
    ).repartition(7)
    rows = with_ordinal(df, ["key", "id"]).orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(1, 3001))
    assert [(r.key, r.id) for r in rows] == sorted((r.key, r.id) for r in rows)
