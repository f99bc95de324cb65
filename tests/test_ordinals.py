"""Dense numbers and running totals."""

import random

from pyspark.sql import functions as F

from rejoinder.operators import nodes
from rejoinder.operators.ordinals import with_ordinal, with_total_before


def test_numbers_by_narrow_key(spark):
    rows = [(n, float(n % 7), f"text {n}") for n in random.Random(3).sample(range(10_000), 500)] + [(None, None, "no key")]
    df = spark.createDataFrame(rows, "k bigint, q double, text string").repartition(5)
    got = with_ordinal(df, [F.desc("q"), F.asc("k")], "place", key=["q", "k"])
    assert got.columns == ["k", "q", "text", "place"]
    wanted = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0] if r[0] is not None else -1))
    assert [(r.k, r.q, r.text) for r in sorted(got.collect(), key=lambda r: r.place)] == wanted
    assert sorted(r.place for r in got.collect()) == list(range(1, len(rows) + 1))


def test_repeated_keys_number_whole_rows(spark):
    df = spark.createDataFrame([(n % 3, f"t{n}") for n in range(12)], "k bigint, text string")
    got = sorted(with_ordinal(df, ["k"], "place", key=["k"]).collect(), key=lambda r: r.place)
    assert [r.k for r in got] == [0] * 4 + [1] * 4 + [2] * 4
    assert [r.place for r in got] == list(range(1, 13)) and len({r.text for r in got}) == 12


def test_empty_table(spark):
    df = spark.createDataFrame([], "k bigint, text string")
    assert with_ordinal(df, ["k"], "place", key=["k"]).collect() == []
    assert with_total_before(df.select("k", F.lit(1).alias("v")), ["k"], "v", "before").collect() == []


def test_total_before(spark):
    values = [(n, n % 5) for n in range(300)]
    df = spark.createDataFrame(values, "k bigint, v bigint").repartition(7)
    got = {r.k: r.before for r in with_total_before(df, ["k"], "v", "before").collect()}
    assert got == {n: sum(v for _, v in values[:n]) for n in range(300)}


def operators(plan):
    yield plan
    children = plan.children()
    for n in range(children.size()):
        yield from operators(children.apply(n))


def test_texts_are_in_no_sort(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("pair_id"), F.lit("One. Two! ").alias("text")).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    numbered = nodes.assign_ids(df)
    paragraphs = numbered.select("id", F.col("text").alias("content"))
    told = nodes.build_sentences(paragraphs)
    for got in (numbered, told):
        found = list(operators(got._jdf.queryExecution().executedPlan().initialPlan()))
        assert any(plan.nodeName() == "ShuffledHashJoin" for plan in found)
        ordered = [p for p in found if p.nodeName() == "Sort" or "rangepartitioning" in p.simpleString(100).split(",")[0]]
        assert not any(name in p.output().mkString() for p in ordered for name in ("text", "content"))
    rows = sorted(told.collect())
    assert [(r.id, r.content, r.paragraph_id) for r in rows[:3]] == [(1, "One.", 1), (2, "Two!", 1), (3, "One.", 2)]
    assert [r.id for r in rows] == list(range(1, 101))


def test_sentences_of_null_and_blank_paragraphs(spark):
    df = spark.createDataFrame([(1, "A. B."), (2, None), (3, "  "), (4, "C.")], "id bigint, content string")
    rows = sorted(nodes.build_sentences(df).collect())
    assert [(r.id, r.content, r.paragraph_id) for r in rows] == [(1, "A.", 1), (2, "B.", 1), (3, "C.", 4)]
