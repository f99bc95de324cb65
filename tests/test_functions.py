import math

import duckdb
import pytest
from pyspark.sql import functions as F

from oracles import views
from rejoinder.functions import fixed_values as fixed
from rejoinder.functions import scores, text
from rejoinder.operators import assessment, knowledge_base, nodes
from rejoinder.sources.files import EVALUATED_SCHEMA


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in inputs.items())
    return spark.createDataFrame([tuple(inputs.values())], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "paragraph, expected",
    [
        ("no end", ["no end"]),
        ("What?! Yes.  No", ["What?!", "Yes.", "No"]),
        ("One.\nTwo!\n\nThree", ["One.", "Two!", "Three"]),
        ("3.5 stays. So", ["3.5 stays.", "So"]),
        ("end. \t ", ["end."]),
        ("  ", []),
        ("", []),
    ],
)
def test_sentences(spark, paragraph, expected):
    assert value(spark, text.sentences(F.col("t")), t=paragraph) == expected


@pytest.mark.parametrize("content, turn", [("Turn 12: go", 12), ("Opening Statement", 1), ("none", 1), ("Turn x Turn 3", 3)])
def test_turn_number(spark, content, turn):
    assert value(spark, text.turn_number(F.col("t")), t=content) == turn


def phrases_of(words):
    """The phrase rule, word by word."""
    found = []
    for size, longer in ((2, 5), (3, 8)):
        for start in range(len(words) - size + 1):
            part = words[start : start + size]
            if any(w not in fixed.STOP_WORDS for w in part) and len(" ".join(part)) > longer:
                found.append(" ".join(part))
    return found


@pytest.mark.parametrize("query", ["word", "of the", "is it", "The quick brown fox of the IS at this", "a  b\tc d e f g", "", " x "])
def test_phrases(spark, query):
    assert value(spark, text.phrases(F.col("t")), t=query) == phrases_of(query.lower().split())


@pytest.mark.parametrize(
    "query, expected",
    [
        ("Dangerous? Yes.", ["dangerous", "?", "yes", "."]),
        ("I don't, we'll; it's the boys' U.S. day...", ["i", "do", "n't", ",", "we", "'ll", ";", "it", "'s", "the", "boys", "'", "u.s.", "day", "..."]),
        ("'quoted' word", ["'", "quoted", "'", "word"]),
        ("1,000 at 10:30, or 2.5--more", ["1,000", "at", "10:30", ",", "or", "2.5", "--", "more"]),
        ("cannot (gonna) $5", ["can", "not", "(", "gon", "na", ")", "$", "5"]),
        ("isn’t 's ' x\'\'", ["is", "n’t", "'", "s", "'", "x'", "'"]),
        ("end of it.'", ["end", "of", "it", ".", "'"]),
        ("", []),
        ("  ", []),
    ],
)
def test_word_tokens(spark, query, expected):
    assert value(spark, text.word_tokens(F.col("t")), t=query) == expected
    con = duckdb.connect()
    con.execute("CREATE TABLE text_queries AS SELECT 1 AS query_id, ? AS query", [query])
    assert con.execute(views._word_list()).fetchone()[2] == expected


def test_a_mark_does_not_hide_a_keyword(spark):
    assert "dangerous" in value(spark, text.keywords(F.col("t"), stop_words=fixed.STOP_WORDS), t="Is it dangerous?")


def test_keywords(spark):
    query = "That THAT with four five be"
    assert value(spark, text.keywords(F.col("t")), t=query) == ["that", "that", "with", "four", "five"]
    assert value(spark, text.keywords(F.col("t"), stop_words=fixed.STOP_WORDS), t=query) == ["four", "five"]


@pytest.mark.parametrize("raw, expected", [(5.5, 2.0), (6.125, 5.0), (8.0, 10.0), (9.0, 10.0), (1.0, 2.0)])
def test_severity(spark, raw, expected):
    assert value(spark, scores.severity(F.col("r")), r=raw) == pytest.approx(expected)


def test_severity_without_hit_and_monotone(spark):
    assert spark.range(1).select(scores.severity(F.lit(None).cast("double")).alias("v")).first().v == 0.0
    steps = spark.range(0, 120).select(scores.severity(F.col("id") / 10.0).alias("v")).collect()
    found = [r.v for r in steps]
    assert found == sorted(found) and min(found) == 2.0 and max(found) == 10.0


@pytest.mark.parametrize("score, level", [(3.9999, "none"), (4.0, "mild"), (6.9999, "mild"), (7.0, "strong")])
def test_level(spark, score, level):
    assert value(spark, scores.mitigation_level(F.col("s")), s=score) == level


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert df.select(scores.cosine(F.col("a"), F.col("b")).alias("v")).first().v == pytest.approx(math.sqrt(0.5))


def test_embedding_formats(spark):
    rows = [
        (1, [0.5, 1.0], None, "array"), (2, None, "[0.5, 1.0]", "json"), (3, None, "0.5, 1.0", "csv"),
        (4, None, "broken", "unknown"), (5, None, None, "missing"), (6, None, "0.5, x", "csv"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "id bigint, embedding array<float>, embedding_text string")
    found = {r.id: r for r in knowledge_base.decode_embeddings(df).collect()}
    assert [found[r[0]].format for r in rows] == [r[3] for r in rows]
    assert [found[n].embedding for n in range(1, 7)] == [[0.5, 1.0]] * 3 + [None] * 3
    assert {r.id: r.dimension for r in knowledge_base.wrong_dimension(df.filter("id = 1")).collect()} == {1: 2}


def test_resolved_scores(spark):
    new = ((7.0, 6.0, 5.0, 6.0), None, (1.0, 2.0, 3.0, 2.0))
    old = (None, (7.0, 6.0, 4.0, 5.5), None)
    rows = [
        (1, "t", "p", ("a", "b"), (new, "x", None, None, None)),
        (2, "t", "p", ("a", "b"), (old, None, None, None, None)),
        (3, "t", "p", ("a", "b"), None),
    ]
    found = nodes.resolve_scores(spark.createDataFrame(rows, EVALUATED_SCHEMA)).orderBy("pair_id").collect()
    assert [(r.harmfulness, r.harmful_subtotal, r.counter_subtotal, r.assessment) for r in found] == [
        (5.0, 6.0, 2.0, "x"), (4.0, 5.5, 0.0, ""), (0.0, 0.0, 0.0, ""),
    ]


def test_mitigation_summary(spark):
    levels = spark.createDataFrame([("none",), ("none",), ("strong",)], "mitigation_level string")
    found = {r.mitigation_level: (r.queries, r.percentage) for r in assessment.mitigation_summary(levels).collect()}
    assert found == {"none": (2, 66.67), "mild": (0, 0.0), "strong": (1, 33.33)}
    empty = assessment.mitigation_summary(levels.limit(0)).collect()
    assert [(r.total_queries, r.queries, r.percentage) for r in empty] == [(0, 0, None)] * 3


def test_context_examples(spark):
    schema = (
        "query_id bigint, rank int, counter_id bigint, content string, directness double, "
        "evidence_quality double, persuasiveness double"
    )
    rows = [
        (1, 1, 11, "", 9.0, 9.0, 9.0), (1, 2, 12, "b", 0.0, 0.0, 0.0), (1, 3, 13, "c", 1.0, 1.0, 1.0),
        (1, 4, 14, "d", 2.0, 2.0, 1.0), (1, 5, 15, "e", 2.0, 2.0, 2.0),
    ]
    context = spark.createDataFrame(rows, schema)
    mild = assessment.mild_examples(context).orderBy("place").collect()
    strong = assessment.strong_examples(context).orderBy("place").collect()
    assert [r.counter_id for r in mild] == [12, 13]
    assert [r.counter_id for r in strong] == [15, 12, 14]  # no qualities count 5; ties keep the order
