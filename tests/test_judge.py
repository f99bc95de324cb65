import pytest

from rejoinder.operators import judge

TEMPLATE = """HARMFUL CONTENT
Representativeness: 8/10
Coherence: 7.5/10
Harmfulness: 9
Subtotal: 8.2
COUNTERSPEECH
Directness: 6
Evidence Quality: 7/10
Persuasiveness: 8
Subtotal: 3
OVERALL ASSESSMENT:   Solid work.
more"""


def scored(spark, response):
    df = spark.createDataFrame([(1, response)], "pair_id bigint, response string")
    return judge.score_responses(df).first()


def test_canonical_template(spark):
    row = scored(spark, TEMPLATE)
    assert (row.representativeness, row.coherence, row.harmfulness, row.harmful_subtotal) == (8.0, 7.5, 9.0, 8.2)
    assert row.counter_subtotal == 7.0  # not on the heading's line: mean of the three
    assert row.assessment == "Solid work."


@pytest.mark.parametrize(
    "response, directness",
    [
        ("**Directness**: 6", 6.0),
        ("2. **Directness** 6.5/10", 6.5),
        ("DIRECTNESS\n: 4", 4.0),
        ("**Directness:** 6", 0.0),  # inner colon
        ("Directness: [6/10]", 0.0),  # bracketed
        ("Directness: 1 Directness: 2", 1.0),
        ("", 0.0),
        (None, 0.0),
    ],
)
def test_label_layouts(spark, response, directness):
    assert scored(spark, response).directness == directness


def test_subtotal_lines(spark):
    row = scored(spark, "1. harmful part, Subtotal: 4\n2. reply part, subtotal 6.5")
    assert (row.harmful_subtotal, row.counter_subtotal) == (4.0, 6.5)


@pytest.mark.parametrize(
    "response, tier",
    [
        ("my assessment: excellent", 8.0),
        ("Assessment: a good and solid reply", 7.0),
        ("assessment: weak", 5.0),
        ("excellent", 0.0),
        ("assessment: excellent. Directness: 0", 0.0),  # a number was found
    ],
)
def test_word_tiers(spark, response, tier):
    row = scored(spark, response)
    assert [row[k] for k in judge.PAIR_SCORES] == [tier] * 8


@pytest.mark.parametrize(
    "response, text",
    [
        ("OVERALL ASSESSMENT: fine\nx", "fine"),
        ("OVERALL ASSESSMENT:\n\n next line ", "next line"),
        ("OVERALL ASSESSMENT:", ""),
        ("overall assessment: x", "No assessment provided."),
    ],
)
def test_assessment_line(spark, response, text):
    assert scored(spark, response).assessment == text


FULL = '{"directness": 1, "evidence_quality": "2", "persuasiveness": 3.5, "relevance": 4, "effectiveness": 5, "feedback": "ok"}'


@pytest.mark.parametrize(
    "response, method, scores, feedback",
    [
        (f"Sure. {FULL} Bye.", "json", [1, 2, 3.5, 4, 5], "ok"),
        ('{"directness": 4}', "json", [4, 0, 0, 0, 0], "No feedback provided"),
        ('{"directness": 1, "directness": 2}', "json", [2, 0, 0, 0, 0], "No feedback provided"),
        ('{"directness": 7, "feedback": "cut', "label", [7, 0, 0, 0, 0], ': "cut'),
        ('{"directness": "8/10", "feedback": "x"}', "label", [8, 0, 0, 0, 0], ': "x'),
        ('{"directness": null, "relevance": 3}', "label", [3, 0, 0, 3, 0], "No feedback extracted"),
        ('{"directness": 5} and {"relevance": 6}', "label", [5, 0, 0, 6, 0], "No feedback extracted"),
        ("{'directness': 5}", "label", [5, 0, 0, 0, 0], "No feedback extracted"),
        ("evidence of good quality 6", "label", [0, 6, 0, 0, 0], "No feedback extracted"),
        ("1 2 3 4", "default", [0] * 5, "Failed to extract evaluation"),
        ("1 2 3 4.5 5 6", "number", [1, 2, 3, 4.5, 5], "No feedback extracted"),
        ("", "default", [0] * 5, "Failed to extract evaluation"),
        ("Directness 9 Feedback: 'good'", "label", [9, 0, 0, 0, 0], ": 'good"),
    ],
)
def test_cascade(spark, response, method, scores, feedback):
    df = spark.createDataFrame([(1, response, None)], "pair_id bigint, response string, error string")
    row = judge.parse_judge(df).first()
    assert row.parse_method == method
    assert [row[k] for k in judge.fixed.JUDGE_CRITERIA] == [float(s) for s in scores]
    assert row.feedback == feedback
    assert row.overall_score == pytest.approx(sum(scores) / 5)


def test_failed_call(spark):
    df = spark.createDataFrame([(1, None, "timeout")], "pair_id bigint, response string, error string")
    row = judge.parse_judge(df).first()
    assert (row.parse_method, row.overall_score, row.directness) == ("failed", None, 0.0)
    assert row.raw_response == "Error: API failed to respond"


def test_compiled_row(spark):
    df = spark.createDataFrame(
        [(1, "t", "p", "a", "b", True, None), (2, "t", "p", "a", "b", False, TEMPLATE)],
        "pair_id bigint, topic string, position string, proponent string, opponent string, corrupted boolean, response string",
    )
    rows = judge.compile_pairs(judge.default_corrupted(judge.score_responses(df))).orderBy("pair_id").collect()
    assert rows[0].evaluation.scores.harmful_content.subtotal == 7.0
    assert rows[0].evaluation.content_issues.corrupted is True
    assert rows[1].evaluation.content_issues is None
    assert rows[1].evaluation.raw_response == TEMPLATE
