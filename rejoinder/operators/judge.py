"""Judge responses parsed into scores, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.text import let, strip

NUMBER = r"(\d+(?:\.\d+)?)"
PAIR_SCORES = [
    "representativeness", "coherence", "harmfulness", "harmful_subtotal",
    "directness", "evidence_quality", "persuasiveness", "counter_subtotal",
]


def _first_number(text: Column, pattern: str) -> Column:
    """Number in the first match, null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")


def _labelled(label: str) -> str:
    return rf"(?i){label}(?:\*\*)?\s*:?\s*{NUMBER}"


def _mean3(a: Column, b: Column, c: Column) -> Column:
    return (a + b + c) / F.lit(3.0)


def _zero_to(value: Column, instead: Column) -> Column:
    return F.when(value == 0.0, instead).otherwise(value)


def rubric_columns(response: Column) -> dict[str, Column]:
    """The six criteria and the harmful subtotal as found, 0 where absent, and whether any was found."""
    found = {k: _first_number(response, _labelled(label)) for k, label in fixed.RUBRIC_LABELS.items()}
    found["harmful_subtotal"] = _first_number(response, _labelled("Subtotal"))
    columns = {k: F.coalesce(v, F.lit(0.0)) for k, v in found.items()}
    columns["score_found"] = reduce(lambda a, b: a | b, [v.isNotNull() for v in found.values()])
    return columns


def parse_rubric(responses: DataFrame, response: str = "response") -> DataFrame:
    return responses.withColumns(rubric_columns(F.coalesce(F.col(response), F.lit(""))))


def fill_subtotals(parsed: DataFrame, response: str = "response") -> DataFrame:
    """Subtotals from their own line, else the mean of three positive parts, else 0."""
    text = F.coalesce(F.col(response), F.lit(""))

    def on_line(heading: str) -> Column:
        return F.coalesce(_first_number(text, rf"(?i)(?:{heading})[^\n]*?Subtotal\s*:?\s*{NUMBER}"), F.lit(0.0))

    def filled(start: Column, parts: list[str]) -> Column:
        cols = [F.col(p) for p in parts]
        positive = reduce(lambda a, b: a & b, [c > 0 for c in cols])
        return _zero_to(start, F.when(positive, _mean3(*cols)).otherwise(F.lit(0.0)))

    harmful = _zero_to(F.col("harmful_subtotal"), on_line(r"HARMFUL CONTENT|1\."))
    return parsed.withColumns(
        {
            "harmful_subtotal": filled(harmful, ["representativeness", "coherence", "harmfulness"]),
            "counter_subtotal": filled(
                on_line(r"COUNTERSPEECH|2\."), ["directness", "evidence_quality", "persuasiveness"]
            ),
        }
    )


def keyword_tier(response: Column) -> Column:
    """Score suggested by words when an assessment holds no number; null if it is no assessment."""
    lowered = F.lower(response)
    tier = F.lit(fixed.ASSESSMENT_TIER_OTHER)
    for score, words in reversed(fixed.ASSESSMENT_TIERS):
        hit = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words])
        tier = F.when(hit, F.lit(score)).otherwise(tier)
    return F.when(F.contains(lowered, F.lit("assessment")), tier)


def keyword_fallback(parsed: DataFrame, response: str = "response") -> DataFrame:
    tier = F.when(~F.col("score_found"), keyword_tier(F.coalesce(F.col(response), F.lit(""))))
    return parsed.withColumns({k: F.coalesce(tier, F.col(k)) for k in PAIR_SCORES})


def assessment_text(response: Column) -> Column:
    heading = "OVERALL ASSESSMENT:"
    return F.when(
        F.contains(response, F.lit(heading)), strip(F.regexp_extract(response, heading + r"\s*([^\n]*)", 1))
    ).otherwise(fixed.NO_ASSESSMENT)


def score_responses(responses: DataFrame, response: str = "response") -> DataFrame:
    """Rubric scores, subtotals, word tiers and the assessment line of each response."""
    scored = keyword_fallback(fill_subtotals(parse_rubric(responses, response), response), response)
    return scored.withColumn("assessment", assessment_text(F.coalesce(F.col(response), F.lit(""))))


def default_corrupted(scored: DataFrame) -> DataFrame:
    """Fixed scores and assessment where the pair is flagged as corrupted."""
    columns = {
        k: F.when(F.col("corrupted"), F.lit(v)).otherwise(F.col(k)) for k, v in fixed.CORRUPTED_SCORES.items()
    }
    columns["assessment"] = F.when(F.col("corrupted"), fixed.CORRUPTED_ASSESSMENT).otherwise(F.col("assessment"))
    return scored.withColumns(columns)


def compile_pairs(scored: DataFrame) -> DataFrame:
    """The nested result row of an evaluated pair."""
    harmful = F.struct("representativeness", "coherence", "harmfulness", F.col("harmful_subtotal").alias("subtotal"))
    counter = F.struct("directness", "evidence_quality", "persuasiveness", F.col("counter_subtotal").alias("subtotal"))
    evaluation = F.struct(
        F.struct(harmful.alias("harmful_content"), counter.alias("counterspeech")).alias("scores"),
        F.col("assessment"),
        F.unix_micros(F.current_timestamp()).cast("double").alias("timestamp"),
        F.when(~F.col("corrupted"), F.col("response")).alias("raw_response"),
        F.when(
            F.col("corrupted"),
            F.struct(F.lit(True).alias("corrupted"), F.lit(fixed.CORRUPTION_MESSAGE).alias("message")),
        ).alias("content_issues"),
    )
    return scored.select(
        "pair_id", "topic", "position",
        F.struct("proponent", "opponent").alias("content"),
        evaluation.alias("evaluation"),
    )


# --- five-criteria judge -------------------------------------------------------------


def _five(values: list[Column]) -> Column:
    return F.struct(*[v.alias(k) for k, v in zip(fixed.JUDGE_CRITERIA, values)])


def _any_positive(scores: Column) -> Column:
    return reduce(lambda a, b: a | b, [scores[k] > 0 for k in fixed.JUDGE_CRITERIA])


def json_entries(response: Column) -> Column:
    """Entries of the one JSON object between the first { and the last }; null if there is none.

    Wrapping it in brackets makes text after the object an error instead of being skipped.
    """
    braces = F.nullif(F.regexp_extract(response, r"(?s)\{.*\}", 0), F.lit(""))
    objects = F.from_json(
        F.concat(F.lit("["), braces, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false"}
    )
    return let(objects, lambda found: F.when(F.size(found) == 1, F.map_entries(F.get(found, F.lit(0)))))


def _entry(entries: Column, key: str) -> tuple[Column, Column]:
    """Whether the key is present, and its last value."""
    matching = F.filter(entries, lambda e: e["key"] == key)
    return F.size(matching) > 0, F.try_element_at(matching, F.lit(-1))["value"]


def json_scores(entries: Column) -> Column:
    """Five scores; a missing key counts 0, a value that is no number voids the object."""
    values = []
    for key in fixed.JUDGE_CRITERIA:
        present, value = _entry(entries, key)
        values.append(F.when(~present, F.lit(0.0)).otherwise(value.try_cast("double")))
    usable = lambda scores: reduce(lambda a, b: a & b, [scores[k].isNotNull() for k in fixed.JUDGE_CRITERIA])
    return let(_five(values), lambda scores: F.when(entries.isNotNull() & usable(scores), scores))


def json_feedback(entries: Column) -> Column:
    present, value = _entry(entries, "feedback")
    return F.when(present, value).otherwise(F.lit(fixed.FEEDBACK_MISSING_IN_JSON))


def label_scores(response: Column) -> Column:
    """Scores after the five labels; looser labels only if all five are 0; null if still all 0."""

    def read(labels: list[str]) -> Column:
        scores = _five(
            [F.coalesce(_first_number(response, rf"(?is){label}.*?{NUMBER}"), F.lit(0.0)) for label in labels]
        )
        return let(scores, lambda s: F.when(_any_positive(s), s))

    return F.coalesce(read(fixed.JUDGE_LABELS), read(fixed.JUDGE_LOOSE_LABELS))


def number_scores(response: Column) -> Column:
    """The first five numbers standing alone, null with fewer than five."""
    found = F.regexp_extract_all(response, F.lit(rf"\b{NUMBER}\b"), 1)
    return let(
        found,
        lambda numbers: F.when(
            F.size(numbers) >= 5,
            _five([F.try_element_at(numbers, F.lit(i + 1)).try_cast("double") for i in range(5)]),
        ),
    )


def feedback_text(response: Column) -> Column:
    """Text after the first "feedback" up to a closing brace or the end, one quote taken off each side."""
    pattern = r"""(?is)feedback["']?([^}]*)(\}?)"""
    body = F.regexp_extract(response, pattern, 1)
    closed = F.regexp_extract(response, pattern, 2) == "}"
    bare = F.when(closed, F.regexp_replace(body, r"""["']\z""", "")).otherwise(
        F.regexp_replace(body, r"""["']\n?\z""", "")
    )
    return let(bare, lambda text: F.when(text == "", fixed.FEEDBACK_MISSING_IN_TEXT).otherwise(strip(text)))


def _parsed(method: str, scores: Column, feedback: Column) -> Column:
    return F.when(
        scores.isNotNull(), F.struct(F.lit(method).alias("method"), scores.alias("scores"), feedback.alias("feedback"))
    )


def _cascade(text: Column) -> Column:
    """Method, scores and feedback of the first way that works."""
    return F.coalesce(
        let(json_entries(text), lambda e: let(json_scores(e), lambda s: _parsed("json", s, json_feedback(e)))),
        let(label_scores(text), lambda s: _parsed("label", s, feedback_text(text))),
        let(number_scores(text), lambda s: _parsed("number", s, feedback_text(text))),
        _parsed("default", _five([F.lit(0.0)] * 5), F.lit(fixed.FEEDBACK_UNPARSED)),
    )


def parse_judge(responses: DataFrame, response: str = "response", error: str = "error") -> DataFrame:
    """The cascade JSON, labels, numbers, defaults; ``parse_method`` tells which one applied.

    A failed call (``error`` set) gives zeros without an overall score.
    """
    failed = F.col(error).isNotNull()
    text = F.coalesce(F.col(response), F.lit(""))
    nothing = _parsed("failed", _five([F.lit(0.0)] * 5), F.lit(None).cast("string"))
    staged = responses.withColumn("_p", F.when(failed, nothing).otherwise(_cascade(text)))
    scores = [F.col(f"_p.scores.{k}") for k in fixed.JUDGE_CRITERIA]
    return staged.select(
        *[c for c in responses.columns if c != response],
        F.when(failed, fixed.FAILED_CALL_RESPONSE).otherwise(F.col(response)).alias("raw_response"),
        *[s.alias(k) for k, s in zip(fixed.JUDGE_CRITERIA, scores)],
        F.when(~failed, reduce(lambda a, b: a + b, scores) / F.lit(5.0)).alias("overall_score"),
        F.col("_p.feedback").alias("feedback"),
        F.col("_p.method").alias("parse_method"),
    )
