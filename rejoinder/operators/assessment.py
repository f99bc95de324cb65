"""Severity, mitigation level and reply context per query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.scores import calibrated, mitigation_level, raw_score, severity
from rejoinder.operators.joins import top_per

COUNTED_HITS = 3


def score_hits(context: DataFrame) -> DataFrame:
    return context.withColumn("raw_score", raw_score(F.col("similarity_score"), F.col("quality_score")))


def top_hits(context: DataFrame) -> DataFrame:
    """The three hits with the highest raw score per query, earlier rank first on ties."""
    return top_per(score_hits(context), ["query_id"], [F.desc("raw_score"), F.asc("rank")], COUNTED_HITS, "place")


def top_mean(context: DataFrame) -> DataFrame:
    """Mean raw score of the top hits, and the number of hits, per query."""
    best = Window.partitionBy("query_id").orderBy(F.desc("raw_score"), F.asc("rank"))
    counted = F.when(F.col("_place") <= COUNTED_HITS, F.col("raw_score"))
    return (
        score_hits(context)
        .withColumn("_place", F.row_number().over(best))
        .groupBy("query_id")
        .agg(F.avg(counted).alias("raw_score"), F.count("*").alias("hits"))
    )


def assess(queries: DataFrame, context: DataFrame) -> DataFrame:
    """Score and level of every query; a query without hits scores 0."""
    score = severity(F.col("raw_score"))
    return (
        queries.select("query_id")
        .join(top_mean(context), "query_id", "left")
        .select(
            "query_id",
            F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"),
            "raw_score",
            score.alias("severity"),
            F.round(score, 2).alias("hate_score"),
            mitigation_level(score).alias("mitigation_level"),
        )
    )


def assessment_details(context: DataFrame) -> DataFrame:
    """The counted hits with rounded inputs, raw score and own calibrated score (no minimum), and
    beside them the number of hits of the query, its mean raw score and its severity."""
    low, high = fixed.OBSERVED_RANGE
    least, most = fixed.THEORETICAL_RANGE
    whole = top_mean(context).select("query_id", F.col("hits").alias("items"), F.col("raw_score").alias("query_raw_score"))
    return top_hits(context).join(whole, "query_id").select(
        "query_id",
        F.col("place").cast("bigint").alias("place"),
        F.col("hate_paragraph_id").alias("id"),
        "counter_id",
        F.round("similarity_score", 2).alias("similarity"),
        F.round("quality_score", 2).alias("harmfulness"),
        F.col("raw_score").alias("raw_weighted_score"),
        calibrated(F.col("raw_score")).alias("calibrated_score"),
        F.lit(low).alias("observed_min"),
        F.lit(high).alias("observed_max"),
        F.lit(least).alias("theoretical_min"),
        F.lit(most).alias("theoretical_max"),
        "items",
        "query_raw_score",
        severity(F.col("query_raw_score")).alias("query_calibrated_score"),
        F.lit(fixed.SIMILARITY_WEIGHT).alias("similarity_weight"),
        F.lit(fixed.HARMFULNESS_WEIGHT).alias("harmfulness_weight"),
    )


def mitigation_summary(assessed: DataFrame) -> DataFrame:
    """Count and percentage of each level; no percentage when there is no query."""
    counts = assessed.groupBy("mitigation_level").agg(F.count("*").alias("n"))
    one_row = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_queries"),
        *[
            F.coalesce(F.sum(F.when(F.col("mitigation_level") == level, F.col("n"))), F.lit(0)).alias(level)
            for level in fixed.LEVELS
        ],
    )
    share = F.col("queries") / F.nullif(F.col("total_queries"), F.lit(0)) * F.lit(100.0)
    return one_row.unpivot("total_queries", fixed.LEVELS, "mitigation_level", "queries").withColumn(
        "percentage", F.round(share, 2)
    )


def mild_examples(context: DataFrame, limit: int = 2) -> DataFrame:
    """First non-empty counter texts in retrieval order."""
    texts = context.filter(F.col("content") != "")
    return top_per(texts, ["query_id"], [F.asc("rank")], limit, "place").select(
        "query_id", F.col("place").cast("bigint").alias("place"), "counter_id", "content"
    )


def strong_examples(context: DataFrame, limit: int = 3) -> DataFrame:
    """Non-empty counter texts with the highest sum of the three qualities."""
    total = F.col("directness") + F.col("evidence_quality") + F.col("persuasiveness")
    texts = context.filter(F.col("content") != "").withColumn(
        "quality", F.when(total == 0.0, F.lit(fixed.DEFAULT_COUNTER_QUALITY)).otherwise(total)
    )
    return top_per(texts, ["query_id"], [F.desc("quality"), F.asc("rank")], limit, "place").select(
        "query_id", F.col("place").cast("bigint").alias("place"), "counter_id", "quality", "content"
    )


REQUEST_TEXT = {
    "none": "Answer the question below plainly and factually. Nothing in it was flagged.\n\nQuestion: ",
    "mild": (
        "The message below may touch a sensitive subject. If it is harmful, correct it gently with facts "
        "in three or four sentences; otherwise simply answer it.\n\nMessage: "
    ),
    "strong": (
        "The message below was flagged as likely harmful. If it is, answer firmly and respectfully with "
        "evidence in three or four sentences; otherwise simply answer it.\n\nMessage: "
    ),
}
EXAMPLE_HEAD = {"mild": "\n\nPerspectives to draw on:", "strong": "\n\nReplies that worked well:"}


def _listed(examples: DataFrame, name: str) -> DataFrame:
    """The few examples of a query as one text."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("place", "content"))),
        lambda e: F.concat(F.lit("\n"), e["place"].cast("string"), F.lit(". "), e["content"]),
    )
    return examples.groupBy("query_id").agg(F.array_join(lines, "").alias(name))


def response_requests(queries: DataFrame, assessed: DataFrame, context: DataFrame) -> DataFrame:
    """One request text per query, worded by its level, with counter texts as examples."""
    level = F.col("mitigation_level")
    mild, strong = F.col("_mild"), F.col("_strong")
    opening = F.create_map(*[F.lit(x) for pair in REQUEST_TEXT.items() for x in pair])
    examples = (
        F.when((level == "mild") & mild.isNotNull(), F.concat(F.lit(EXAMPLE_HEAD["mild"]), mild))
        .when((level == "strong") & strong.isNotNull(), F.concat(F.lit(EXAMPLE_HEAD["strong"]), strong))
        .otherwise("")
    )
    return (
        queries.select("query_id", "query")
        .join(assessed.select("query_id", "mitigation_level"), "query_id")
        .join(_listed(mild_examples(context), "_mild"), "query_id", "left")
        .join(_listed(strong_examples(context), "_strong"), "query_id", "left")
        .select(
            "query_id", "mitigation_level",
            F.concat(F.try_element_at(opening, level), F.col("query"), examples).alias("prompt"),
        )
    )
