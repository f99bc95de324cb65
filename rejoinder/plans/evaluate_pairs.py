"""Transcripts and judge responses to scored, flagged pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.operators.evaluation import with_quality
from rejoinder.operators.judge import default_corrupted, score_responses
from rejoinder.operators.transcripts import flag_corrupted, resume_pending


def evaluate_pairs(
    pairs: DataFrame, responses: DataFrame, done: DataFrame | None = None,
    threshold: float = fixed.RUN_QUALITY_THRESHOLD,
) -> DataFrame:
    """Flag, score and rate pairs; ``responses (pair_id, response)`` come from the judge.

    With ``done`` (earlier results in the same layout) only pending pairs are scored and the
    earlier rows are kept. Corrupted pairs are never skipped and need no response.
    """
    flagged = flag_corrupted(pairs)
    open_pairs = flagged if done is None else resume_pending(flagged, done, always=F.col("corrupted"))
    scored = default_corrupted(score_responses(open_pairs.join(responses, "pair_id", "left")))
    rated = with_quality(scored).withColumn("high_quality", F.col("quality") >= threshold)
    if done is None:
        return rated
    redone = flagged.filter("corrupted").select("pair_id")
    return done.join(redone, "pair_id", "left_anti").unionByName(rated)
