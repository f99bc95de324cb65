"""Aggregates over judge scores, toxicity scores and evaluated pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.operators.ordinals import with_ordinal
from rejoinder.session import written

JUDGE_METRICS = [*fixed.JUDGE_CRITERIA, "overall_score"]


#: Scores are added as decimals, so that a sum does not depend on the order of the rows.
EXACT = "decimal(28,12)"


def _mean(value: Column) -> Column:
    """Mean of the values that are not null, divided once; null without any."""
    return F.sum(value.cast(EXACT)).cast("double") / F.nullif(F.count(value), F.lit(0))


def _mean_or_zero(value: Column) -> Column:
    """Mean with missing as 0, and 0 for an empty table."""
    return F.coalesce(_mean(F.coalesce(value, F.lit(0.0))), F.lit(0.0))


def judge_averages(judged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean of each criterion; a failed call counts as 0."""
    return judged.groupBy(*(by or [])).agg(*[_mean_or_zero(F.col(m)).alias(f"avg_{m}") for m in JUDGE_METRICS])


def _sides(toxicity: DataFrame, by: list[str]) -> DataFrame:
    """(…, side, scores): one row per text, ``scores`` null for a failed call."""
    side = F.explode(
        F.array(
            F.struct(F.lit("hate").alias("side"), F.col("hate_scores").alias("scores")),
            F.struct(F.lit("counter").alias("side"), F.col("counter_scores").alias("scores")),
        )
    )
    return toxicity.select(*by, side.alias("_s")).select(*by, "_s.side", "_s.scores")


def toxicity_averages(toxicity: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean per side and attribute over all texts (``avg_all``, failed calls counted) and over
    the scored ones (``avg_valid``).

    Each text also gives one entry without attribute that counts it, so one aggregation
    yields sums and the denominator together.
    """
    keys = [*(by or []), "side"]
    counting = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(0.0).alias("value")))
    scored = F.coalesce(F.map_entries("scores"), F.array().cast("array<struct<key:string,value:double>>"))
    entries = _sides(toxicity, by or []).select(*keys, F.explode(F.concat(counting, scored)).alias("_e"))
    totals = entries.groupBy(*keys, F.col("_e.key").alias("attribute")).agg(
        F.sum(F.col("_e.value").cast(EXACT)).alias("_sum"), F.count("_e.value").alias("_n"), F.count("*").alias("_rows")
    )
    # A few rows: one per side and attribute.
    texts = F.max(F.when(F.col("attribute").isNull(), F.col("_rows"))).over(Window.partitionBy(*keys))
    return (
        totals.withColumn("_texts", texts)
        .filter(F.col("attribute").isNotNull())
        .select(
            *keys, "attribute",
            (F.col("_sum").cast("double") / F.col("_texts")).alias("avg_all"),
            (F.col("_sum").cast("double") / F.col("_n")).alias("avg_valid"),
        )
    )


def toxicity_reduction(toxicity: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per attribute over pairs with both sides scored: mean reduction, mean percentage and
    share of pairs with a reduction. A base of 0 gives 0 or -100 percent."""
    keys = by or []
    both = toxicity.filter(F.col("hate_scores").isNotNull() & F.col("counter_scores").isNotNull())
    entries = both.select(*keys, "counter_scores", F.explode("hate_scores").alias("attribute", "_hate")).withColumn(
        "_counter", F.try_element_at("counter_scores", F.col("attribute"))
    )
    drop = F.col("_hate") - F.col("_counter")
    percent = (
        F.when(F.col("_hate") > 0, drop / F.col("_hate") * 100.0)
        .when(F.col("_counter") == 0, 0.0)
        .otherwise(-100.0)
    )
    return (
        entries.filter(F.col("_hate").isNotNull() & F.col("_counter").isNotNull())
        .groupBy(*keys, "attribute")
        .agg(
            _mean(drop).alias("avg_reduction"),
            _mean(percent).alias("avg_reduction_percent"),
            F.avg(F.when(drop > 0, 1.0).otherwise(0.0)).alias("samples_with_reduction"),
        )
    )


def example_metrics(benchmark: DataFrame, judged: DataFrame, toxicity: DataFrame) -> DataFrame:
    """One wide row per example: judge scores, both toxicity sides, reduction and, for a
    positive base, its percentage."""
    columns: list[Column] = []
    for attribute in fixed.TOXICITY_ATTRIBUTES:
        hate, counter = (F.try_element_at(side, F.lit(attribute)) for side in ("hate_scores", "counter_scores"))
        columns += [
            counter.alias(f"counter_{attribute}"),
            hate.alias(f"hate_{attribute}"),
            (hate - counter).alias(f"reduction_{attribute}"),
            F.when(hate > 0, (hate - counter) / hate * 100.0).alias(f"pct_reduction_{attribute}"),
        ]
    scores = judged.select("pair_id", *[F.col(m).alias(f"llm_{m}") for m in JUDGE_METRICS])
    return (
        benchmark.join(scores, "pair_id", "left")
        .join(toxicity.select("pair_id", "hate_scores", "counter_scores"), "pair_id", "left")
        .select(
            F.col("pair_id").alias("example_id"),
            F.col("hate_speech").alias("hate_text"),
            F.col("counter_narrative").alias("counter_text"),
            "target",
            *[f"llm_{m}" for m in JUDGE_METRICS],
            *columns,
        )
    )


def _signed(difference: Column, digits: int) -> Column:
    """Rounded first, so that the text does not depend on how a formatter treats ties."""
    small = 10.0**-digits
    rounded = F.round(difference, digits)
    return F.when(F.abs(difference) < small, F.format_string(f"%.{digits}f", rounded)).otherwise(
        F.format_string(f"%+.{digits}f", rounded)
    )


def _title(name: Column, separator: str) -> Column:
    return F.array_join(F.transform(F.split(name, separator), F.initcap), separator)


def compare_judge(judged: DataFrame) -> DataFrame:
    """Averages of the systems ``generated`` and ``gold`` side by side."""
    names = [f"avg_{m}" for m in JUDGE_METRICS]
    long = judge_averages(judged, ["system"]).unpivot("system", names, "metric", "value")
    sides = long.groupBy("metric").agg(
        F.max(F.when(F.col("system") == "generated", F.col("value"))).alias("generated"),
        F.max(F.when(F.col("system") == "gold", F.col("value"))).alias("gold"),
    )
    gap = F.coalesce("generated", F.lit(0.0)) - F.coalesce("gold", F.lit(0.0))
    return sides.select(
        _title(F.replace(F.replace("metric", F.lit("avg_")), F.lit("_"), F.lit(" ")), " ").alias("metric"),
        F.coalesce("generated", F.lit(0.0)).alias("generated"),
        F.coalesce("gold", F.lit(0.0)).alias("gold"),
        gap.alias("difference"),
        _signed(gap, 2).alias("difference_text"),
    )


def compare_toxicity(toxicity: DataFrame) -> DataFrame:
    """Average toxicity of the replies per attribute known for both systems."""
    means = toxicity_averages(toxicity, ["system"]).filter(F.col("side") == "counter")
    sides = means.groupBy("attribute").agg(
        F.max(F.when(F.col("system") == "generated", F.col("avg_all"))).alias("generated"),
        F.max(F.when(F.col("system") == "gold", F.col("avg_all"))).alias("gold"),
    )
    gap = F.col("generated") - F.col("gold")
    return sides.filter(F.col("generated").isNotNull() & F.col("gold").isNotNull()).select(
        _title(F.col("attribute"), "_").alias("attribute"), "generated", "gold",
        gap.alias("difference"), _signed(gap, 4).alias("difference_text"),
    )


# --- samples -------------------------------------------------------------------------


def _draw(key: str, seed: int) -> Column:
    """A repeatable pseudo-random order that other engines can reproduce."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def sample_n(df: DataFrame, n: int, key: str, seed: int = fixed.SAMPLE_SEED) -> DataFrame:
    return df.orderBy(_draw(key, seed), key).limit(n)


# Bits of the draw that rows are counted by; the rest decides among the rows of one bin.
DRAW_DIGITS = 4


def stratified_sample(
    df: DataFrame, stratum: str, key: str, n: int = fixed.STRATIFIED_SIZE, seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    """``floor(n * stratum / total)`` rows of each stratum, no repeats: those with the lowest draw.

    Rows are counted by stratum and bin of the draw, which tells the bin that holds the last row of the quota. All rows
    of lower bins are taken where they lie; only those of the border bin, some 65,536th of a stratum, are sorted.
    Strata that share the quota of one row or more are at most ``n``, so their borders are broadcast.
    """
    drawn = df.withColumn("_draw", _draw(key, seed)).withColumn("_bin", F.conv(F.substring("_draw", 1, DRAW_DIGITS), 16, 10).cast("int"))
    bins = written(drawn.groupBy(F.col(stratum).alias("_stratum"), "_bin").agg(F.count("*").alias("_rows")), "bins")
    total = bins.agg(F.sum("_rows").alias("_total"))
    upto = Window.partitionBy("_stratum").orderBy("_bin")
    size = F.sum("_rows").over(Window.partitionBy("_stratum"))
    counted = bins.withColumn("_upto", F.sum("_rows").over(upto)).withColumn("_size", size)
    counted = counted.withColumn("_quota", F.least(F.call_function("div", F.lit(n) * F.col("_size"), total.scalar()), F.col("_size")))
    border = counted.filter((F.col("_quota") > F.col("_upto") - F.col("_rows")) & (F.col("_quota") <= F.col("_upto"))).select(
        "_stratum", F.col("_bin").alias("_border"), (F.col("_quota") - F.col("_upto") + F.col("_rows")).alias("_open")
    )
    near = drawn.join(F.broadcast(border), drawn[stratum].eqNullSafe(border["_stratum"]) & (F.col("_bin") <= F.col("_border")))
    at_border = Window.partitionBy("_stratum").orderBy("_draw", key)
    last = near.filter("_bin = _border").withColumn("_place", F.row_number().over(at_border)).filter("_place <= _open")
    return near.filter("_bin < _border").select(*df.columns).unionByName(last.select(*df.columns))



def sample_examples(
    benchmark: DataFrame, judged: DataFrame, toxicity: DataFrame, n: int = fixed.REPORT_EXAMPLES
) -> DataFrame:
    """A few random examples with their target, judge and toxicity rows."""
    chosen = F.broadcast(sample_n(benchmark, n, "pair_id"))  # n rows
    return example_metrics(
        chosen,
        judged.join(chosen.select("pair_id"), "pair_id", "left_semi"),
        toxicity.join(chosen.select("pair_id"), "pair_id", "left_semi"),
    )


# --- evaluated pairs -----------------------------------------------------------------


def pair_quality() -> Column:
    parts = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("directness", "evidence_quality", "persuasiveness"))
    a, b, c = parts
    return F.coalesce(F.col("counter_subtotal"), (a + b + c) / F.lit(3.0))


def with_quality(scored: DataFrame) -> DataFrame:
    return scored.withColumn("quality", pair_quality())


def rank_pairs(scored: DataFrame) -> DataFrame:
    """Pairs by quality, best first, input order on ties, with their place."""
    return with_ordinal(with_quality(scored), [F.desc("quality"), F.asc("pair_id")], "place", key=["quality", "pair_id"])


def filter_high_quality(scored: DataFrame, threshold: float = fixed.QUALITY_THRESHOLD) -> DataFrame:
    return with_quality(scored).filter(F.col("quality") >= threshold)


def quality_summary(scored: DataFrame) -> DataFrame:
    """Totals, averages and the four quality buckets in one pass; the high-quality share
    always uses 7, whatever threshold filtered the pairs."""
    s = F.col("counter_subtotal")
    return scored.agg(
        F.count("*").alias("total_pairs"),
        F.coalesce(_mean(F.col("harmful_subtotal")), F.lit(0.0)).alias("average_harmful_content_score"),
        F.coalesce(_mean(s), F.lit(0.0)).alias("average_counterspeech_score"),
        F.count_if(s >= 8.0).alias("excellent"),
        F.count_if((s >= 7.0) & (s < 8.0)).alias("good"),
        F.count_if((s >= 5.0) & (s < 7.0)).alias("average"),
        F.count_if(s < 5.0).alias("poor"),
        F.count_if(s >= 7.0).alias("high_quality_pairs"),
        F.coalesce(F.count_if(s >= 7.0) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("high_quality_share"),
    )


# --- reports -------------------------------------------------------------------------

REDUCTION_SECTIONS = {
    "avg_reduction": "reduction",
    "avg_reduction_percent": "reduction_percent",
    "samples_with_reduction": "samples_with_reduction",
}


def _judge_rows(judged: DataFrame, by: list[str]) -> DataFrame:
    """Averages and, as ``sample_size`` in section ``config``, the number of rows: one pass."""
    averages = [_mean_or_zero(F.col(m)).alias(f"avg_{m}") for m in JUDGE_METRICS]
    wide = judged.groupBy(*by).agg(*averages, F.count("*").cast("double").alias("sample_size"))
    long = wide.unpivot(by, [c for c in wide.columns if c not in by], "metric", "value")
    section = F.when(F.col("metric") == "sample_size", "config").otherwise("judge")
    return long.select(*by, section.alias("section"), "metric", "value")


def _toxicity_rows(toxicity: DataFrame, by: list[str]) -> DataFrame:
    means = toxicity_averages(toxicity, by).select(
        *by,
        F.lit("toxicity").alias("section"),
        F.concat_ws(" ", "side", "attribute").alias("metric"),
        F.col("avg_all").alias("value"),
    )
    names = F.create_map(*[F.lit(x) for pair in REDUCTION_SECTIONS.items() for x in pair])
    drops = toxicity_reduction(toxicity, by).unpivot(
        [*by, "attribute"], list(REDUCTION_SECTIONS), "_measure", "value"
    )
    return means.unionByName(
        drops.select(*by, F.element_at(names, F.col("_measure")).alias("section"), F.col("attribute").alias("metric"), "value")
    )


def report_tables(judged: DataFrame, toxicity: DataFrame, dataset: str, search_method: str) -> DataFrame:
    """The report as rows ``section, metric, value``; ``text`` holds the settings."""
    numbers = _judge_rows(judged, []).unionByName(_toxicity_rows(toxicity, []))
    settings = judged.sparkSession.createDataFrame(
        [("config", "dataset", None, dataset), ("config", "search_method", None, search_method)],
        "section string, metric string, value double, text string",
    )
    return numbers.withColumn("text", F.lit(None).cast("string")).unionByName(settings)


def run_summary(judged: DataFrame, toxicity: DataFrame) -> DataFrame:
    """Headline numbers of a run, one row each."""
    section, metric = F.col("section"), F.col("metric")
    names = (
        F.when(section == "judge", metric)
        .when((section == "toxicity") & (metric == "counter toxicity"), "avg_counter_toxicity")
        .when((section == "reduction_percent") & (metric == "toxicity"), "avg_toxicity_reduction_percent")
    )
    rows = _judge_rows(judged, []).unionByName(_toxicity_rows(toxicity, []))
    return rows.select(names.alias("metric"), "value").filter(F.col("metric").isNotNull())


def evaluate_systems(judged: DataFrame, toxicity: DataFrame | None = None) -> DataFrame:
    """Judge averages, toxicity averages and reduction of every system as rows
    ``system, section, metric, value``; without toxicity scores the judge part only."""
    rows = _judge_rows(judged, ["system"]).filter(F.col("section") == "judge")
    return rows if toxicity is None else rows.unionByName(_toxicity_rows(toxicity, ["system"]))
