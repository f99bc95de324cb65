"""Readers and writers of the file formats the data comes in and goes out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.text import strip
from rejoinder.sources import split

MESSAGES = "array<struct<role: string, content: string>>"
DEBATE_SCHEMA = (
    "debate_id bigint, part bigint, topic string, position string, "
    "content struct<proponent: string, opponent: string>, "
    f"full_debate {MESSAGES}, history {MESSAGES}"
)
HARMFUL = "struct<representativeness: double, coherence: double, harmfulness: double, subtotal: double>"
LEGACY = "struct<representativeness: double, coherence: double, specificity: double, subtotal: double>"
REPLY = "struct<directness: double, evidence_quality: double, persuasiveness: double, subtotal: double>"
EVALUATION = (
    f"struct<scores: struct<harmful_content: {HARMFUL}, hate_speech: {LEGACY}, counterspeech: {REPLY}>, "
    "assessment: string, timestamp: double, raw_response: string, "
    "content_issues: struct<corrupted: boolean, message: string>>"
)
EVALUATED_SCHEMA = (
    "pair_id bigint, topic string, position string, "
    f"content struct<proponent: string, opponent: string>, evaluation {EVALUATION}"
)
EXAMPLE_SCHEMA = (
    "topic string, content string, source string, timestamp string, "
    "metadata struct<model: string, content_type: string>"
)
PARAGRAPH_TYPES = {
    "id": "bigint", "content": "string", "topic": "string", "source_debate": "bigint",
    "representativeness": "double", "coherence": "double", "harmfulness": "double", "quality_score": "double",
}
COUNTER_TYPES = {
    "id": "bigint", "content": "string", "topic": "string", "counters_id": "bigint",
    "directness": "double", "evidence_quality": "double", "persuasiveness": "double",
    "quality_score": "double", "assessment": "string",
}
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as strings. Text may hold line breaks, and a file is still read by many tasks;
    ``multi_line=False`` saves the second pass that takes where there are none."""
    # An empty field is null, a quoted empty one is an empty text.
    options = {**CSV_OPTIONS, "nullValue": "\\N"}
    return split.read_csv(spark, path, options) if multi_line else spark.read.options(**options).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def scan_topics(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path).select("topic", "position")


def distinct_topics(spark: SparkSession, path: str) -> DataFrame:
    """Unique topics; no rows if the file has no such column."""
    table = read_csv(spark, path)
    if "topic" not in table.columns:
        return spark.createDataFrame([], "topic string")
    return table.select("topic").distinct()


def scan_json(spark: SparkSession, path: str, schema: str, pretty: bool = False) -> DataFrame:
    """JSON objects, or arrays of them, one per line; ``pretty`` reads a file that is one array
    over any lines, by many tasks. A path that is not there gives no rows."""
    try:
        return split.read_json_array(spark, path, schema) if pretty else spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_debates(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    return scan_json(spark, path, DEBATE_SCHEMA, pretty)


def scan_evaluated_pairs(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    return scan_json(spark, path, EVALUATED_SCHEMA, pretty)


def typed(table: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to their types; what cannot be read becomes null."""

    def cast(name: str, kind: str) -> Column:
        return F.col(name) if kind == "string" else strip(F.col(name)).try_cast(kind).alias(name)

    return table.select(*[cast(name, kind) for name, kind in types.items()])


def load_typed_csv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    return typed(read_csv(spark, path), types)


def load_counters(spark: SparkSession, path: str) -> DataFrame:
    """Counters; a file without all score columns gives id, content and, if there, counters_id."""
    table = read_csv(spark, path)
    if all(name in table.columns for name in COUNTER_TYPES):
        return typed(table, COUNTER_TYPES)
    core = [name for name in ("id", "content", "counters_id") if name in table.columns]
    empty = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in COUNTER_TYPES.items()))
    return empty.unionByName(typed(table, {n: COUNTER_TYPES[n] for n in core}), allowMissingColumns=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) with line numbers that grow along each file.

    Numbers are in file order for one file; they are not dense.
    """
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), "value")


def classify_examples(lines: DataFrame) -> DataFrame:
    """Generated examples of ``(line, value)`` rows with an ``outcome``, in one pass.

    ``accepted``; ``rejected`` if the line is no JSON object (``value`` is kept); ``untitled``
    if the topic is blank. Blank lines are left out.
    """
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    rows = F.from_json(wrapped, f"array<struct<{EXAMPLE_SCHEMA}>>", {"allowSingleQuotes": "false"})
    parsed = (
        lines.filter(strip(F.col("value")) != "")
        .withColumn("_rows", rows)
        .withColumn("_e", F.when(F.size("_rows") == 1, F.get("_rows", F.lit(0))))
    )
    topic = strip(F.col("_e.topic"))
    outcome = (
        F.when(F.col("_e").isNull(), "rejected")
        .when(F.coalesce(topic, F.lit("")) == "", "untitled")
        .otherwise("accepted")
    )
    return parsed.select(
        "line",
        topic.alias("topic"), "_e.content", "_e.source", "_e.timestamp", "_e.metadata",
        outcome.alias("outcome"),
        F.when(F.col("_e").isNull(), F.col("value")).alias("value"),
    )


def parse_examples(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted examples, and the lines that are no JSON object."""
    classified = classify_examples(lines)
    accepted = classified.filter(F.col("outcome") == "accepted").drop("outcome", "value")
    return accepted, classified.filter(F.col("outcome") == "rejected").select("line", "value")


def scan_benchmark(table: DataFrame) -> DataFrame:
    """Benchmark columns by their lower-case names; ``hate_speech`` is required."""
    names = {"HATE_SPEECH": "hate_speech", "COUNTER_NARRATIVE": "counter_narrative", "TARGET": "target"}
    renamed = table.withColumnsRenamed(names)
    if "hate_speech" not in renamed.columns:
        raise ValueError("the benchmark needs a column hate_speech")
    return renamed


def write_tables(tables: dict[str, DataFrame], path: str, form: str = "parquet") -> None:
    """Each table below ``path``, replacing what is there."""
    for name, df in tables.items():
        if form == "csv":
            write_csv(df, f"{path}/{name}", "overwrite")
        else:
            df.write.mode("overwrite").format(form).save(f"{path}/{name}")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_examples(examples: DataFrame, path: str, model: str, content_type: str = "social_media_comment") -> None:
    """One JSON line per (topic, content), added to what is there."""
    examples.select(
        "topic", "content",
        F.lit("synthetic").alias("source"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(F.lit(model).alias("model"), F.lit(content_type).alias("content_type")).alias("metadata"),
    ).write.mode("append").json(path)


def stamp_run(results: DataFrame, arguments: dict[str, str]) -> DataFrame:
    """Results with the time, version and arguments of the run."""
    pairs = [F.lit(x) for item in arguments.items() for x in item]
    return results.withColumns(
        {
            "run_timestamp": F.current_timestamp(),
            "run_version": F.lit(fixed.RESULTS_VERSION),
            "run_arguments": F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>"),
        }
    )
