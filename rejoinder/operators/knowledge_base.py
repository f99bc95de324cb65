"""Knowledge base as plain tables: topics, edges, checks, growth, repair, overview."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.text import embedding_from_csv, embedding_from_json, strip
from rejoinder.operators.ordinals import with_ordinal


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def synthetic(flag: str = "is_synthetic") -> Column:
    """The three-valued flag as two-valued: null counts as not synthetic."""
    return F.coalesce(F.col(flag), F.lit(False))


def layer() -> Column:
    return F.when(synthetic(), 2).otherwise(1)


# --- build ---------------------------------------------------------------------------


def build_topics(paragraphs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct non-empty topic names, merged into the existing ones."""
    names = paragraphs.select(F.col("topic").alias("name"))
    if existing is not None:
        names = names.unionByName(existing.select("name"))
    return names.filter(F.col("name").isNotNull() & (F.col("name") != "")).distinct()


def topic_edges(nodes: DataFrame, topics: DataFrame) -> DataFrame:
    """(id, topic) for nodes whose topic exists; others have no edge."""
    return nodes.select("id", "topic").join(topics, F.col("topic") == F.col("name")).select("id", "topic")


def contains_edges(sentences: DataFrame, paragraphs: DataFrame) -> DataFrame:
    ids = paragraphs.select(F.col("id").alias("paragraph_id"))
    return sentences.select(F.col("id").alias("sentence_id"), "paragraph_id").join(ids, "paragraph_id")


def countered_with_edges(counters: DataFrame, paragraphs: DataFrame) -> DataFrame:
    ids = paragraphs.select(F.col("id").alias("paragraph_id"))
    return counters.select(F.col("id").alias("counter_id"), F.col("counters_id").alias("paragraph_id")).join(
        ids, "paragraph_id"
    )


def kb_stats(topics: DataFrame, paragraphs: DataFrame, sentences: DataFrame, counters: DataFrame) -> DataFrame:
    """Counts of the four node tables in one row, zeros included."""
    names = ["topic_count", "hate_para_count", "content_count", "counter_count"]
    counts = union_all(
        [
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
            for name, df in zip(names, [topics, paragraphs, sentences, counters])
        ]
    )
    return counts.agg(*[F.sum(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


def constraint_violations(nodes: DataFrame, key: str, label: str) -> DataFrame:
    """Keys that are missing or not unique."""
    counted = nodes.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("rows"))
    broken = F.when(F.col("key").isNull(), "exists").when(F.col("rows") > 1, "unique")
    return counted.withColumn("violation", broken).filter(F.col("violation").isNotNull()).select(
        F.lit(label).alias("label"), "key", "violation", "rows"
    )


def unlinked_nodes(sentences: DataFrame, counters: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Counters that name a paragraph, and sentences and counters whose paragraph is missing."""
    ids = paragraphs.select(F.col("id").alias("_id")).distinct()

    def parents(nodes: DataFrame, key: str) -> DataFrame:
        return nodes.select(key).join(ids, F.col(key) == F.col("_id"), "left")

    missing = F.count_if(F.col("_id").isNull())
    named = parents(counters, "counters_id").agg(
        F.count("counters_id").alias("counters_with_id"), missing.alias("counters_unlinked")
    )
    held = parents(sentences, "paragraph_id").agg(missing.alias("sentences_unlinked"))
    return union_all([df.unpivot([], df.columns, "measure", "rows") for df in (named, held)])


def next_id_base(paragraphs: DataFrame) -> DataFrame:
    return paragraphs.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("max_id"))


def kb_ready(paragraphs: DataFrame) -> DataFrame:
    return paragraphs.agg((F.count("*") > 0).alias("ready"))


# --- generated examples --------------------------------------------------------------


def import_examples(examples: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Synthetic paragraphs from ``examples (line, topic, content)``.

    Ids go on after the highest one; topics follow in the order of their first line, lines
    in file order within a topic. Rows without content are no paragraphs.
    """
    named = examples.filter(strip(F.col("topic")) != "").withColumn("topic", strip(F.col("topic")))
    first_lines = named.groupBy("topic").agg(F.min("line").alias("_first"))
    usable = named.filter(F.col("content").isNotNull()).join(first_lines, "topic")
    numbered = with_ordinal(usable.select("topic", "line", "content", "_first"), ["_first", "line"], "_number", key=["_first", "line"])
    scores = [F.lit(v).alias(k) for k, v in fixed.SYNTHETIC_SCORES.items()]
    return numbered.select(
        (next_id_base(paragraphs).scalar() + F.col("_number")).alias("id"),
        "content", "topic",
        F.lit(0).cast("bigint").alias("source_debate"),
        *scores,
        F.lit(True).alias("is_synthetic"),
        F.lit(fixed.SYNTHETIC_CONTENT_TYPE).alias("content_type"),
    )


def append_synthetic(paragraphs: DataFrame, examples: DataFrame) -> DataFrame:
    return paragraphs.unionByName(import_examples(examples, paragraphs), allowMissingColumns=True)


def merge_topics(topics: DataFrame, examples: DataFrame) -> DataFrame:
    """Existing topics and the new ones of the examples, each marked by origin."""
    names = examples.select(strip(F.col("topic")).alias("name")).filter(F.col("name") != "").distinct()
    fresh = names.join(topics, "name", "left_anti")
    return topics.select("name", F.lit(False).alias("created")).unionByName(
        fresh.select("name", F.lit(True).alias("created"))
    )


def import_stats(examples: DataFrame) -> DataFrame:
    """Topics, imported examples and errors in one pass over the examples kept by the scan."""
    named = strip(F.col("topic")) != ""
    return examples.filter(named).agg(
        F.countDistinct(strip(F.col("topic"))).alias("topics_processed"),
        F.count_if(F.col("content").isNotNull()).alias("examples_imported"),
        F.count_if(F.col("content").isNull()).alias("errors"),
    )


def remove_synthetic(paragraphs: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Paragraphs and (paragraph_id, …) edges without the synthetic ones, and the number removed."""
    gone = paragraphs.filter(synthetic())
    kept_edges = edges.join(gone.select(F.col("id").alias("paragraph_id")), "paragraph_id", "left_anti")
    return paragraphs.filter(~synthetic()), kept_edges, gone.agg(F.count("*").alias("removed"))


# --- embeddings ----------------------------------------------------------------------


def embedding_format(array: Column, text: Column) -> Column:
    """How an embedding is stored; each row is looked at by itself."""
    return (
        F.when(array.isNotNull(), "array")
        .when(text.isNull(), "missing")
        .when(embedding_from_json(text).isNotNull(), "json")
        .when(F.contains(text, F.lit(",")), "csv")
        .otherwise("unknown")
    )


def decode_embeddings(stored: DataFrame) -> DataFrame:
    """``embedding`` from an array, else JSON text, else comma separated text; null if unreadable."""
    text = F.col("embedding_text")
    decoded = F.coalesce("embedding", embedding_from_json(text), embedding_from_csv(text))
    return stored.withColumn("format", embedding_format(F.col("embedding"), text)).withColumn("embedding", decoded)


def embedding_format_profile(stored: DataFrame) -> DataFrame:
    form = embedding_format(F.col("embedding"), F.col("embedding_text"))
    return stored.groupBy(form.alias("format")).agg(F.count("*").alias("rows"))


def wrong_dimension(sentences: DataFrame, dimension: int = fixed.VECTOR_DIMENSION) -> DataFrame:
    found = sentences.select("id", F.size("embedding").cast("bigint").alias("dimension"))
    return found.filter(sentences["embedding"].isNotNull() & (F.col("dimension") != dimension))


def page_by_id(df: DataFrame, skip: int, limit: int) -> DataFrame:
    return df.orderBy("id").offset(skip).limit(limit)


def page_after_id(df: DataFrame, last_id: int, limit: int) -> DataFrame:
    """Next page by key: the filter reaches the scan, nothing before it is sorted."""
    return df.filter(F.col("id") > last_id).orderBy("id").limit(limit)


# --- overview ------------------------------------------------------------------------


def topic_overview(paragraphs: DataFrame, sentences: DataFrame, counters: DataFrame, top: int = 5) -> DataFrame:
    """Paragraphs, sentences and counters (a row is a node) per topic, the largest topics first.

    Each side is counted per paragraph before the join, so no product of sentences and
    counters comes into being.
    """
    per_sentence = sentences.groupBy(F.col("paragraph_id").alias("id")).agg(F.count("*").alias("_s"))
    per_counter = counters.groupBy(F.col("counters_id").alias("id")).agg(F.count("*").alias("_c"))
    named = paragraphs.filter(F.col("topic").isNotNull() & (F.col("topic") != "")).select("id", "topic")
    totals = (
        named.join(per_sentence, "id", "left")
        .join(per_counter, "id", "left")
        .groupBy("topic")
        .agg(
            F.count("*").alias("hate_paragraphs"),
            F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("hate_content_items"),
            F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("counter_paragraphs"),
        )
    )
    return totals.orderBy(F.desc("hate_paragraphs"), "topic").limit(top)


def edge_type_counts(edges: dict[str, DataFrame]) -> DataFrame:
    """Edges counted by source label, type and target label."""
    labelled = []
    for name, df in edges.items():
        source, kind, target = fixed.EDGE_LABELS[name]
        labelled.append(
            df.select(
                F.lit(source).alias("source_label"),
                F.lit(kind).alias("relationship_type"),
                F.lit(target).alias("target_label"),
            )
        )
    return union_all(labelled).groupBy("source_label", "relationship_type", "target_label").agg(
        F.count("*").alias("edges")
    )


def sample_nodes(
    topics: DataFrame, paragraphs: DataFrame, sentences: DataFrame, counters: DataFrame,
    topic_rows: int = 5, node_rows: int = 2, chars: int = 50,
) -> DataFrame:
    """A few nodes per label for a look at the tables; the content is a preview."""

    def preview(label: str, df: DataFrame) -> DataFrame:
        first = df.select("id", "content").orderBy("id").limit(node_rows)
        return first.select(
            F.lit(label).alias("label"), F.col("id").cast("string").alias("key"),
            F.substring("content", 1, chars).alias("preview"),
        )

    names = topics.orderBy("name").limit(topic_rows)
    return union_all(
        [
            names.select(F.lit("Topic").alias("label"), F.col("name").alias("key"), F.col("name").alias("preview")),
            preview("HateParagraph", paragraphs),
            preview("HateContent", sentences),
            preview("CounterParagraph", counters),
        ]
    )
