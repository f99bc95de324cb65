"""Inputs of the registered queries, derived from the given tables (whole tables, no subsets).

FIXTURES.md lists the definitions; the SQL twins are in ``oracles/views.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.text import whole_parts
from rejoinder.operators import knowledge_base as kb_ops
from rejoinder.operators.retrieval import KnowledgeBase
from rejoinder.operators.transcripts import extract_pairs, with_parts
from rejoinder.plans.evaluate_pairs import evaluate_pairs
from rejoinder.session import written
from rejoinder.sources.files import EVALUATION, MESSAGES

DEBATE_IDS = 1_000_000
PAIR_TURNS = 1_000_000  # turns of a conversation that have a pair id in (conv_id, turn) order
PARAGRAPH_STEP = 7


class Inputs:
    """Lazy views over one directory of tables."""

    _schemas: dict[str, T.StructType] = {}  # by file, so that a footer is read once per process

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        file = f"{self.path}/{name}.parquet"
        if file not in self._schemas:
            self._schemas[file] = self.spark.read.parquet(file).schema
        return self.spark.read.schema(self._schemas[file]).parquet(file)

    def spread_table(self, name: str) -> DataFrame:
        """A table for heavy work per row: if its scan gives fewer tasks than there are cores
        (one small file), its rows are spread first. A large table is read as it lies."""
        df = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    # transcripts

    def messages(self) -> DataFrame:
        role = (
            F.when(F.col("role") == "user", "proponent")
            .when(F.col("role") == "assistant", "opponent")
            .otherwise(F.col("role"))
        )
        return self.table("conversations").select("conv_id", "turn", role.alias("role"), F.col("text").alias("content"))

    def topics_of_documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", _topic().alias("topic"), F.col("lang").alias("position"))

    def pairs(self) -> DataFrame:
        walked = extract_pairs(self.messages())
        return walked.join(self.topics_of_documents(), F.col("conv_id") == F.col("doc_id"), "left").select(
            _pair_id().alias("pair_id"),
            "conv_id", "topic", "position", "proponent", "opponent",
        )

    def marked_pairs(self) -> DataFrame:
        """Pairs, some replies followed by one of the corruption markers."""
        markers = F.array(*[F.lit(m) for m in fixed.CORRUPTION_MARKERS])
        marker = F.try_element_at(markers, (F.col("conv_id") % 20 + 1).cast("int"))
        return self.pairs().withColumn(
            "opponent", F.concat("opponent", F.coalesce(F.concat(F.lit(" "), marker), F.lit("")))
        )

    def debates(self) -> DataFrame:
        """Nested debates, a row for each part of a conversation (``transcripts.with_parts``), so that rows stay small:
        ready content, full_debate or history. Pairs are walked on message rows."""
        kind = F.col("conv_id") % 3
        arrays = F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "role", "content"))),
            lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
        )

        grouped = (
            with_parts(self.messages())
            .groupBy("conv_id", "_block", "_piece")
            .agg(F.first("part").alias("part"), arrays.alias("_all"), _first("proponent").alias("_p"), _first("opponent").alias("_o"))
            .join(self.topics_of_documents(), F.col("conv_id") == F.col("doc_id"), "left")
        )
        content = F.when(kind == 0, F.struct(F.col("_p").alias("proponent"), F.col("_o").alias("opponent")))
        return grouped.select(
            (F.col("conv_id") * DEBATE_IDS).alias("debate_id"),
            "part", "topic", "position",
            content.alias("content"),
            F.when(kind == 1, F.col("_all")).otherwise(F.array().cast(MESSAGES)).alias("full_debate"),
            F.when(kind == 2, F.col("_all")).alias("history"),
        )

    def debate_contents(self) -> DataFrame:
        """Ready content of the debates that have it; a debate is a whole conversation."""
        firsts = F.struct(_first("proponent").alias("proponent"), _first("opponent").alias("opponent"))
        ready = self.messages().filter(F.col("conv_id") % 3 == 0)
        return ready.groupBy("conv_id").agg(firsts.alias("content")).select(
            (F.col("conv_id") * DEBATE_IDS).alias("debate_id"), "content"
        )

    def debate_messages(self) -> DataFrame:
        """Messages of the other debates, one row each, so that a long one is spread over tasks."""
        kind = F.col("conv_id") % 3
        return self.messages().filter(kind != 0).select(
            (F.col("conv_id") * DEBATE_IDS).alias("debate_id"),
            F.when(kind == 1, "full_debate").otherwise("history").alias("source"),
            "turn", "role", "content",
        )

    # judge

    def rubric_responses(self) -> DataFrame:
        """Answers to pair requests in six layouts."""

        def s(k: int) -> Column:
            return _tenths(40 + (F.col("pair_id") + k) % 60)

        layouts = [
            ["HARMFUL CONTENT\nRepresentativeness: ", s(1), "/10\nCoherence: ", s(2), "/10\nHarmfulness: ", s(3),
             "/10\nSubtotal: ", s(7), "\nCOUNTERSPEECH\nDirectness: ", s(4), "\nEvidence Quality: ", s(5),
             "/10\nPersuasiveness: ", s(6), "\nSubtotal: ", s(8), "\nOVERALL ASSESSMENT:  Reply ",
             F.col("pair_id").cast("string"), " holds up. \nEnd"],
            ["1. **Representativeness**: ", s(1), "\n2. **Coherence** ", s(2), "\n3. harmfulness ", s(3),
             "\n**Directness**: ", s(4), "\n**Evidence Quality**: ", s(5), "\n**Persuasiveness:** ", s(6),
             "\nCounterspeech subtotal: ", s(8)],
            ["Representativeness: [", s(1), "/10]\nDirectness: [", s(4), "/10]\nOVERALL ASSESSMENT: plain"],
            ["Assessment in words: an excellent reply"],
            ["Assessment in words: a good reply"],
            [""],
        ]
        return self.pairs().select("pair_id", _choose(F.col("conv_id") % 6, layouts).alias("response"))

    def judge_responses(self) -> DataFrame:
        """Answers of the five-criteria judge for two systems, one in six a failed call."""
        systems = F.explode(F.array(*[
            F.struct(F.lit(name).alias("system"), F.lit(shift).alias("shift"))
            for name, shift in (("gold", 0), ("generated", 17))
        ]))

        def v(k: int) -> Column:
            return _tenths(10 + (F.col("pair_id") + 13 * k + F.col("shift")) % 90)

        pair = F.col("pair_id").cast("string")
        layouts = [
            ['Here it is: {"directness": ', v(1), ', "evidence_quality": "', v(2), '", "persuasiveness": ', v(3),
             ', "relevance": ', v(4), ', "feedback": "Clear reply ', pair, '."} Done.'],
            ["Directness: ", v(1), "\nEvidence Quality - ", v(2), "/10\nPersuasiveness = ", v(3), "\nRelevance ", v(4),
             "\nEffectiveness: ", v(5), '\nFeedback: sound enough"'],
            [v(1), " ", v(2), " ", v(3), " ", v(4), " ", v(5), " ", v(6)],
            ["No rating given for ", pair],
            ['{"directness": "', v(1), '/10", "evidence_quality": ', v(2), ', "persuasiveness": ', v(3),
             ', "relevance": ', v(4), ', "effectiveness": ', v(5), ', "feedback": "thin"}'],
        ]
        layout = (F.col("conv_id") + F.col("shift")) % 6
        return (
            self.pairs()
            .select("pair_id", "conv_id", systems.alias("_s"))
            .select("pair_id", "conv_id", "_s.*")
            .select(
                "pair_id", "system",
                _choose(layout, layouts).alias("response"),
                F.when(layout == 5, "timeout").alias("error"),
            )
        )

    # evaluation

    def benchmark(self) -> DataFrame:
        return self.pairs().select(
            "pair_id", F.col("proponent").alias("hate_speech"), F.col("opponent").alias("counter_narrative"),
            F.col("topic").alias("target"),
        )

    def toxicity(self) -> DataFrame:
        """Eight attribute scores per pair, side and system; one conversation in ten failed."""
        shift = F.col("shift")

        def scores(value) -> Column:
            entries = [(F.lit(a), value(i)) for i, a in enumerate(fixed.TOXICITY_ATTRIBUTES)]
            return F.create_map(*[x for entry in entries for x in entry])

        valid = F.col("conv_id") % 10 != 9
        rest = F.col("pair_id") % 101  # products of whole ids could leave the range of bigint
        hate = scores(lambda i: (rest * (7 + i)) % 101 / F.lit(100.0))
        counter = scores(lambda i: (rest * (3 + i) + 1 + shift) % 101 / F.lit(200.0))
        systems = F.explode(F.array(*[
            F.struct(F.lit(name).alias("system"), F.lit(n).alias("shift")) for name, n in (("gold", 0), ("generated", 17))
        ]))
        rows = self.pairs().select("pair_id", "conv_id", systems.alias("_s")).select("pair_id", "conv_id", "_s.*")
        return rows.select(
            "pair_id", "system",
            F.when(valid, hate).alias("hate_scores"),
            F.when(valid, counter).alias("counter_scores"),
            F.when(~valid, "unavailable").alias("error"),
        )

    def scored_pairs(self) -> DataFrame:
        return evaluate_pairs(self.marked_pairs(), self.rubric_responses())

    def evaluated_pairs(self) -> DataFrame:
        """Nested evaluated pairs; one in five with the older names, one in five not evaluated."""
        kind = F.col("conv_id") % 5
        parts = ["representativeness", "coherence", "harmfulness"]
        new = F.struct(*parts, F.col("harmful_subtotal").alias("subtotal"))
        old = F.struct(*parts[:2], F.col("harmfulness").alias("specificity"), F.col("harmful_subtotal").alias("subtotal"))
        reply = F.struct("directness", "evidence_quality", "persuasiveness", F.col("counter_subtotal").alias("subtotal"))
        scores = F.struct(
            F.when(kind != 0, new).alias("harmful_content"),
            F.when(kind == 0, old).alias("hate_speech"),
            reply.alias("counterspeech"),
        )
        evaluation = F.struct(
            scores.alias("scores"), "assessment",
            F.lit(None).cast("double").alias("timestamp"),
            F.col("response").alias("raw_response"),
            F.when(F.col("corrupted"), F.struct("corrupted", F.col("issue_message").alias("message"))).alias("content_issues"),
        )
        return self.scored_pairs().select(
            "pair_id", "topic", "position",
            F.struct("proponent", "opponent").alias("content"),
            F.when(kind != 1, evaluation).cast(EVALUATION).alias("evaluation"),
        )

    # knowledge base

    def paragraphs(self, spread: bool = False) -> DataFrame:
        doc = F.col("doc_id")
        fifth = whole_parts(doc, 20) % 5
        quality = F.lit(5.0) + doc % 11 * 0.5
        table = self.spread_table("documents") if spread else self.table("documents")
        return table.select(
            doc.alias("id"),
            F.col("text").alias("content"),
            _topic().alias("topic"),
            (doc + 1).alias("source_debate"),
            (F.lit(4.0) + doc % 7 * 0.5).alias("representativeness"),
            (F.lit(4.0) + doc % 5 * 0.5).alias("coherence"),
            quality.alias("harmfulness"),
            quality.alias("quality_score"),
            F.when(fifth == 0, True).when(fifth == 1, False).alias("is_synthetic"),
        )

    def sentences(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"),
            (whole_parts(F.col("vec_id"), 3) * PARAGRAPH_STEP).alias("paragraph_id"),
            "embedding",
        )

    def counters(self) -> DataFrame:
        target = self.table("documents").select(F.col("doc_id").alias("counters_id"), _topic().alias("topic"))
        marks = [
            (F.lit(4.0) + F.col("id") % n * 0.5).alias(name)
            for n, name in ((7, "directness"), (5, "evidence_quality"), (3, "persuasiveness"))
        ]
        return (
            self.pairs()
            .select(
                F.col("pair_id").alias("id"),
                (F.col("conv_id") * PARAGRAPH_STEP).alias("counters_id"),
                F.col("opponent").alias("content"),
            )
            .join(target, "counters_id", "left")
            .select("id", "counters_id", "content", "topic", *marks)
            .withColumn("quality_score", (F.col("directness") + F.col("evidence_quality") + F.col("persuasiveness")) / 3.0)
            .withColumn("assessment", F.lit(""))
        )

    def topics(self) -> DataFrame:
        return kb_ops.build_topics(self.paragraphs())

    def kb(self, spread: bool = False) -> KnowledgeBase:
        return KnowledgeBase(self.topics(), self.paragraphs(spread), self.sentences(), self.counters())

    def stored_kb(self, spread: bool = False) -> KnowledgeBase:
        """The knowledge base as retrieval meets it: the counters, which take a walk over all
        transcripts to make, are written before they are searched."""
        return KnowledgeBase(
            self.topics(), self.paragraphs(spread), self.sentences(), written(self.counters(), "counters")
        )

    def edges(self) -> dict[str, DataFrame]:
        kb = self.kb()
        return {
            "paragraph_topic": kb_ops.topic_edges(kb.paragraphs, kb.topics),
            "counter_topic": kb_ops.topic_edges(kb.counters, kb.topics),
            "contains": kb_ops.contains_edges(kb.sentences, kb.paragraphs),
            "countered_with": kb_ops.countered_with_edges(kb.counters, kb.paragraphs),
        }

    def stored_embeddings(self) -> DataFrame:
        """Embeddings as array, JSON text, comma text, broken text or missing."""
        kind = F.col("vec_id") % 5
        numbers = F.transform("embedding", lambda x: x.cast("string"))
        text = (
            F.when(kind == 1, F.to_json("embedding"))
            .when(kind == 2, F.array_join(numbers, ", "))
            .when(kind == 3, F.concat(F.lit("broken "), F.col("vec_id").cast("string")))
        )
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"), F.when(kind == 0, F.col("embedding")).alias("embedding"), text.alias("embedding_text")
        )

    def example_lines(self) -> DataFrame:
        """One JSON line per document; some broken, some blank, some without topic or content."""
        doc = F.col("doc_id")
        record = F.struct(
            F.when(doc % 26 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("source"))).alias("topic"),
            F.when(doc % 10 != 7, F.col("text")).alias("content"),
            F.lit("synthetic").alias("source"),
            F.lit("2024-01-01T00:00:00").alias("timestamp"),
            F.struct(F.lit("m").alias("model"), F.lit("social_media_comment").alias("content_type")).alias("metadata"),
        )
        value = (
            F.when(doc % 39 == 0, F.concat(F.lit('{"topic": "'), F.col("source"), F.lit('", "content": ')))
            .when(doc % 31 == 0, " ")
            .otherwise(F.to_json(record))
        )
        return self.table("documents").select(doc.alias("line"), value.alias("value"))

    def generated_texts(self) -> DataFrame:
        """Documents whose line breaks are record markers."""
        return self.table("documents").select(
            F.col("source").alias("topic"),
            F.col("doc_id").alias("gen_id"),
            F.replace("text", F.lit("\n"), F.lit(f" {fixed.RECORD_MARKER} ")).alias("text"),
        )

    # queries

    def text_queries(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))

    def queries(self) -> DataFrame:
        """All benchmark texts, each with the vector of the same number.

        Written, as the lookup reads the whole embedding table and a search reads its queries
        more than once."""
        vectors = self.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
        return written(self.text_queries().join(vectors, "query_id", "left"), "queries")

    def topic_queries(self) -> DataFrame:
        """Short queries that are parts of topic names, one per benchmark row."""
        return self.table("benchmark").select(
            F.col("item_id").alias("query_id"),
            F.concat(F.lit("SRC"), (F.col("item_id") % 12).cast("string")).alias("query"),
        )


def _first(role: str) -> Column:
    """The first message of a role in a group."""
    return F.min_by(F.when(F.col("role") == role, F.col("content")), F.when(F.col("role") == role, F.col("turn")))


def _pair_id() -> Column:
    """One number per (conv_id, turn), in that order: conv_id * 1,000,000 + turn. Where that is no bigint or the turn is
    beyond, a 64-bit hash of both, which two pairs of a corpus share with a probability of pairs^2 / 2^65."""
    conv, turn = F.col("conv_id"), F.col("turn")
    last = (2**63 - 1) // PAIR_TURNS - 1
    fits = conv.between(-last, last) & turn.between(0, PAIR_TURNS - 1)
    return F.when(fits, conv * PAIR_TURNS + turn).when(conv.isNotNull() & turn.isNotNull(), F.xxhash64(conv, turn))


def _topic() -> Column:
    return F.when(F.col("doc_id") % 17 == 0, "").otherwise(F.col("source"))


def _tenths(n: Column) -> Column:
    return F.concat_ws(".", whole_parts(n, 10).cast("string"), (n % 10).cast("string"))


def _choose(layout: Column, layouts: list[list]) -> Column:
    """Text of the numbered layout, null beyond the last."""
    chosen = None
    for number, parts in enumerate(layouts):
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        chosen = F.when(layout == number, text) if chosen is None else chosen.when(layout == number, text)
    return chosen
