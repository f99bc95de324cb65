"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions import scores as score_fn
from rejoinder.functions import text as text_fn
from rejoinder.operators import assessment, evaluation, judge, lexical, nodes, requests, retrieval, semantic, transcripts, vector_index
from rejoinder.operators import knowledge_base as kb_ops
from rejoinder.plans import build_knowledge_base as kb_build
from rejoinder.plans import grow_knowledge_base as kb_grow
from rejoinder.plans.assess_queries import assess_and_request, assess_queries
from rejoinder.plans.fixtures import Inputs
from rejoinder.session import scratch_path, written, written_by
from rejoinder.sources import files
from rejoinder.streaming import mitigation
from rejoinder.streaming import transcripts as live

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}
ROUNDED = 6


def _settled(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, floating results rounded, so that engines can be compared."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        column = F.col(f"`{field.name}`")
        if kind == "double":
            column = F.round(column, ROUNDED).alias(field.name)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(name: str):
    def register(build: Callable[[Inputs], DataFrame]):
        CATALOG[name] = lambda spark, path: _settled(build(Inputs(spark, path)))
        return build

    return register


# --- sources and sinks ---------------------------------------------------------------


def _place(i: Inputs, name: str) -> str:
    return scratch_path(i.spark, name)


def _topics_csv(i: Inputs) -> str:
    path = _place(i, "topics")
    files.write_csv(i.table("documents").select(F.col("source").alias("topic"), F.col("text").alias("position")), path)
    return path


@query("scan_topics")
def _(i):
    return files.scan_topics(i.spark, _topics_csv(i))


@query("distinct_topics")
def _(i):
    return files.distinct_topics(i.spark, _topics_csv(i))


@query("scan_debates")
def _(i):
    path = _place(i, "debates")
    # One object per line and part of a debate, so that no line grows with the length or number of debates.
    files.write_json(i.debates(), path)
    return files.scan_debates(i.spark, path).select(
        "debate_id", "part", "topic", "position",
        F.col("content.proponent").alias("proponent"),
        F.coalesce(F.size("full_debate"), F.lit(0)).alias("full_debate_messages"),
        F.coalesce(F.size("history"), F.lit(0)).alias("history_messages"),
    )


@query("scan_evaluated_pairs")
def _(i):
    path = _place(i, "evaluated")
    files.write_json(i.evaluated_pairs(), path)
    table = files.scan_evaluated_pairs(i.spark, path)
    return table.select(
        "pair_id", "topic", F.col("content.proponent").alias("proponent"),
        F.col("evaluation").isNotNull().alias("evaluated"),
        F.col("evaluation.scores.harmful_content.subtotal").alias("harmful_subtotal"),
        F.col("evaluation.scores.hate_speech.specificity").alias("specificity"),
        F.col("evaluation.scores.counterspeech.subtotal").alias("counter_subtotal"),
    )


@query("load_typed_csv")
def _(i):
    path = _place(i, "paragraphs")
    text = i.paragraphs().drop("is_synthetic").withColumn(
        "quality_score",
        F.when(F.col("id") % 50 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("quality_score").cast("string"))),
    )
    files.write_csv(text, path)
    return files.load_typed_csv(i.spark, path, files.PARAGRAPH_TYPES)


@query("load_lenient_counters")
def _(i):
    path = _place(i, "counters")
    files.write_csv(i.counters().select("id", "content", "counters_id"), path)
    return files.load_counters(i.spark, path)


@query("scan_jsonl_tolerant")
def _(i):
    found = files.classify_examples(i.example_lines()).filter(F.col("outcome") != "untitled")
    return found.select("line", "topic", "content", "outcome")


@query("scan_benchmark")
def _(i):
    path = _place(i, "benchmark")
    files.write_csv(
        i.benchmark().select(
            F.col("hate_speech").alias("HATE_SPEECH"), F.col("counter_narrative").alias("COUNTER_NARRATIVE"),
            F.col("target").alias("TARGET"),
        ),
        path,
    )
    return files.scan_benchmark(files.read_csv(i.spark, path))


@query("write_node_tables")
def _(i):
    path = _place(i, "nodes")
    files.write_tables(nodes.pairs_to_nodes(i.evaluated_pairs()), path, "csv")
    read = [files.read_csv(i.spark, f"{path}/{name}") for name in ("paragraphs", "sentences", "counters")]
    return nodes.node_counts(*read)


@query("write_json_results")
def _(i):
    path = _place(i, "metrics")
    files.write_json(evaluation.judge_averages(judge.parse_judge(i.judge_responses()), ["system"]), path)
    schema = "system string, " + ", ".join(f"avg_{m} double" for m in evaluation.JUDGE_METRICS)
    return i.spark.read.schema(schema).json(path)


@query("append_jsonl")
def _(i):
    path = _place(i, "examples")
    records = transcripts.split_marked_records(i.generated_texts())
    for _run in range(2):
        files.append_examples(records.select("topic", F.col("record").alias("content")), path, "m")
    table = i.spark.read.schema(files.EXAMPLE_SCHEMA).json(path)
    return table.groupBy("topic", "source", F.col("metadata.content_type").alias("content_type")).agg(
        F.count("*").alias("rows"), F.countDistinct("content").alias("contents")
    )


def _gold(i: Inputs) -> tuple[DataFrame, DataFrame]:
    judged = judge.parse_judge(i.judge_responses()).filter(F.col("system") == "gold").drop("system")
    return judged, i.toxicity().filter(F.col("system") == "gold").drop("system")


@query("export_metrics_csv")
def _(i):
    path = _place(i, "wide")
    wide = evaluation.example_metrics(i.benchmark(), *_gold(i))
    files.write_csv(wide, path)
    types = {f.name: f.dataType.simpleString() for f in wide.schema.fields}
    return files.load_typed_csv(i.spark, path, types)


@query("stamp_run_metadata")
def _(i):
    stamped = files.stamp_run(evaluation.quality_summary(i.scored_pairs()), {"search_method": "semantic", "sample": "all"})
    return stamped.select(
        "total_pairs", "run_version", F.col("run_arguments")["search_method"].alias("search_method"),
        (F.col("run_timestamp") > F.lit("2020-01-01").cast("timestamp")).alias("stamped"),
    )


# --- transcripts ---------------------------------------------------------------------


@query("extract_pairs")
def _(i):
    return transcripts.extract_pairs(i.messages())


@query("pair_source_precedence")
def _(i):
    return transcripts.flat_debate_pairs(i.debate_contents(), i.debate_messages()).drop("turn")


@query("next_turn_state")
def _(i):
    return transcripts.next_turn_state(i.messages(), i.table("documents").select(F.col("doc_id").alias("conv_id")))


@query("live_transcripts")
def _(i):
    """All messages as a stream in three runs over one checkpoint: odd turns with repeats, then the earlier ones, then a
    heartbeat that lets the watermark pass."""
    turns = i.messages().agg(F.coalesce(F.max("turn"), F.lit(0)).alias("last"), F.coalesce(F.max("conv_id"), F.lit(0)).alias("debates")).first()
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn") * 60)
    messages = i.messages().select("conv_id", "turn", "role", "content", at.alias("ts"))
    folder, place = _place(i, "messages"), _place(i, "live")
    odd = F.col("turn") % 2 == 1
    heartbeat = i.spark.range(1).select(
        F.lit(turns.debates + 1).alias("conv_id"), F.lit(0).cast("bigint").alias("turn"), F.lit("heartbeat").alias("role"),
        F.lit(None).cast("string").alias("content"), F.timestamp_seconds(F.lit(1_700_000_000 + (4 * turns.last + 10) * 60)).alias("ts"),
    )
    runs = [messages.filter(odd).unionByName(messages.filter(odd & (F.col("conv_id") % 3 == 0))), messages.filter(~odd), heartbeat]
    for arrived in runs:
        arrived.write.mode("append").parquet(folder)
        told = live.live_transcripts(live.read_messages(i.spark, folder), f"{turns.last + 2} minutes")
        rows = live.advance(told, place)
    pairs = live.pairs_told(rows).select(F.lit("pair").alias("kind"), "*")
    states = live.states_told(rows).filter(F.col("conv_id") <= turns.debates)  # the heartbeat's own waits for ever
    return pairs.unionByName(states.select(F.lit("state").alias("kind"), "*"), allowMissingColumns=True)


@query("render_transcript")
def _(i):
    return transcripts.render_transcript(i.messages())


@query("assign_batches")
def _(i):
    return transcripts.assign_batches(i.pairs().select("pair_id"), ["pair_id"])


@query("flag_corrupted")
def _(i):
    return transcripts.flag_corrupted(i.marked_pairs()).select("pair_id", "corrupted", "issue_message")


@query("default_scores_corrupted")
def _(i):
    flagged = transcripts.flag_corrupted(i.marked_pairs()).join(i.rubric_responses(), "pair_id", "left")
    return judge.default_corrupted(judge.score_responses(flagged)).select(
        "pair_id", "corrupted", *judge.PAIR_SCORES, "assessment"
    )


def _done(i: Inputs) -> DataFrame:
    """Earlier results: the pairs whose document has been labelled."""
    return i.pairs().join(i.table("labels"), F.col("conv_id") == F.col("doc_id"), "left_semi")


@query("resume_pending")
def _(i):
    return transcripts.resume_pending(i.pairs(), _done(i)).select("pair_id", "topic", "position", "proponent")


@query("judge_request_table")
def _(i):
    return transcripts.judge_requests(i.pairs())


@query("criteria_request_table")
def _(i):
    return requests.criteria_requests(i.pairs())


def _all_requests(i: Inputs) -> DataFrame:
    """What the judges, the embedding model and the toxicity service are to be asked about all pairs and documents."""
    pairs = written(i.pairs(), "pairs")
    sides = pairs.select("pair_id", F.explode(F.array("proponent", "opponent")).alias("text"))
    documents = i.table("documents")
    asked = [
        requests.as_requests(transcripts.judge_requests(pairs), "pair", F.col("prompt"), F.col("pair_id")),
        requests.as_requests(requests.criteria_requests(pairs), "criteria", F.col("prompt"), F.col("pair_id")),
        requests.as_requests(sides, "toxicity", F.col("text"), F.col("pair_id")),
        requests.as_requests(documents, "embedding", F.col("text"), F.col("doc_id")),
    ]
    return kb_ops.union_all(asked)


@query("request_ledger")
def _(i):
    """Three runs over one ledger: a third of the requests fail in the first, a few always; the rest is asked once."""
    asked, path = written_by(_all_requests(i), requests.TEXT_KEY, "requests"), _place(i, "ledger")
    ledger = i.spark.createDataFrame([], requests.LEDGER_SCHEMA)
    first = F.substring("request_key", 1, 1)
    told = []
    for run, fails in enumerate((first.isin("0", "1", "2", "3", "4"), first == "0", first == "0", first == "0"), 1):
        now = written(requests.open_requests(asked, ledger), "open-requests")
        requests.append_ledger(requests.asked(now, F.when(fails, "failed").otherwise("done")), path)
        ledger = i.spark.read.schema(requests.LEDGER_SCHEMA).parquet(path)
        told.append(now.groupBy("kind").agg(F.count("*").alias("asked"), F.sum("owners").alias("owners")).withColumn("run", F.lit(run)))
    return kb_ops.union_all(told)


@query("split_marked_records")
def _(i):
    return transcripts.split_marked_records(i.generated_texts())


@query("compile_evaluated_pairs")
def _(i):
    flagged = transcripts.flag_corrupted(i.marked_pairs()).join(i.rubric_responses(), "pair_id", "left")
    compiled = judge.compile_pairs(judge.default_corrupted(judge.score_responses(flagged)))
    harmful, reply = "evaluation.scores.harmful_content", "evaluation.scores.counterspeech"
    return compiled.select(
        "pair_id", "topic", "position", "content.proponent", "content.opponent",
        F.col(f"{harmful}.subtotal").alias("harmful_subtotal"),
        F.col(f"{reply}.subtotal").alias("counter_subtotal"),
        "evaluation.assessment", "evaluation.raw_response",
        F.coalesce(F.col("evaluation.content_issues.corrupted"), F.lit(False)).alias("corrupted"),
        F.col("evaluation.content_issues.message").alias("issue_message"),
    )


@query("evaluate_pairs")
def _(i):
    return i.scored_pairs().select(
        "pair_id", "topic", "position", "corrupted", *judge.PAIR_SCORES, "assessment", "quality", "high_quality"
    )


# --- judge responses -----------------------------------------------------------------


@query("parse_rubric_scores")
def _(i):
    return judge.parse_rubric(i.rubric_responses()).select(
        "pair_id", *fixed.RUBRIC_LABELS, "harmful_subtotal", "score_found"
    )


@query("fill_subtotals")
def _(i):
    filled = judge.fill_subtotals(judge.parse_rubric(i.rubric_responses()))
    return filled.select("pair_id", "harmful_subtotal", "counter_subtotal")


@query("keyword_fallback_scores")
def _(i):
    return judge.score_responses(i.rubric_responses()).select("pair_id", "score_found", *judge.PAIR_SCORES)


@query("extract_assessment")
def _(i):
    return i.rubric_responses().select("pair_id", judge.assessment_text(F.col("response")).alias("assessment"))


def _answer() -> Column:
    return F.coalesce(F.col("response"), F.lit(""))


@query("parse_json_judge")
def _(i):
    read = i.judge_responses().withColumn("_entries", judge.json_entries(_answer()))
    return read.select(
        "pair_id", "system", judge.json_scores(F.col("_entries")).alias("_s"),
        judge.json_feedback(F.col("_entries")).alias("feedback"),
    ).filter(F.col("_s").isNotNull()).select("pair_id", "system", "_s.*", "feedback")


@query("parse_label_judge")
def _(i):
    read = i.judge_responses().select("pair_id", "system", judge.label_scores(_answer()).alias("_s"))
    return read.filter(F.col("_s").isNotNull()).select("pair_id", "system", "_s.*")


@query("parse_first_five_numbers")
def _(i):
    read = i.judge_responses().select("pair_id", "system", judge.number_scores(_answer()).alias("_s"))
    return read.filter(F.col("_s").isNotNull()).select("pair_id", "system", "_s.*")


@query("judge_defaults")
def _(i):
    parsed = judge.parse_judge(i.judge_responses())
    return parsed.filter(F.col("parse_method").isin("default", "failed"))


@query("extract_feedback")
def _(i):
    return i.judge_responses().select("pair_id", "system", judge.feedback_text(_answer()).alias("feedback"))


@query("parse_judge")
def _(i):
    return judge.parse_judge(i.judge_responses())


# --- node tables ---------------------------------------------------------------------


@query("split_sentences")
def _(i):
    return nodes.split_sentences(i.paragraphs(spread=True))


@query("extract_turn_number")
def _(i):
    message = F.when(
        F.col("turn") % 2 == 0, F.concat(F.lit("Turn "), F.col("turn").cast("string"), F.lit(": "), F.col("content"))
    ).otherwise(F.col("content"))
    return i.messages().select("conv_id", "turn", text_fn.turn_number(message).alias("turn_number"))


@query("resolve_scores")
def _(i):
    return nodes.resolve_scores(i.evaluated_pairs()).select("pair_id", *judge.PAIR_SCORES, "assessment")


def _numbered(i: Inputs) -> DataFrame:
    return nodes.assign_ids(nodes.resolve_scores(i.evaluated_pairs()))


@query("build_paragraphs")
def _(i):
    return nodes.build_paragraphs(_numbered(i))


@query("build_sentences")
def _(i):
    vectors = i.table("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return nodes.build_sentences(nodes.build_paragraphs(_numbered(i)), vectors).select(
        "id", "content", "paragraph_id",
        F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dimension"),
    )


@query("build_counters")
def _(i):
    return nodes.build_counters(_numbered(i))


@query("assign_ids")
def _(i):
    return nodes.assign_ids(i.pairs().select("pair_id"))


def _node_counts(i: Inputs) -> DataFrame:
    made = nodes.pairs_to_nodes(i.evaluated_pairs())
    return nodes.node_counts(made["paragraphs"], made["sentences"], made["counters"])


@query("node_counts")
def _(i):
    return _node_counts(i)


@query("pairs_to_nodes")
def _(i):
    made = nodes.pairs_to_nodes(i.evaluated_pairs())
    return kb_ops.union_all(
        [
            made["paragraphs"].select(
                F.lit("paragraph").alias("node"), "id", "content", F.col("id").alias("parent_id"), "quality_score"
            ),
            made["sentences"].select(
                F.lit("sentence").alias("node"), "id", "content", F.col("paragraph_id").alias("parent_id"),
                F.lit(None).cast("double").alias("quality_score"),
            ),
            made["counters"].select(
                F.lit("counter").alias("node"), "id", "content", F.col("counters_id").alias("parent_id"), "quality_score"
            ),
        ]
    )


# --- knowledge base ------------------------------------------------------------------


@query("build_topics")
def _(i):
    existing = i.table("documents").select(F.col("lang").alias("name"))
    return kb_ops.build_topics(i.paragraphs(), existing)


@query("edges_paragraph_topic")
def _(i):
    return i.edges()["paragraph_topic"]


@query("edges_contains")
def _(i):
    return i.edges()["contains"]


@query("edges_counter_topic")
def _(i):
    return i.edges()["counter_topic"]


@query("edges_countered_with")
def _(i):
    return i.edges()["countered_with"]


@query("kb_stats")
def _(i):
    return kb_ops.kb_stats(*i.kb())


def _rebuilt(i: Inputs) -> retrieval.KnowledgeBase:
    path = _place(i, "kb")
    kb = i.kb()
    made = {"paragraphs": kb.paragraphs, "sentences": kb.sentences, "counters": kb.counters}
    for _run in range(2):  # the second run replaces the first
        kb_build.rebuild(made, path)
    return kb_build.load(i.spark, path)


@query("rebuild_kb")
def _(i):
    return kb_ops.kb_stats(*_rebuilt(i))


@query("grow_kb")
def _(i):
    """Import, growth by all example lines and removal of synthetic paragraphs, each a version; old versions stay readable."""
    root, spark = _place(i, "versions"), i.spark
    nodes = {"paragraphs": i.paragraphs(), "sentences": i.sentences(), "counters": i.counters()}
    first = kb_grow.import_nodes(spark, nodes, root)
    second, _, _ = kb_grow.grow(spark, root, i.example_lines())
    third = kb_grow.remove_synthetic(spark, root)
    return kb_ops.union_all([kb_grow.counts(spark, v) for v in (first, second, third)])


@query("constraint_violations")
def _(i):
    key = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 50 == 1, F.col("id") + 1).otherwise(F.col("id"))
    loose = i.paragraphs().select(key.alias("id"))
    kb = i.kb()
    return kb_ops.union_all(
        [
            kb_ops.constraint_violations(kb.topics, "name", "Topic"),
            kb_ops.constraint_violations(loose, "id", "HateParagraph"),
            kb_ops.constraint_violations(kb.sentences, "id", "HateContent"),
            kb_ops.constraint_violations(kb.counters, "id", "CounterParagraph"),
        ]
    )


@query("unlinked_nodes")
def _(i):
    return kb_ops.unlinked_nodes(i.sentences(), i.counters(), i.paragraphs())


@query("next_id_base")
def _(i):
    return kb_ops.next_id_base(i.paragraphs())


def _examples(i: Inputs) -> DataFrame:
    return files.parse_examples(i.example_lines())[0]


@query("append_synthetic")
def _(i):
    return kb_ops.append_synthetic(i.paragraphs(), _examples(i))


@query("merge_topics")
def _(i):
    """Known topics of all documents; a third of the examples are of topics that are new."""
    known = i.table("documents").select(F.col("source").alias("name")).distinct()
    topic = F.when(F.col("line") % 3 == 0, F.concat("topic", F.lit(" anew"))).otherwise(F.col("topic"))
    return kb_ops.merge_topics(known, _examples(i).withColumn("topic", topic))


@query("import_stats")
def _(i):
    return kb_ops.import_stats(_examples(i))


@query("remove_synthetic")
def _(i):
    kb = i.kb()
    paragraphs, edges, removed = kb_ops.remove_synthetic(kb.paragraphs, kb_ops.contains_edges(kb.sentences, kb.paragraphs))
    return kb_ops.union_all(
        [
            paragraphs.agg(F.count("*").alias("rows")).select(F.lit("paragraphs").alias("measure"), "rows"),
            edges.agg(F.count("*").alias("rows")).select(F.lit("edges").alias("measure"), "rows"),
            removed.select(F.lit("removed").alias("measure"), F.col("removed").alias("rows")),
        ]
    )


def _embedding_sum(embedding: Column) -> Column:
    return F.aggregate(embedding, F.lit(0.0), lambda total, x: total + x.cast("double"))


def _decoded(i: Inputs, form: str) -> DataFrame:
    """All stored embeddings: decoded if they are in this form, arrays as they are, others untouched."""
    stored = i.stored_embeddings()
    found = kb_ops.decode_embeddings(stored).select("id", "format", F.col("embedding").alias("_decoded"))
    own = F.when(F.col("format") == form, F.col("_decoded")).otherwise(F.col("embedding"))
    both = stored.join(found, "id").withColumn("embedding", own)
    return both.select(
        "id", "format", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dimension"),
        _embedding_sum(F.col("embedding")).alias("total"),
        F.when(F.col("format") != form, F.size(F.split("embedding_text", ","))).alias("untouched_parts"),
    )


@query("decode_embedding_json")
def _(i):
    return _decoded(i, "json")


@query("decode_embedding_csv")
def _(i):
    return _decoded(i, "csv")


@query("embedding_format_profile")
def _(i):
    return kb_ops.embedding_format_profile(i.stored_embeddings())


@query("embedding_dim_check")
def _(i):
    return kb_ops.wrong_dimension(kb_ops.decode_embeddings(i.stored_embeddings()))


@query("page_by_id")
def _(i):
    return kb_ops.page_by_id(i.sentences().select("id", "paragraph_id"), 100, 100)


@query("kb_ready")
def _(i):
    return kb_ops.kb_ready(i.paragraphs())


@query("topic_overview")
def _(i):
    return kb_ops.topic_overview(i.paragraphs(), i.sentences(), i.counters())


@query("edge_type_counts")
def _(i):
    return kb_ops.edge_type_counts(i.edges())


@query("sample_nodes")
def _(i):
    kb = i.kb()
    texts = nodes.split_sentences(kb.paragraphs).select(
        (F.col("id") * 1_000_000_000 + F.col("position")).alias("id"), F.col("sentence").alias("content")
    )
    return kb_ops.sample_nodes(kb.topics, kb.paragraphs, texts, kb.counters)


# --- retrieval -----------------------------------------------------------------------


@query("keywords_v1")
def _(i):
    words = text_fn.keywords(F.col("query"))
    return i.text_queries().select("query_id", F.posexplode(words).alias("position", "keyword"))


@query("keywords_v2")
def _(i):
    words = text_fn.keywords(F.col("query"), stop_words=fixed.STOP_WORDS)
    return i.text_queries().select("query_id", F.posexplode(words).alias("position", "keyword"))


@query("query_phrases")
def _(i):
    return i.text_queries().select("query_id", F.posexplode(text_fn.phrases(F.col("query"))).alias("position", "phrase"))


@query("query_terms")
def _(i):
    return lexical.terms_v2(i.text_queries())


@query("lexical_match")
def _(i):
    return lexical.score_v2(i.text_queries(), i.paragraphs(spread=True)).select("query_id", "id")


@query("lexical_score_v1")
def _(i):
    return lexical.score_v1(i.text_queries(), i.paragraphs(spread=True)).select("query_id", "id", "score")


@query("lexical_score_v2")
def _(i):
    return lexical.score_v2(i.text_queries(), i.paragraphs(spread=True)).select("query_id", "id", "score")


def _results(i: Inputs, hits: DataFrame, score: str) -> DataFrame:
    """Result rows of a search. The hits are few per query; their texts are looked up last."""
    found = retrieval.attach_details(written(hits, "hits"), i.kb())
    return found.select(
        "query_id", "rank", "layer", "id", "content", "topic", "quality_score", "counter_id", "counter_content", score
    )


@query("search_lexical_single")
def _(i):
    hits = lexical.single_layer_hits(i.text_queries(), i.paragraphs(spread=True)).withColumnRenamed("score", "relevance_score")
    return _results(i, hits, "relevance_score").drop("layer")


@query("search_lexical_two_layer")
def _(i):
    hits = lexical.two_layer_hits(i.text_queries(), i.paragraphs(spread=True)).withColumnRenamed("score", "relevance_score")
    return _results(i, hits, "relevance_score")


@query("search_lexical_v2")
def _(i):
    return _results(i, retrieval.search(i.text_queries(), i.kb(spread=True), "syntax"), "relevance_score")


@query("expand_topic_counter")
def _(i):
    return retrieval.expand_topic_counter(i.paragraphs(), i.counters())


@query("dedupe_by_id")
def _(i):
    first = lexical.phrase_hits(i.text_queries(), i.paragraphs(spread=True))
    second = lexical.two_layer_hits(i.text_queries(), i.paragraphs(spread=True))
    listed = first.unionByName(second.withColumn("rank", F.col("rank") + 2 * fixed.RESULTS_PER_LAYER))
    return retrieval.dedupe_by_id(listed)


@query("cosine_similarity")
def _(i):
    this = i.sentences().select("id", "embedding")
    following = i.sentences().select((F.col("id") - 1).alias("id"), F.col("embedding").alias("_next"))
    return this.join(following, "id").select("id", score_fn.cosine(F.col("embedding"), F.col("_next")).alias("similarity"))


FETCH = fixed.VECTOR_OVERFETCH * fixed.RESULTS_PER_LAYER


@query("knn_sentences")
def _(i):
    return semantic.nearest_sentences(i.queries(), i.sentences(), FETCH)


@query("similarity_threshold")
def _(i):
    return semantic.above_threshold(semantic.nearest_sentences(i.queries(), i.sentences(), FETCH))


@query("rollup_to_paragraph")
def _(i):
    nearest = semantic.above_threshold(semantic.nearest_sentences(i.queries(), i.sentences(), FETCH))
    return semantic.rollup_to_paragraphs(nearest, i.sentences(), i.paragraphs())


@query("search_semantic")
def _(i):
    return _results(i, retrieval.search(i.queries(), i.kb(), "semantic"), "similarity_score")


@query("search_semantic_by_quality")
def _(i):
    return _results(i, retrieval.search(i.queries(), i.kb(), "semantic", order_by="quality_score"), "similarity_score")


@query("search_topic_fallback")
def _(i):
    hits = semantic.topic_name_hits(i.topic_queries(), i.topics(), i.paragraphs()).drop("quality_score")
    return _results(i, hits, "similarity_score")


@query("search_hybrid")
def _(i):
    found = _results(i, retrieval.search(i.queries(), i.kb(spread=True), "hybrid"), "similarity_score")
    return found


def _mixed_queries(i: Inputs) -> DataFrame:
    """All benchmark rows: half with their text and vector, a quarter without vector, a quarter with a cut one; these
    have a short text that is part of topic names."""
    kind, short = F.col("query_id") % 4, i.topic_queries().withColumnRenamed("query", "short")
    vector = F.when(kind >= 2, F.col("embedding")).when(kind == 1, F.slice("embedding", 1, 8))
    mixed = i.queries().join(short, "query_id")
    return written(mixed.select("query_id", F.when(kind >= 2, F.col("query")).otherwise(F.col("short")).alias("query"), vector.alias("embedding")), "queries")


@query("search_with_fallback")
def _(i):
    return _results(i, retrieval.search(_mixed_queries(i), i.kb(), "semantic"), "similarity_score")


@query("rejected_vectors")
def _(i):
    decoded = kb_ops.decode_embeddings(i.stored_embeddings())
    cut = F.when(F.col("id") % 10 == 1, F.slice("embedding", 1, 8)).otherwise(F.col("embedding"))
    return semantic.rejected_vectors(decoded.withColumn("embedding", cut), "id", _dimension(i))


def _dimension(i: Inputs) -> int:
    return i.table("embeddings").agg(F.mode(F.size("embedding"), True)).first()[0] or 0


@query("index_recall")
def _(i):
    """The indexed search of all queries against the exact one; every vector is in one list."""
    index, rejected = vector_index.build_index(i.sentences(), _dimension(i), _place(i, "vector-index"), k=FETCH)
    queries = i.queries()
    found = vector_index.indexed_nearest(index, queries, FETCH)
    told = vector_index.recall_of(found, semantic.nearest_sentences(queries, i.sentences(), FETCH))
    listed = i.spark.read.schema(vector_index.LIST_SCHEMA).parquet(index.path).agg(F.count("*").alias("indexed"))
    return told.crossJoin(listed).crossJoin(rejected.agg(F.count("*").alias("rejected"))).select(
        "queries", "wanted", "indexed", "rejected", (F.col("recall") >= 0.95).alias("recall_reached")
    )


@query("fill_counter_by_topic")
def _(i):
    hits = written(retrieval.search(i.queries(), i.kb(spread=True), "hybrid"), "hits")
    filled = retrieval.fill_counters(retrieval.attach_details(hits, i.kb()), i.counters())
    return filled.select(
        "query_id", "rank", "layer", "id", "topic", "counter_id", "counter_content",
        "directness", "evidence_quality", "persuasiveness",
    )


@query("counter_context")
def _(i):
    return retrieval.retrieve_context(i.queries(), i.stored_kb(spread=True), "hybrid")


# --- assessment ----------------------------------------------------------------------


def _context(i: Inputs) -> DataFrame:
    return retrieval.retrieve_context(i.queries(), i.stored_kb())


@query("raw_score")
def _(i):
    return assessment.score_hits(_context(i)).select("query_id", "rank", "hate_paragraph_id", "raw_score")


@query("top3_mean")
def _(i):
    return assessment.top_mean(_context(i))


@query("calibrate")
def _(i):
    raw = assessment.score_hits(_context(i))
    return raw.select(
        "query_id", "rank", score_fn.calibrated(F.col("raw_score")).alias("calibrated_score"),
        score_fn.severity(F.col("raw_score")).alias("severity"),
    )


@query("assessment_details")
def _(i):
    return assessment.assessment_details(_context(i))


@query("mitigation_level")
def _(i):
    return assess_queries(i.queries(), i.stored_kb(spread=True), "hybrid").select("query_id", "mitigation_level")


@query("mitigation_summary")
def _(i):
    return assessment.mitigation_summary(assess_queries(i.queries(), i.stored_kb()))


@query("mitigation_running_counts")
def _(i):
    levels = written(assess_queries(i.queries(), i.stored_kb()).select("query_id", "mitigation_level"), "levels")
    events = mitigation.read_events(i.spark, i.path)
    return mitigation.run_to_end(mitigation.level_counts(events, levels), "running_counts")


@query("closed_daily_counts")
def _(i):
    """The events in two runs over one checkpoint, each with repeats; the second also brings events that are too late."""
    levels = written(assess_queries(i.queries(), i.stored_kb()).select("query_id", "mitigation_level"), "levels")
    events = i.table("events")
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    middle = ends.first + (ends.last - ends.first) / 2
    early, again = F.col("ts") < F.lit(middle), F.col("event_id") % 10 == 0
    stale = events.filter(F.col("ts") < F.lit(middle - timedelta(days=1))).withColumn("event_id", -1 - F.col("event_id"))
    runs = [events.filter(early), events.filter(~early)]
    folder, place = _place(i, "events"), _place(i, "daily")
    for arrived, more in zip(runs, (stale.limit(0), stale), strict=True):
        arrived.unionByName(arrived.filter(again)).unionByName(more).write.mode("append").parquet(folder)
        stream = mitigation.read_events(i.spark, folder, "*.parquet")
        told = mitigation.advance(mitigation.closed_daily_counts(stream, levels), place)
    return told.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "mitigation_level", "queries")


@query("assess_queries")
def _(i):
    return assess_queries(i.queries(), i.stored_kb())


@query("assess_queries_syntax")
def _(i):
    return assess_queries(i.queries(), i.stored_kb(spread=True), "syntax")


@query("assess_queries_hybrid")
def _(i):
    return assess_queries(i.queries(), i.stored_kb(spread=True), "hybrid")


@query("context_mild")
def _(i):
    return assessment.mild_examples(_context(i))


@query("context_strong")
def _(i):
    return assessment.strong_examples(_context(i))


@query("response_request_table")
def _(i):
    return assess_and_request(i.queries(), i.stored_kb())[2]


# --- evaluation ----------------------------------------------------------------------


@query("judge_averages")
def _(i):
    return evaluation.judge_averages(judge.parse_judge(i.judge_responses()), ["system"])


@query("toxicity_averages")
def _(i):
    return evaluation.toxicity_averages(i.toxicity(), ["system"])


@query("toxicity_reduction")
def _(i):
    return evaluation.toxicity_reduction(i.toxicity(), ["system"])


@query("example_metrics_wide")
def _(i):
    return evaluation.example_metrics(i.benchmark(), *_gold(i))


@query("compare_judge")
def _(i):
    return evaluation.compare_judge(judge.parse_judge(i.judge_responses()))


@query("compare_toxicity")
def _(i):
    return evaluation.compare_toxicity(i.toxicity())


@query("sample_n")
def _(i):
    return evaluation.sample_n(i.benchmark(), 100, "pair_id").select("pair_id", "target")


@query("stratified_sample")
def _(i):
    return evaluation.stratified_sample(i.table("documents").select("doc_id", "lang", "source"), "lang", "doc_id")


@query("sample_examples")
def _(i):
    return evaluation.sample_examples(i.benchmark(), *_gold(i))


@query("pair_quality")
def _(i):
    unset = F.when(F.col("pair_id") % 4 != 3, F.col("counter_subtotal"))
    return evaluation.with_quality(i.scored_pairs().withColumn("counter_subtotal", unset)).select("pair_id", "quality")


@query("rank_pairs")
def _(i):
    return evaluation.rank_pairs(i.scored_pairs()).select("pair_id", "quality", "place")


@query("filter_high_quality")
def _(i):
    return evaluation.filter_high_quality(i.scored_pairs()).select("pair_id", "quality")


@query("quality_summary")
def _(i):
    return evaluation.quality_summary(i.scored_pairs())


@query("run_summary")
def _(i):
    return evaluation.run_summary(*_gold(i))


@query("report_tables")
def _(i):
    return evaluation.report_tables(*_gold(i), "benchmark", "semantic")


@query("evaluate_system")
def _(i):
    return evaluation.evaluate_systems(judge.parse_judge(i.judge_responses()), i.toxicity())
