"""The SQL twin of every registered query."""

from __future__ import annotations

from oracles.views import (
    METRICS, PAIR_SCORES, calibrated, raw, sentence_list, severity, text, with_views, words,
)
from rejoinder.functions import fixed_values as fixed
from rejoinder.operators import assessment, requests, transcripts

K = fixed.RESULTS_PER_LAYER


def r6(columns: list[str], prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in columns)


def _results(hits: str, score: str, layered: bool = True) -> str:
    return f"""
    SELECT query_id, rank, {'h.layer, ' if layered else ''}id, p.content, nullif(p.topic, '') AS topic,
           p.quality_score, counter_id, counter_content, {score}
    FROM {hits} h JOIN paragraphs p USING (id) LEFT JOIN first_counter USING (id)"""


def _details(hits: str) -> tuple[str, ...]:
    return (hits, "paragraphs", "first_counter")


def _wide() -> str:
    per = []
    for a in fixed.TOXICITY_ATTRIBUTES:
        for name, value in (
            ("counter", "counter"), ("hate", "hate"), ("reduction", "hate - counter"),
            ("pct_reduction", "CASE WHEN hate > 0 THEN (hate - counter) / hate * 100e0 END"),
        ):
            per.append(f"round(max({value}) FILTER (attribute = '{a}' AND valid), 6) AS {name}_{a}")
    scores = ", ".join(f"round(j.{m}, 6) AS llm_{m}" for m in METRICS)
    return f"""
    SELECT p.pair_id AS example_id, proponent AS hate_text, opponent AS counter_text, topic AS target, {scores},
           t.* EXCLUDE (pair_id)
    FROM pairs p LEFT JOIN gold_judged j USING (pair_id)
    LEFT JOIN (SELECT pair_id, {', '.join(per)} FROM toxicity WHERE system = 'gold' GROUP BY pair_id) t USING (pair_id)"""


def _title(column: str, separator: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({column}, '{separator}'), "
        f"lambda w: upper(w[1]) || lower(w[2:])), '{separator}')"
    )


def _signed(digits: int) -> str:
    small = f"{10.0 ** -digits:.{digits}f}e0"
    return (
        f"CASE WHEN abs(difference) < {small} THEN printf('%.{digits}f', round(difference, {digits})) "
        f"ELSE printf('%+.{digits}f', round(difference, {digits})) END"
    )


def _judge_long(source: str = "judge_means", keys: str = "system, ") -> str:
    return " UNION ALL ".join(f"SELECT {keys}'avg_{m}' AS metric, avg_{m} AS value FROM {source}" for m in METRICS)


def _report(where: str) -> str:
    return f"""
    SELECT 'judge' AS section, metric, value FROM ({_judge_long()}) WHERE {where}
    UNION ALL SELECT 'toxicity', side || ' ' || attribute, avg_all FROM toxicity_means WHERE {where}
    UNION ALL SELECT 'reduction', attribute, avg_reduction FROM toxicity_drops WHERE {where}
    UNION ALL SELECT 'reduction_percent', attribute, avg_reduction_percent FROM toxicity_drops WHERE {where}
    UNION ALL SELECT 'samples_with_reduction', attribute, samples_with_reduction FROM toxicity_drops WHERE {where}"""


def _only(system: str) -> str:
    return f"system = '{system}'"


def _draw(key: str) -> str:
    return f"md5({key}::VARCHAR || '|{fixed.SAMPLE_SEED}')"


def _request() -> str:
    def listed(source: str, order: str, limit: int) -> str:
        return f"""
        (SELECT query_id, string_agg(chr(10) || place || '. ' || content, '' ORDER BY place) AS lines
         FROM (SELECT query_id, content, row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS place
               FROM {source}) WHERE place <= {limit} GROUP BY query_id)"""

    opening = " ".join(f"WHEN '{k}' THEN {text(v)}" for k, v in assessment.REQUEST_TEXT.items())
    head = assessment.EXAMPLE_HEAD
    return f"""
    SELECT query_id, mitigation_level,
           (CASE mitigation_level {opening} END) || query ||
           CASE WHEN mitigation_level = 'mild' AND m.lines IS NOT NULL THEN {text(head['mild'])} || m.lines
                WHEN mitigation_level = 'strong' AND s.lines IS NOT NULL THEN {text(head['strong'])} || s.lines
                ELSE '' END AS prompt
    FROM semantic_assessed JOIN text_queries USING (query_id)
    LEFT JOIN {listed("(SELECT * FROM semantic_context WHERE content <> '')", 'rank', 2)} m USING (query_id)
    LEFT JOIN {listed(STRONG, 'quality DESC, rank', 3)} s USING (query_id)"""


STRONG = f"""(SELECT *, CASE WHEN directness + evidence_quality + persuasiveness = 0
                        THEN {fixed.DEFAULT_COUNTER_QUALITY}e0
                        ELSE directness + evidence_quality + persuasiveness END AS quality
              FROM semantic_context WHERE content <> '')"""

FOCUS = " ".join(f"WHEN {n} THEN {text(label)}" for n, label in fixed.TURN_FOCUS.items())
SYNTHETIC = ", ".join(f"{v}e0 AS {k}" for k, v in fixed.SYNTHETIC_SCORES.items())
FIVE = ", ".join(fixed.JUDGE_CRITERIA)


def _prefixed(prefix: str) -> str:
    return ", ".join(f"round({prefix}_{k}, 6) AS {k}" for k in fixed.JUDGE_CRITERIA)


def _assessed_rows(method: str) -> str:
    return with_views(
        f"""SELECT query_id, hits, round(raw_score, 6) AS raw_score, round(severity, 6) AS severity,
                   round(severity, 2) AS hate_score, mitigation_level FROM {method}_assessed""",
        f"{method}_assessed",
    )


EDGE_QUERIES = {
    "edges_paragraph_topic": with_views("SELECT id, topic FROM paragraphs WHERE topic <> ''", "paragraphs"),
    "edges_contains": with_views(
        "SELECT paragraph_id, s.id AS sentence_id FROM sentences s JOIN paragraphs p ON p.id = paragraph_id",
        "sentences", "paragraphs"),
    "edges_counter_topic": with_views(
        "SELECT id, topic FROM counters JOIN topics ON name = topic", "counters", "topics"),
    "edges_countered_with": with_views(
        "SELECT counters_id AS paragraph_id, c.id AS counter_id FROM counters c JOIN paragraphs p ON p.id = counters_id",
        "counters", "paragraphs"),
}

KB_STATS = with_views(
    """SELECT (SELECT count(*) FROM topics) AS topic_count, (SELECT count(*) FROM paragraphs) AS hate_para_count,
              (SELECT count(*) FROM sentences) AS content_count, (SELECT count(*) FROM counters) AS counter_count""",
    "topics", "paragraphs", "sentences", "counters")

NODE_COUNTS = with_views(
    """SELECT 'hate_paragraphs' AS node_table, count(*) AS rows FROM resolved
       UNION ALL SELECT 'hate_sentences', count(*) FROM node_sentences
       UNION ALL SELECT 'counter_paragraphs', count(*) FROM resolved""",
    "resolved", "node_sentences")

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_topics": "SELECT source AS topic, text AS position FROM documents",
    "distinct_topics": "SELECT DISTINCT source AS topic FROM documents",
    "scan_debates": with_views(
        """SELECT conv_id * 1000000 AS debate_id, part, any_value(topic) AS topic,
                  any_value(position) AS position,
                  CASE WHEN conv_id % 3 = 0 THEN arg_min(content, turn) FILTER (role = 'proponent') END AS proponent,
                  CASE WHEN conv_id % 3 = 1 THEN count(*) ELSE 0 END AS full_debate_messages,
                  CASE WHEN conv_id % 3 = 2 THEN count(*) ELSE 0 END AS history_messages
           FROM parted LEFT JOIN doc_topics ON conv_id = doc_id GROUP BY conv_id, part""",
        "parted", "doc_topics"),
    "scan_evaluated_pairs": with_views(
        """SELECT pair_id, topic, proponent, kind <> 1 AS evaluated,
                  round(CASE WHEN kind NOT IN (0, 1) THEN harmful_subtotal END, 6) AS harmful_subtotal,
                  round(CASE WHEN kind = 0 THEN harmfulness END, 6) AS specificity,
                  round(CASE WHEN kind <> 1 THEN counter_subtotal END, 6) AS counter_subtotal FROM evaluated""",
        "evaluated"),
    "load_typed_csv": with_views(
        """SELECT id, content, topic, source_debate, representativeness, coherence, harmfulness,
                  CASE WHEN id % 50 <> 0 THEN quality_score END AS quality_score FROM paragraphs""",
        "paragraphs"),
    "load_lenient_counters": with_views(
        """SELECT id, content, NULL::VARCHAR AS topic, counters_id, NULL::DOUBLE AS directness,
                  NULL::DOUBLE AS evidence_quality, NULL::DOUBLE AS persuasiveness, NULL::DOUBLE AS quality_score,
                  NULL::VARCHAR AS assessment FROM counters""",
        "counters"),
    "scan_jsonl_tolerant": with_views(
        """SELECT line, CASE WHEN outcome = 'accepted' THEN topic END AS topic,
                  CASE WHEN outcome = 'accepted' THEN content END AS content, outcome
           FROM example_lines WHERE outcome IN ('accepted', 'rejected')""",
        "example_lines"),
    "scan_benchmark": with_views(
        "SELECT proponent AS hate_speech, opponent AS counter_narrative, topic AS target FROM pairs", "pairs"),
    "write_node_tables": NODE_COUNTS,
    "write_json_results": with_views(
        f"SELECT system, {r6([f'avg_{m}' for m in METRICS])} FROM judge_means", "judge_means"),
    "append_jsonl": with_views(
        """SELECT topic, 'synthetic' AS source, 'social_media_comment' AS content_type, 2 * count(*) AS rows,
                  count(DISTINCT record) AS contents FROM records GROUP BY topic""",
        "records"),
    "export_metrics_csv": with_views(_wide(), "pairs", "gold_judged", "toxicity"),
    "stamp_run_metadata": with_views(
        f"""SELECT count(*) AS total_pairs, '{fixed.RESULTS_VERSION}' AS run_version, 'semantic' AS search_method,
                  true AS stamped FROM scored""",
        "scored"),
    # transcripts
    "extract_pairs": with_views("SELECT conv_id, turn, proponent, opponent FROM walked", "walked"),
    "pair_source_precedence": with_views(
        """SELECT conv_id * 1000000 AS debate_id, CASE conv_id % 3 WHEN 1 THEN 'full_debate' ELSE 'history' END AS source,
                  proponent, opponent FROM walked WHERE conv_id % 3 <> 0
           UNION ALL
           SELECT * FROM (SELECT conv_id * 1000000 AS debate_id, 'content' AS source,
                  arg_min(content, turn) FILTER (role = 'proponent') AS proponent,
                  arg_min(content, turn) FILTER (role = 'opponent') AS opponent
           FROM messages WHERE conv_id % 3 = 0 GROUP BY ALL) WHERE proponent IS NOT NULL AND opponent IS NOT NULL""",
        "walked", "messages"),
    "next_turn_state": with_views(
        f"""SELECT *, CASE turn_number {FOCUS} ELSE {text(fixed.TURN_FOCUS_BEYOND)} END AS turn_focus
            FROM (SELECT doc_id AS conv_id, coalesce(n, 0) AS messages,
                         CASE WHEN last_role = 'proponent' THEN 'opponent' ELSE 'proponent' END AS next_speaker,
                         least(coalesce(n, 0) // 2 + 1, {fixed.MAX_TURNS}) AS turn_number
                  FROM documents LEFT JOIN (SELECT conv_id, count(*) AS n, arg_max(role, turn) AS last_role
                                            FROM messages GROUP BY conv_id) ON conv_id = doc_id)""",
        "messages"),
    "live_transcripts": with_views(
        f"""SELECT 'pair' AS kind, conv_id, turn, proponent, opponent, NULL::BIGINT AS messages, NULL AS next_speaker,
                   NULL::BIGINT AS turn_number FROM walked
            UNION ALL
            SELECT 'state', conv_id, NULL, NULL, NULL, count(*),
                   CASE WHEN arg_max(role, turn) = 'proponent' THEN 'opponent' ELSE 'proponent' END,
                   least(count(*) // 2 + 1, {fixed.MAX_TURNS}) FROM messages GROUP BY conv_id""",
        "walked", "messages"),
    "render_transcript": with_views(
        "SELECT conv_id, part, string_agg(line, chr(10) ORDER BY turn) AS transcript FROM parted GROUP BY conv_id, part",
        "parted"),
    "assign_batches": with_views(
        f"""SELECT pair_id, position, (position - 1) // {fixed.BATCH_SIZE} AS batch
            FROM (SELECT pair_id, row_number() OVER (ORDER BY pair_id) AS position FROM pairs)""",
        "pairs"),
    "flag_corrupted": with_views("SELECT pair_id, corrupted, issue_message FROM flagged", "flagged"),
    "default_scores_corrupted": with_views(
        f"SELECT pair_id, corrupted, {r6(PAIR_SCORES)}, assessment FROM scored", "scored"),
    "resume_pending": with_views(
        """SELECT pair_id, topic, position, proponent FROM pairs p WHERE NOT EXISTS (
             SELECT 1 FROM pairs d WHERE d.conv_id IN (SELECT doc_id FROM labels) AND d.topic IS NOT DISTINCT FROM p.topic
             AND d.position IS NOT DISTINCT FROM p.position AND d.proponent IS NOT DISTINCT FROM p.proponent)""",
        "pairs"),
    "judge_request_table": with_views(
        f"""SELECT pair_id, {text(transcripts.PAIR_REQUEST_HEAD)} || chr(10) || 'Topic: ' || topic || chr(10) ||
                   'Position: ' || position || chr(10) || 'proponent: ' || proponent || chr(10) || 'opponent: ' ||
                   opponent || {text(transcripts.PAIR_REQUEST_TAIL)} AS prompt FROM pairs""",
        "pairs"),
    "criteria_request_table": with_views(
        f"""SELECT pair_id, {text(requests.CRITERIA_HEAD)} || chr(10) || 'message: ' || proponent || chr(10) || 'reply: ' ||
                   opponent || {text(requests.CRITERIA_TAIL)} AS prompt FROM pairs""",
        "pairs"),
    "request_ledger": with_views(
        f"""SELECT * FROM (WITH wanted AS (
                SELECT 'pair' AS kind, {text(transcripts.PAIR_REQUEST_HEAD)} || chr(10) || 'Topic: ' || topic || chr(10) ||
                       'Position: ' || position || chr(10) || 'proponent: ' || proponent || chr(10) || 'opponent: ' ||
                       opponent || {text(transcripts.PAIR_REQUEST_TAIL)} AS payload FROM pairs
                UNION ALL SELECT 'criteria', {text(requests.CRITERIA_HEAD)} || chr(10) || 'message: ' || proponent || chr(10) ||
                       'reply: ' || opponent || {text(requests.CRITERIA_TAIL)} FROM pairs
                UNION ALL SELECT 'toxicity', proponent FROM pairs UNION ALL SELECT 'toxicity', opponent FROM pairs
                UNION ALL SELECT 'embedding', text FROM documents),
            keyed AS (
                SELECT kind, count(*) AS owners, sha256(kind || chr(10) || payload)[1] AS lead
                FROM wanted WHERE payload <> '' GROUP BY kind, payload)
            SELECT run, kind, count(*) AS asked, sum(owners)::BIGINT AS owners
            FROM keyed JOIN (SELECT unnest([1, 2, 3, 4]) AS run) ON
                 run = 1 OR run = 2 AND lead IN ('0', '1', '2', '3', '4') OR run = 3 AND lead = '0'
            GROUP BY run, kind)""",
        "pairs"),
    "split_marked_records": with_views("SELECT * FROM records", "records"),
    "compile_evaluated_pairs": with_views(
        f"""SELECT pair_id, topic, position, proponent, opponent, {r6(['harmful_subtotal', 'counter_subtotal'])},
                   assessment, CASE WHEN NOT corrupted THEN response END AS raw_response, corrupted, issue_message
            FROM scored""",
        "scored"),
    "evaluate_pairs": with_views(
        f"""SELECT pair_id, topic, position, corrupted, {r6(PAIR_SCORES)}, assessment, {r6(['quality'])}, high_quality
            FROM scored""",
        "scored"),
    # judge responses
    "parse_rubric_scores": with_views(
        f"SELECT pair_id, {r6([*fixed.RUBRIC_LABELS, 'harmful_subtotal'])}, score_found FROM parsed_rubric",
        "parsed_rubric"),
    "fill_subtotals": with_views(
        f"SELECT pair_id, {r6(['harmful_subtotal', 'counter_subtotal'])} FROM filled", "filled"),
    "keyword_fallback_scores": with_views(
        f"SELECT pair_id, score_found, {r6(PAIR_SCORES)} FROM responses_scored", "responses_scored"),
    "extract_assessment": with_views("SELECT pair_id, assessment FROM responses_scored", "responses_scored"),
    "parse_json_judge": with_views(
        f"""SELECT pair_id, system, {_prefixed('j')},
                   CASE WHEN list_contains(json_keys(obj), 'feedback') THEN json_extract_string(obj, '$.feedback')
                        ELSE {text(fixed.FEEDBACK_MISSING_IN_JSON)} END AS feedback
            FROM judge_parsed WHERE json_ok""",
        "judge_parsed"),
    "parse_label_judge": with_views(
        f"SELECT pair_id, system, {_prefixed('b')} FROM judge_parsed WHERE label_ok", "judge_parsed"),
    "parse_first_five_numbers": with_views(
        f"SELECT pair_id, system, {_prefixed('n')} FROM judge_parsed WHERE number_ok", "judge_parsed"),
    "judge_defaults": with_views(
        f"""SELECT * REPLACE ({r6(METRICS)}) FROM judged WHERE parse_method IN ('default', 'failed')""", "judged"),
    "extract_feedback": with_views(
        f"""SELECT pair_id, system, CASE WHEN bare = '' THEN {text(fixed.FEEDBACK_MISSING_IN_TEXT)}
                   ELSE regexp_replace(bare, '^\\s+|\\s+$', '', 'g') END AS feedback FROM judge_parsed""",
        "judge_parsed"),
    "parse_judge": with_views(f"SELECT * REPLACE ({r6(METRICS)}) FROM judged", "judged"),
    # node tables
    "split_sentences": f"""
        SELECT id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS position
        FROM (SELECT doc_id AS id, {sentence_list('text')} AS s FROM documents)""",
    "extract_turn_number": with_views(
        r"""SELECT conv_id, turn,
                   coalesce(TRY_CAST(nullif(regexp_extract(
                       CASE WHEN turn % 2 = 0 THEN 'Turn ' || turn || ': ' || content ELSE content END,
                       'Turn (\d+)', 1), '') AS BIGINT), 1) AS turn_number FROM messages""",
        "messages"),
    "resolve_scores": with_views(f"SELECT pair_id, {r6(PAIR_SCORES)}, assessment FROM resolved", "resolved"),
    "build_paragraphs": with_views(
        f"""SELECT id, proponent AS content, topic, id AS source_debate,
                   {r6(['representativeness', 'coherence', 'harmfulness'])}, round(harmful_subtotal, 6) AS quality_score
            FROM resolved""",
        "resolved"),
    "build_sentences": with_views(
        """SELECT id, content, paragraph_id, len(embedding) AS dimension
           FROM node_sentences LEFT JOIN embeddings ON vec_id = id""",
        "node_sentences"),
    "build_counters": with_views(
        f"""SELECT id, opponent AS content, topic, id AS counters_id,
                   {r6(['directness', 'evidence_quality', 'persuasiveness'])},
                   round(counter_subtotal, 6) AS quality_score, assessment FROM resolved""",
        "resolved"),
    "assign_ids": with_views("SELECT pair_id, row_number() OVER (ORDER BY pair_id) AS id FROM pairs", "pairs"),
    "node_counts": NODE_COUNTS,
    "pairs_to_nodes": with_views(
        """SELECT 'paragraph' AS node, id, proponent AS content, id AS parent_id,
                  round(harmful_subtotal, 6) AS quality_score FROM resolved
           UNION ALL SELECT 'sentence', id, content, paragraph_id, NULL FROM node_sentences
           UNION ALL SELECT 'counter', id, opponent, id, round(counter_subtotal, 6) FROM resolved""",
        "resolved", "node_sentences"),
    # knowledge base
    "build_topics": with_views(
        "SELECT name FROM topics UNION SELECT lang FROM documents WHERE lang <> ''", "topics"),
    **EDGE_QUERIES,
    "kb_stats": KB_STATS,
    "rebuild_kb": KB_STATS,
    "grow_kb": with_views(
        """SELECT version, name, rows FROM (
               SELECT 1 AS version, 'topics' AS name, (SELECT count(*) FROM topics) AS rows
               UNION ALL SELECT 1, 'paragraphs', (SELECT count(*) FROM paragraphs)
               UNION ALL SELECT 1, 'paragraph_topic', (SELECT count(*) FROM paragraphs WHERE topic <> '')
               UNION ALL SELECT 1, 'contains', (SELECT count(*) FROM sentences s JOIN paragraphs p ON p.id = paragraph_id)
               UNION ALL SELECT 1, 'countered_with', (SELECT count(*) FROM counters c JOIN paragraphs p ON p.id = counters_id)
               UNION ALL SELECT v, 'sentences', (SELECT count(*) FROM sentences) FROM (SELECT unnest([1, 2, 3]) AS v)
               UNION ALL SELECT v, 'counters', (SELECT count(*) FROM counters) FROM (SELECT unnest([1, 2, 3]) AS v)
               UNION ALL SELECT 1, 'counter_topic', (SELECT count(*) FROM counters WHERE topic IN (SELECT name FROM topics))
               UNION ALL SELECT v, 'counter_topic', (SELECT count(*) FROM counters WHERE topic IN
                         (SELECT name FROM topics UNION SELECT topic FROM examples)) FROM (SELECT unnest([2, 3]) AS v)
               UNION ALL SELECT v, 'topics', (SELECT count(*) FROM (SELECT name FROM topics UNION SELECT topic FROM examples))
                         FROM (SELECT unnest([2, 3]) AS v)
               UNION ALL SELECT 2, 'paragraphs', (SELECT count(*) FROM paragraphs) + (SELECT count(content) FROM examples)
               UNION ALL SELECT 2, 'paragraph_topic', (SELECT count(*) FROM paragraphs WHERE topic <> '') + (SELECT count(content) FROM examples)
               UNION ALL SELECT 2, 'contains', (SELECT count(*) FROM sentences s JOIN paragraphs p ON p.id = paragraph_id)
               UNION ALL SELECT 2, 'countered_with', (SELECT count(*) FROM counters c JOIN paragraphs p ON p.id = counters_id)
               UNION ALL SELECT 3, 'paragraphs', (SELECT count(*) FROM paragraphs WHERE layer = 1)
               UNION ALL SELECT 3, 'paragraph_topic', (SELECT count(*) FROM paragraphs WHERE layer = 1 AND topic <> '')
               UNION ALL SELECT 3, 'contains', (SELECT count(*) FROM sentences s JOIN paragraphs p ON p.id = paragraph_id WHERE layer = 1)
               UNION ALL SELECT 3, 'countered_with', (SELECT count(*) FROM counters c JOIN paragraphs p ON p.id = counters_id WHERE layer = 1))""",
        "topics", "paragraphs", "sentences", "counters", "examples"),
    "constraint_violations": """
        SELECT 'HateParagraph' AS label, key::VARCHAR AS key,
               CASE WHEN key IS NULL THEN 'exists' ELSE 'unique' END AS violation, count(*) AS rows
        FROM (SELECT CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 50 = 1 THEN doc_id + 1 ELSE doc_id END AS key
              FROM documents)
        GROUP BY key HAVING key IS NULL OR count(*) > 1""",
    "unlinked_nodes": with_views(
        """SELECT 'counters_with_id' AS measure, count(*) AS rows FROM counters WHERE counters_id IS NOT NULL
           UNION ALL SELECT 'sentences_unlinked', count(*) FROM sentences
                     WHERE paragraph_id NOT IN (SELECT id FROM paragraphs)
           UNION ALL SELECT 'counters_unlinked', count(*) FROM counters
                     WHERE counters_id NOT IN (SELECT id FROM paragraphs)""",
        "counters", "sentences", "paragraphs"),
    "next_id_base": "SELECT coalesce(max(doc_id), 0) AS max_id FROM documents",
    "append_synthetic": with_views(
        f"""SELECT id, content, topic, source_debate, representativeness, coherence, harmfulness, quality_score,
                   is_synthetic, NULL::VARCHAR AS content_type FROM paragraphs
            UNION ALL
            SELECT (SELECT max(id) FROM paragraphs) + row_number() OVER (ORDER BY first_line, line), content, topic, 0,
                   {SYNTHETIC}, true, '{fixed.SYNTHETIC_CONTENT_TYPE}'
            FROM (SELECT *, min(line) OVER (PARTITION BY topic) AS first_line FROM examples)
            WHERE content IS NOT NULL""",
        "paragraphs", "examples"),
    "merge_topics": with_views(
        """SELECT DISTINCT source AS name, false AS created FROM documents
           UNION SELECT topic, true FROM (SELECT CASE WHEN line % 3 = 0 THEN topic || ' anew' ELSE topic END AS topic FROM examples)
                 WHERE topic NOT IN (SELECT source FROM documents)""",
        "examples"),
    "import_stats": with_views(
        """SELECT count(DISTINCT topic) AS topics_processed, count(content) AS examples_imported,
                  count(*) - count(content) AS errors FROM examples""",
        "examples"),
    "remove_synthetic": with_views(
        """SELECT 'paragraphs' AS measure, count(*) AS rows FROM paragraphs WHERE layer = 1
           UNION ALL SELECT 'edges', count(*) FROM sentences s JOIN paragraphs p ON p.id = paragraph_id WHERE layer = 1
           UNION ALL SELECT 'removed', count(*) FROM paragraphs WHERE layer = 2""",
        "paragraphs", "sentences"),
    **{
        f"decode_embedding_{form}": with_views(
            f"""SELECT id, format, CASE WHEN format IN ('array', '{form}') THEN len(embedding) END AS dimension,
                       CASE WHEN format IN ('array', '{form}') THEN round(list_sum(embedding::DOUBLE[]), 6) END AS total,
                       CASE WHEN format = '{form}' THEN NULL WHEN format = 'unknown' THEN 1
                            WHEN format IN ('json', 'csv') THEN len(embedding) END AS untouched_parts
                FROM stored""",
            "stored")
        for form in ("json", "csv")
    },
    "embedding_format_profile": with_views("SELECT format, count(*) AS rows FROM stored GROUP BY format", "stored"),
    "embedding_dim_check": with_views(
        f"""SELECT id, len(embedding) AS dimension FROM stored
            WHERE format IN ('array', 'json', 'csv') AND len(embedding) <> {fixed.VECTOR_DIMENSION}""",
        "stored"),
    "page_by_id": with_views("SELECT id, paragraph_id FROM sentences ORDER BY id LIMIT 100 OFFSET 100", "sentences"),
    "kb_ready": "SELECT count(*) > 0 AS ready FROM documents",
    "topic_overview": with_views(
        """SELECT p.topic, count(DISTINCT p.id) AS hate_paragraphs, count(DISTINCT s.id) AS hate_content_items,
                  count(DISTINCT c.id) AS counter_paragraphs
           FROM paragraphs p LEFT JOIN sentences s ON s.paragraph_id = p.id LEFT JOIN counters c ON c.counters_id = p.id
           WHERE p.topic <> '' GROUP BY p.topic ORDER BY 2 DESC, 1 LIMIT 5""",
        "paragraphs", "sentences", "counters"),
    "edge_type_counts": with_views(
        """SELECT 'HateParagraph' AS source_label, 'TALKS_ABOUT' AS relationship_type, 'Topic' AS target_label,
                  count(*) AS edges FROM paragraphs WHERE topic <> ''
           UNION ALL SELECT 'CounterParagraph', 'TALKS_ABOUT', 'Topic', count(*) FROM counters JOIN topics ON name = topic
           UNION ALL SELECT 'HateParagraph', 'CONTAINS', 'HateContent', count(*)
                     FROM sentences s JOIN paragraphs p ON p.id = paragraph_id
           UNION ALL SELECT 'HateParagraph', 'COUNTERED_WITH', 'CounterParagraph', count(*)
                     FROM counters c JOIN paragraphs p ON p.id = counters_id""",
        "paragraphs", "counters", "topics", "sentences"),
    "sample_nodes": with_views(
        f"""SELECT 'Topic' AS label, name AS key, name AS preview FROM (SELECT name FROM topics ORDER BY name LIMIT 5)
            UNION ALL SELECT 'HateParagraph', id::VARCHAR, content[1:50]
                      FROM (SELECT id, content FROM paragraphs ORDER BY id LIMIT 2)
            UNION ALL SELECT 'HateContent', id::VARCHAR, content[1:50]
                      FROM (SELECT doc_id * 1000000000 + generate_subscripts(s, 1) - 1 AS id, unnest(s) AS content
                            FROM (SELECT doc_id, {sentence_list('text')} AS s FROM documents) ORDER BY 1 LIMIT 2)
            UNION ALL SELECT 'CounterParagraph', id::VARCHAR, content[1:50]
                      FROM (SELECT id, content FROM counters ORDER BY id LIMIT 2)""",
        "topics", "paragraphs", "counters"),
    # retrieval
    "keywords_v1": with_views(
        "SELECT query_id, unnest(keywords) AS keyword, generate_subscripts(keywords, 1) - 1 AS position FROM query_words_v1",
        "query_words_v1"),
    "keywords_v2": with_views(
        "SELECT query_id, unnest(keywords) AS keyword, generate_subscripts(keywords, 1) - 1 AS position FROM query_words_v2",
        "query_words_v2"),
    "query_phrases": with_views(
        "SELECT query_id, unnest(phrases) AS phrase, generate_subscripts(phrases, 1) - 1 AS position FROM query_words_v2",
        "query_words_v2"),
    "query_terms": with_views("SELECT * FROM terms_v2", "terms_v2"),
    "lexical_match": with_views("SELECT query_id, id FROM matches_v2", "matches_v2"),
    "lexical_score_v1": with_views("SELECT query_id, id, score FROM matches_v1", "matches_v1"),
    "lexical_score_v2": with_views("SELECT query_id, id, score FROM matches_v2", "matches_v2"),
    "search_lexical_single": with_views(
        _results("single_hits", "score AS relevance_score", layered=False), *_details("single_hits")),
    "search_lexical_two_layer": with_views(
        _results("two_layer_hits", "score AS relevance_score"), *_details("two_layer_hits")),
    "search_lexical_v2": with_views(
        _results("phrase_hits", "score AS relevance_score"), *_details("phrase_hits")),
    "expand_topic_counter": with_views(
        """SELECT id, nullif(topic, '') AS topic, counter_id, counter_content, directness, evidence_quality, persuasiveness
           FROM paragraphs LEFT JOIN first_counter USING (id)""",
        "paragraphs", "first_counter"),
    "dedupe_by_id": with_views(
        f"""SELECT query_id, id, layer, score, rank
            FROM (SELECT query_id, id, layer, score, rank FROM phrase_hits
                  UNION ALL SELECT query_id, id, layer, score, rank + {2 * K} FROM two_layer_hits)
            QUALIFY row_number() OVER (PARTITION BY query_id, id ORDER BY rank) = 1""",
        "phrase_hits", "two_layer_hits"),
    "cosine_similarity": """
        SELECT a.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "knn_sentences": with_views(
        "SELECT query_id, sentence_id, round(similarity, 6) AS similarity, place FROM nearest", "nearest"),
    "similarity_threshold": with_views(
        "SELECT query_id, sentence_id, round(similarity, 6) AS similarity, place FROM near_enough", "near_enough"),
    "rollup_to_paragraph": with_views("SELECT * REPLACE (round(similarity_score, 6) AS similarity_score) FROM rolled", "rolled"),
    "search_semantic": with_views(
        _results("semantic_hits", "round(similarity_score, 6) AS similarity_score"), *_details("semantic_hits")),
    "search_semantic_by_quality": with_views(
        _results("quality_hits", "round(similarity_score, 6) AS similarity_score"), *_details("quality_hits")),
    "search_topic_fallback": with_views(
        f"SELECT * FROM ({_results('topic_hits', '1e0 AS similarity_score')}) WHERE rank <= {2 * K}",
        "topic_hits", "paragraphs", "first_counter"),
    "search_hybrid": with_views(
        _results("hybrid_hits", "round(similarity_score, 6) AS similarity_score"), *_details("hybrid_hits")),
    "search_with_fallback": with_views(
        f"""SELECT * FROM ({_results('semantic_hits', 'round(similarity_score, 6) AS similarity_score')}) WHERE query_id % 4 >= 2
            UNION ALL
            SELECT * FROM ({_results('topic_hits', '1e0 AS similarity_score')}) WHERE rank <= {2 * K} AND query_id % 4 < 2""",
        "semantic_hits", "topic_hits", "paragraphs", "first_counter"),
    "rejected_vectors": with_views(
        """SELECT id, CASE WHEN format IN ('unknown', 'missing') THEN 'missing' ELSE 'dimension' END AS fault
           FROM stored WHERE format IN ('unknown', 'missing') OR id % 10 = 1""",
        "stored"),
    "index_recall": with_views(
        """SELECT (SELECT count(DISTINCT query_id) FROM nearest) AS queries, (SELECT count(*) FROM nearest) AS wanted,
                  (SELECT count(*) FROM sentences) AS indexed, 0 AS rejected, true AS recall_reached""",
        "nearest", "sentences"),
    "fill_counter_by_topic": with_views(
        """SELECT query_id, rank, layer, id, topic, counter_id, counter_content, directness, evidence_quality, persuasiveness
           FROM hybrid_filled""",
        "hybrid_filled"),
    "counter_context": with_views(
        "SELECT * REPLACE (round(similarity_score, 6) AS similarity_score) FROM hybrid_context", "hybrid_context"),
    # assessment
    "raw_score": with_views(
        f"SELECT query_id, rank, hate_paragraph_id, round({raw()}, 6) AS raw_score FROM semantic_context", "semantic_context"),
    "top3_mean": with_views(
        "SELECT query_id, round(raw_score, 6) AS raw_score, hits FROM semantic_assessed WHERE hits > 0", "semantic_assessed"),
    "calibrate": with_views(
        f"""SELECT query_id, rank, round({calibrated(raw())}, 6) AS calibrated_score,
                   round({severity(raw())}, 6) AS severity FROM semantic_context""",
        "semantic_context"),
    "assessment_details": with_views(
        f"""SELECT query_id, place, hate_paragraph_id AS id, counter_id, round(similarity_score, 2) AS similarity,
                   round(quality_score, 2) AS harmfulness, round(raw, 6) AS raw_weighted_score,
                   round({calibrated('raw')}, 6) AS calibrated_score, {fixed.OBSERVED_RANGE[0]}e0 AS observed_min,
                   {fixed.OBSERVED_RANGE[1]}e0 AS observed_max, 5.5e0 AS theoretical_min, 10e0 AS theoretical_max,
                   hits AS items, round(raw_score, 6) AS query_raw_score, round(severity, 6) AS query_calibrated_score,
                   {fixed.SIMILARITY_WEIGHT}e0 AS similarity_weight, {fixed.HARMFULNESS_WEIGHT}e0 AS harmfulness_weight
            FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, rank) AS place
                  FROM (SELECT *, {raw()} AS raw FROM semantic_context))
            JOIN semantic_assessed USING (query_id) WHERE place <= 3""",
        "semantic_context", "semantic_assessed"),
    "mitigation_level": with_views("SELECT query_id, mitigation_level FROM hybrid_assessed", "hybrid_assessed"),
    "mitigation_summary": with_views(
        f"""SELECT (SELECT count(*) FROM semantic_assessed) AS total_queries, level AS mitigation_level,
                   count(a.query_id) AS queries,
                   round(count(a.query_id) / (SELECT count(*) FROM semantic_assessed) * 100e0, 2) AS percentage
            FROM (SELECT unnest([{words(fixed.LEVELS)}]) AS level)
            LEFT JOIN semantic_assessed a ON mitigation_level = level GROUP BY level""",
        "semantic_assessed"),
    "mitigation_running_counts": with_views(
        """SELECT mitigation_level, count(*) AS queries FROM events JOIN semantic_assessed ON query_id = user_id
           GROUP BY mitigation_level""",
        "semantic_assessed"),
    "closed_daily_counts": with_views(
        """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, mitigation_level, count(*) AS queries
           FROM events JOIN semantic_assessed ON query_id = user_id
           WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
           GROUP BY ALL""",
        "semantic_assessed"),
    "assess_queries": _assessed_rows("semantic"),
    "assess_queries_syntax": _assessed_rows("syntax"),
    "assess_queries_hybrid": _assessed_rows("hybrid"),
    "context_mild": with_views(
        """SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place, counter_id,
                                 content FROM semantic_context WHERE content <> '') WHERE place <= 2""",
        "semantic_context"),
    "context_strong": with_views(
        f"""SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY quality DESC, rank) AS place,
                                  counter_id, quality, content FROM {STRONG}) WHERE place <= 3""",
        "semantic_context"),
    "response_request_table": with_views(_request(), "semantic_assessed", "semantic_context", "text_queries"),
    # evaluation
    "judge_averages": with_views(
        f"SELECT system, {r6([f'avg_{m}' for m in METRICS])} FROM judge_means", "judge_means"),
    "toxicity_averages": with_views(
        f"SELECT system, side, attribute, {r6(['avg_all', 'avg_valid'])} FROM toxicity_means", "toxicity_means"),
    "toxicity_reduction": with_views(
        f"""SELECT system, attribute, {r6(['avg_reduction', 'avg_reduction_percent', 'samples_with_reduction'])}
            FROM toxicity_drops""",
        "toxicity_drops"),
    "example_metrics_wide": with_views(_wide(), "pairs", "gold_judged", "toxicity"),
    "compare_judge": with_views(
        f"""SELECT {_title('replace(metric[5:], chr(95), chr(32))', ' ')} AS metric, round(generated, 6) AS generated,
                   round(gold, 6) AS gold, round(difference, 6) AS difference, {_signed(2)} AS difference_text
            FROM (SELECT *, generated - gold AS difference
                  FROM (SELECT metric, max(value) FILTER (system = 'generated') AS generated,
                               max(value) FILTER (system = 'gold') AS gold
                        FROM ({_judge_long()}) GROUP BY metric))""",
        "judge_means"),
    "compare_toxicity": with_views(
        f"""SELECT {_title('attribute', '_')} AS attribute, round(generated, 6) AS generated, round(gold, 6) AS gold,
                   round(difference, 6) AS difference, {_signed(4)} AS difference_text
            FROM (SELECT *, generated - gold AS difference
                  FROM (SELECT attribute, max(avg_all) FILTER (system = 'generated') AS generated,
                               max(avg_all) FILTER (system = 'gold') AS gold
                        FROM toxicity_means WHERE side = 'counter' GROUP BY attribute))""",
        "toxicity_means"),
    "sample_n": with_views(
        f"SELECT pair_id, topic AS target FROM pairs ORDER BY {_draw('pair_id')}, pair_id LIMIT 100", "pairs"),
    "stratified_sample": f"""
        SELECT doc_id, lang, source
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_draw('doc_id')}, doc_id) AS place,
                     count(*) OVER (PARTITION BY lang) AS size, count(*) OVER () AS total FROM documents)
        WHERE place <= least({fixed.STRATIFIED_SIZE} * size // total, size)""",
    "sample_examples": with_views(
        f"""SELECT * FROM ({_wide()}) ORDER BY {_draw('example_id')}, example_id LIMIT {fixed.REPORT_EXAMPLES}""",
        "pairs", "gold_judged", "toxicity"),
    "pair_quality": with_views(
        """SELECT pair_id, round(CASE WHEN pair_id % 4 <> 3 THEN counter_subtotal
                                      ELSE (directness + evidence_quality + persuasiveness) / 3e0 END, 6) AS quality
           FROM scored""",
        "scored"),
    "rank_pairs": with_views(
        """SELECT pair_id, round(quality, 6) AS quality, row_number() OVER (ORDER BY quality DESC, pair_id) AS place
           FROM scored""",
        "scored"),
    "filter_high_quality": with_views(
        f"SELECT pair_id, round(quality, 6) AS quality FROM scored WHERE quality >= {fixed.QUALITY_THRESHOLD}", "scored"),
    "quality_summary": with_views(
        """SELECT count(*) AS total_pairs,
                  round(CAST(sum(CAST(harmful_subtotal AS DECIMAL(28,12))) AS DOUBLE) / count(harmful_subtotal), 6)
                      AS average_harmful_content_score,
                  round(CAST(sum(CAST(counter_subtotal AS DECIMAL(28,12))) AS DOUBLE) / count(counter_subtotal), 6)
                      AS average_counterspeech_score,
                  count(*) FILTER (counter_subtotal >= 8) AS excellent,
                  count(*) FILTER (counter_subtotal >= 7 AND counter_subtotal < 8) AS good,
                  count(*) FILTER (counter_subtotal >= 5 AND counter_subtotal < 7) AS average,
                  count(*) FILTER (counter_subtotal < 5) AS poor,
                  count(*) FILTER (counter_subtotal >= 7) AS high_quality_pairs,
                  round(count(*) FILTER (counter_subtotal >= 7) / count(*), 6) AS high_quality_share
           FROM scored""",
        "scored"),
    "run_summary": with_views(
        f"""SELECT metric, round(value, 6) AS value FROM ({_judge_long()}) WHERE system = 'gold'
            UNION ALL SELECT 'avg_counter_toxicity', round(avg_all, 6) FROM toxicity_means
                      WHERE system = 'gold' AND side = 'counter' AND attribute = 'toxicity'
            UNION ALL SELECT 'avg_toxicity_reduction_percent', round(avg_reduction_percent, 6) FROM toxicity_drops
                      WHERE system = 'gold' AND attribute = 'toxicity'""",
        "judge_means", "toxicity_means", "toxicity_drops"),
    "report_tables": with_views(
        f"""SELECT section, metric, round(value, 6) AS value, NULL::VARCHAR AS text FROM ({_report("system = 'gold'")})
            UNION ALL SELECT 'config', 'dataset', NULL, 'benchmark'
            UNION ALL SELECT 'config', 'search_method', NULL, 'semantic'
            UNION ALL SELECT 'config', 'sample_size', count(*)::DOUBLE, NULL FROM pairs""",
        "judge_means", "toxicity_means", "toxicity_drops", "pairs"),
    "evaluate_system": with_views(
        " UNION ALL ".join(
            f"SELECT '{s}' AS system, section, metric, round(value, 6) AS value FROM ({_report(_only(s))})"
            for s in ("gold", "generated")
        ),
        "judge_means", "toxicity_means", "toxicity_drops"),
}
