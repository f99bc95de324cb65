"""SQL twins of the derived inputs: name -> (views it reads, SELECT text)."""

from __future__ import annotations

from rejoinder.functions import fixed_values as fixed
from rejoinder.operators import transcripts


def text(value: str) -> str:
    """A SQL string literal."""
    parts = ["'" + part.replace("'", "''") + "'" for part in value.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def words(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


TOPIC = "CASE WHEN doc_id % 17 = 0 THEN '' ELSE source END"
STOPS = words(fixed.STOP_WORDS)


def tenths(n: str) -> str:
    return f"(({n}) // 10)::VARCHAR || '.' || (({n}) % 10)::VARCHAR"


def joined(parts: list) -> str:
    """Concatenation of literals and (sql,) expressions."""
    return " || ".join(f"({p[0]})" if isinstance(p, tuple) else text(p) for p in parts)


def choose(layout: str, layouts: list[list]) -> str:
    cases = " ".join(f"WHEN {n} THEN {joined(parts)}" for n, parts in enumerate(layouts))
    return f"CASE {layout} {cases} END"


def _rubric() -> str:
    def s(k):
        return (tenths(f"40 + (pair_id + {k}) % 60"),)

    layouts = [
        ["HARMFUL CONTENT\nRepresentativeness: ", s(1), "/10\nCoherence: ", s(2), "/10\nHarmfulness: ", s(3),
         "/10\nSubtotal: ", s(7), "\nCOUNTERSPEECH\nDirectness: ", s(4), "\nEvidence Quality: ", s(5),
         "/10\nPersuasiveness: ", s(6), "\nSubtotal: ", s(8), "\nOVERALL ASSESSMENT:  Reply ",
         ("pair_id::VARCHAR",), " holds up. \nEnd"],
        ["1. **Representativeness**: ", s(1), "\n2. **Coherence** ", s(2), "\n3. harmfulness ", s(3),
         "\n**Directness**: ", s(4), "\n**Evidence Quality**: ", s(5), "\n**Persuasiveness:** ", s(6),
         "\nCounterspeech subtotal: ", s(8)],
        ["Representativeness: [", s(1), "/10]\nDirectness: [", s(4), "/10]\nOVERALL ASSESSMENT: plain"],
        ["Assessment in words: an excellent reply"],
        ["Assessment in words: a good reply"],
        [""],
    ]
    return f"SELECT pair_id, {choose('conv_id % 6', layouts)} AS response FROM pairs"


def _judge() -> str:
    def v(k):
        return (tenths(f"10 + (pair_id + {13 * k} + shift) % 90"),)

    pair = ("pair_id::VARCHAR",)
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
    return (
        f"SELECT pair_id, system, {choose('(conv_id + shift) % 6', layouts)} AS response, "
        "CASE WHEN (conv_id + shift) % 6 = 5 THEN 'timeout' END AS error "
        "FROM pairs, (VALUES ('gold', 0), ('generated', 17)) AS s(system, shift)"
    )


def _toxicity() -> str:
    attributes = words(fixed.TOXICITY_ATTRIBUTES)
    return f"""
    SELECT pair_id, system, attribute, conv_id % 10 <> 9 AS valid,
           (pair_id % 101 * (7 + i) % 101) / 100e0 AS hate,
           ((pair_id % 101 * (3 + i) + 1 + shift) % 101) / 200e0 AS counter
    FROM pairs, (VALUES ('gold', 0), ('generated', 17)) AS s(system, shift),
         (SELECT i, ([{attributes}])[i + 1] AS attribute FROM range(8) r(i))"""


def _number(pattern: str, source: str = "response") -> str:
    return f"TRY_CAST(nullif(regexp_extract(coalesce({source}, ''), '{pattern}', 1), '') AS DOUBLE)"


NUM = r"(\d+(?:\.\d+)?)"


def labelled(label: str) -> str:
    return _number(rf"(?i){label}(?:\*\*)?\s*:?\s*{NUM}")


def _parsed_rubric() -> str:
    found = ", ".join(f"{labelled(label)} AS f_{key}" for key, label in fixed.RUBRIC_LABELS.items())
    zero = ", ".join(f"coalesce(f_{k}, 0e0) AS {k}" for k in [*fixed.RUBRIC_LABELS, "harmful_subtotal"])
    some = " OR ".join(f"f_{k} IS NOT NULL" for k in [*fixed.RUBRIC_LABELS, "harmful_subtotal"])
    return (
        f"SELECT pair_id, response, {zero}, ({some}) AS score_found FROM "
        f"(SELECT *, {found}, {labelled('Subtotal')} AS f_harmful_subtotal FROM rubric)"
    )


def _filled() -> str:
    line = rf"[^\n]*?Subtotal\s*:?\s*{NUM}"
    harm = rf"(?i)(?:HARMFUL CONTENT|1\.){line}"
    reply = rf"(?i)(?:COUNTERSPEECH|2\.){line}"

    def mean(a, b, c):
        return f"CASE WHEN {a} > 0 AND {b} > 0 AND {c} > 0 THEN ({a} + {b} + {c}) / 3e0 ELSE 0e0 END"

    return f"""
    SELECT * EXCLUDE (harmful_subtotal, line_h, line_c),
           coalesce(nullif(harmful_subtotal, 0), nullif(line_h, 0),
                    {mean('representativeness', 'coherence', 'harmfulness')}) AS harmful_subtotal,
           coalesce(nullif(line_c, 0), {mean('directness', 'evidence_quality', 'persuasiveness')}) AS counter_subtotal
    FROM (SELECT *, coalesce({_number(harm)}, 0e0) AS line_h, coalesce({_number(reply)}, 0e0) AS line_c
          FROM parsed_rubric)"""


PAIR_SCORES = [
    "representativeness", "coherence", "harmfulness", "harmful_subtotal",
    "directness", "evidence_quality", "persuasiveness", "counter_subtotal",
]


def _responses_scored() -> str:
    low = "lower(response)"
    tiers = " ".join(
        "WHEN " + " OR ".join(f"contains({low}, {text(w)})" for w in ws) + f" THEN {score}e0"
        for score, ws in fixed.ASSESSMENT_TIERS
    )
    tier = (
        f"CASE WHEN NOT score_found AND contains({low}, 'assessment') THEN "
        f"CASE {tiers} ELSE {fixed.ASSESSMENT_TIER_OTHER}e0 END END"
    )
    filled = ", ".join(f"coalesce(tier, {k}) AS {k}" for k in PAIR_SCORES)
    return rf"""
    SELECT pair_id, response, score_found, {filled},
           CASE WHEN contains(response, 'OVERALL ASSESSMENT:')
                THEN trim(regexp_extract(response, 'OVERALL ASSESSMENT:\s*([^\n]*)', 1), chr(32) || chr(9))
                ELSE {text(fixed.NO_ASSESSMENT)} END AS assessment
    FROM (SELECT *, {tier} AS tier FROM filled)"""


def _scored() -> str:
    fixed_scores = ", ".join(
        f"CASE WHEN corrupted THEN {v}e0 ELSE {k} END AS {k}" for k, v in fixed.CORRUPTED_SCORES.items()
    )
    return f"""
    SELECT *, counter_subtotal AS quality, counter_subtotal >= {fixed.RUN_QUALITY_THRESHOLD} AS high_quality
    FROM (SELECT f.*, response, {fixed_scores},
                 CASE WHEN corrupted THEN {text(fixed.CORRUPTED_ASSESSMENT)} ELSE assessment END AS assessment
          FROM flagged f LEFT JOIN responses_scored USING (pair_id))"""


def _flagged() -> str:
    hit = " OR ".join(f"contains(opponent, {text(m)})" for m in fixed.CORRUPTION_MARKERS)
    return (
        f"SELECT *, CASE WHEN corrupted THEN {text(fixed.CORRUPTION_MESSAGE)} END AS issue_message "
        f"FROM (SELECT *, ({hit}) AS corrupted FROM marked_pairs)"
    )


def _word_list() -> str:
    """Word tokens of ``text_queries`` as a list ``ws``: chunks between blanks, from each of which the ends are peeled."""
    marks = "".join(f"\\{c}" if c.isascii() else c for c in fixed.SEPARATE_MARKS)
    # commas and colons before a digit are hidden from the spacing by control characters
    hidden = r"regexp_replace(regexp_replace(lower(query), ',([0-9])', chr(2) || '\1', 'g'), ':([0-9])', chr(3) || '\1', 'g')"
    spaced = rf"regexp_replace({hidden}, '([.][.]+|--+|[{marks}]|[,:])', ' \1 ', 'g')"
    shown = f"replace(replace({spaced}, chr(2), ','), chr(3), ':')"
    size = "CASE " + " ".join(f"WHEN ends_with(replace(r, '’', chr(39)), {text(e)}) THEN {len(e)}" for e in fixed.SHORT_ENDINGS) + " ELSE 0 END"
    steps = [
        rf"SELECT query_id, query, string_split_regex({shown}, '\s+') AS c FROM text_queries",
        "SELECT query_id, query, unnest(c) AS w, generate_subscripts(c, 1) AS place FROM ({})",
        "SELECT *, CASE WHEN left(w, 1) IN (chr(39), '‘', '’') THEN left(w, 1) ELSE '' END AS lead FROM ({})",
        r"SELECT *, substr(w, len(lead) + 1) AS r, regexp_full_match(w, '(\p{{L}}[.])(\p{{L}}[.])+|[.]+') AS whole FROM ({})",
        "SELECT *, CASE WHEN right(r, 1) IN (chr(39), '’') THEN right(r, 1) ELSE '' END AS tail FROM ({})",
        "SELECT * REPLACE (left(r, len(r) - len(tail)) AS r) FROM ({})",
        "SELECT *, CASE WHEN ends_with(r, '.') THEN '.' ELSE '' END AS dot FROM ({})",
        "SELECT * REPLACE (left(r, len(r) - len(dot)) AS r) FROM ({})",
        f"SELECT *, {size} AS size FROM ({{}})",
        "SELECT *, right(r, size) AS ending, left(r, len(r) - size) AS stem FROM ({})",
        f"""SELECT query_id, query, place, unnest([1, 2, 3, 4, 5, 6]) AS side,
                   unnest(CASE WHEN whole THEN [w, '', '', '', '', '']
                          WHEN stem IN ({words(fixed.JOINED_WORDS)}) THEN [lead, left(stem, 3), substr(stem, 4), ending, dot, tail]
                          ELSE [lead, stem, '', ending, dot, tail] END) AS part FROM ({{}})""",
        "SELECT query_id, any_value(query) AS query, coalesce(list(part ORDER BY place, side) FILTER (part <> ''), []) AS ws FROM ({}) GROUP BY query_id",
    ]
    sql = steps[0]
    for step in steps[1:]:
        sql = step.format(sql)
    return sql


def _terms(whole: int, version: int) -> str:
    stop = f"AND NOT list_contains([{STOPS}], w)" if version == 2 else ""

    def grams(size: int, longer: int) -> str:
        piece = f"list_slice(ws, i, i + {size - 1})"
        return (
            f"[array_to_string({piece}, ' ') FOR i IN range(1, len(ws) - {size - 2}) "
            f"IF length(array_to_string({piece}, ' ')) > {longer} "
            f"AND len(list_filter({piece}, lambda w: NOT list_contains([{STOPS}], w))) > 0]"
        )

    phrases = f"list_concat({grams(2, 5)}, {grams(3, 8)})" if version == 2 else "CAST([] AS VARCHAR[])"
    listed = _word_list() if version == 2 else r"""
        SELECT query_id, query, list_filter(string_split_regex(lower(query), '\s+'), lambda w: w <> '') AS ws FROM text_queries"""
    return f"""
    SELECT query_id, ws, keywords, phrases, lower(query) AS whole, {whole} AS whole_weight
    FROM (SELECT query_id, query, ws, list_filter(ws, lambda w: length(w) > 3 {stop}) AS keywords,
                 {phrases} AS phrases
          FROM ({listed}))"""


def _weighted(source: str) -> str:
    return f"""
    SELECT query_id, term, CAST(sum(weight) AS BIGINT) AS weight, bool_or(qualifies) AS qualifies
    FROM (SELECT query_id, unnest(keywords) AS term, 1 AS weight, true AS qualifies FROM {source}
          UNION ALL SELECT query_id, unnest(phrases), 3, true FROM {source}
          UNION ALL SELECT query_id, whole, whole_weight, len(keywords) = 0 AND len(phrases) = 0 FROM {source})
    WHERE term <> '' GROUP BY ALL"""


def _matches(terms: str) -> str:
    """Each distinct term is searched once per text; the scores are joined on afterwards."""
    return f"""
    SELECT t.query_id, h.id, h.layer, CAST(sum(t.weight) AS BIGINT) AS score
    FROM (SELECT p.id, p.layer, d.term
          FROM (SELECT id, layer, lower(content) AS low FROM paragraphs) p,
               (SELECT DISTINCT term FROM {terms}) d
          WHERE contains(p.low, d.term)) h
    JOIN {terms} t ON t.term = h.term
    GROUP BY ALL HAVING bool_or(t.qualifies)"""


def _layered(matches: str) -> str:
    return f"""
    SELECT query_id, id, layer, score,
           row_number() OVER (PARTITION BY query_id ORDER BY layer, place) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id, layer ORDER BY score DESC, id) AS place FROM {matches})
    WHERE place <= {fixed.RESULTS_PER_LAYER}"""


def _semantic(key: str) -> str:
    return f"""
    SELECT query_id, id, layer, similarity_score,
           row_number() OVER (PARTITION BY query_id ORDER BY {key} DESC NULLS LAST, layer, id) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id, layer ORDER BY {key} DESC NULLS LAST, id) AS place
          FROM rolled)
    WHERE place <= {fixed.RESULTS_PER_LAYER}"""


def _context(hits: str) -> str:
    fields = ["counter_id", "counter_content", "directness", "evidence_quality", "persuasiveness"]
    fill = ", ".join(f"CASE WHEN lacking THEN f.{x} ELSE c.{x} END AS {x}" for x in fields)
    return f"""
    SELECT query_id, rank, layer, id, topic, quality_score, similarity_score, {fill}
    FROM (SELECT h.*, p.topic, p.quality_score, fc.* EXCLUDE (id),
                 h.layer = 2 AND counter_id IS NULL AND p.topic IS NOT NULL AS lacking
          FROM {hits} h
          JOIN (SELECT id, nullif(topic, '') AS topic, quality_score FROM paragraphs) p USING (id)
          LEFT JOIN first_counter fc USING (id)) c
    LEFT JOIN topic_counter f USING (topic)"""


def _ready_context(filled: str) -> str:
    return f"""
    SELECT query_id, rank, counter_id, counter_content AS content, topic, id AS hate_paragraph_id,
           coalesce(quality_score, 0e0) AS quality_score, coalesce(similarity_score, 0e0) AS similarity_score,
           coalesce(directness, 0e0) AS directness, coalesce(evidence_quality, 0e0) AS evidence_quality,
           coalesce(persuasiveness, 0e0) AS persuasiveness
    FROM {filled} WHERE counter_id IS NOT NULL"""


def raw(similarity: str = "similarity_score", quality: str = "quality_score") -> str:
    return f"(({fixed.SIMILARITY_WEIGHT}e0 * {similarity} + {fixed.HARMFULNESS_WEIGHT}e0 * ({quality} / 10e0)) * 10e0)"


def calibrated(value: str) -> str:
    low, high = fixed.OBSERVED_RANGE
    return f"(sqrt(greatest(0e0, least(({value} - {low}e0) / {high - low}e0, 1e0))) * 10e0)"


def severity(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN 0e0 ELSE greatest({calibrated(value)}, {fixed.MINIMUM_HIT_SCORE}e0) END"


def _assessed(context: str) -> str:
    return f"""
    SELECT query_id, hits, raw_score, severity,
           CASE WHEN severity < {fixed.LEVEL_LOW}e0 THEN 'none' WHEN severity < {fixed.LEVEL_HIGH}e0 THEN 'mild'
                ELSE 'strong' END AS mitigation_level
    FROM (SELECT q.query_id, coalesce(hits, 0) AS hits, raw_score, {severity('raw_score')} AS severity
          FROM text_queries q LEFT JOIN
               (SELECT query_id, count(*) AS hits, avg(raw) FILTER (place <= 3) AS raw_score
                FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, rank) AS place
                      FROM (SELECT *, {raw()} AS raw FROM {context}))
                GROUP BY query_id) USING (query_id))"""


def _five(labels: list[str]) -> str:
    return ", ".join(
        f"coalesce({_number(f'(?is){label}.*?{NUM}')}, 0e0) AS {key}"
        for key, label in zip(fixed.JUDGE_CRITERIA, labels)
    )


def _judge_parsed() -> str:
    keys = fixed.JUDGE_CRITERIA
    js = ", ".join(
        f"CASE WHEN NOT list_contains(json_keys(obj), '{k}') THEN 0e0 "
        f"ELSE TRY_CAST(json_extract_string(obj, '$.{k}') AS DOUBLE) END AS j_{k}"
        for k in keys
    )

    def positive(prefix):
        return "(" + " OR ".join(f"{prefix}_{k} > 0" for k in keys) + ")"

    strict = ", ".join(
        f"coalesce({_number(f'(?is){label}.*?{NUM}')}, 0e0) AS s_{k}" for k, label in zip(keys, fixed.JUDGE_LABELS)
    )
    loose = ", ".join(
        f"coalesce({_number(f'(?is){label}.*?{NUM}')}, 0e0) AS l_{k}"
        for k, label in zip(keys, fixed.JUDGE_LOOSE_LABELS)
    )
    label = ", ".join(f"CASE WHEN {positive('s')} THEN s_{k} ELSE l_{k} END AS b_{k}" for k in keys)
    numbers = ", ".join(f"TRY_CAST(nums[{n + 1}] AS DOUBLE) AS n_{k}" for n, k in enumerate(keys))
    full = " AND ".join(f"j_{k} IS NOT NULL" for k in keys)
    return rf"""
    SELECT *, coalesce(obj IS NOT NULL AND {full}, false) AS json_ok, {positive('b')} AS label_ok,
           len(nums) >= 5 AS number_ok
    FROM (SELECT *, {js}, {label}, {numbers}
          FROM (SELECT *, CASE WHEN braces <> '' AND json_valid(braces) THEN braces::JSON END AS obj,
                       {strict}, {loose},
                       regexp_extract_all(coalesce(response, ''), '\b{NUM}\b', 1) AS nums,
                       CASE WHEN closed = '}}' THEN regexp_replace(body, '["'']$', '')
                            ELSE regexp_replace(body, '["'']\n?$', '') END AS bare
                FROM (SELECT *, regexp_extract(coalesce(response, ''), '(?s)\{{.*\}}', 0) AS braces,
                             regexp_extract(coalesce(response, ''), '(?is)feedback["'']?([^}}]*)(\}}?)', 1) AS body,
                             regexp_extract(coalesce(response, ''), '(?is)feedback["'']?([^}}]*)(\}}?)', 2) AS closed
                      FROM judge_responses)))"""


def _judged() -> str:
    keys = fixed.JUDGE_CRITERIA
    scores = ", ".join(
        f"CASE parse_method WHEN 'json' THEN j_{k} WHEN 'label' THEN b_{k} WHEN 'number' THEN n_{k} ELSE 0e0 END AS {k}"
        for k in keys
    )
    return f"""
    SELECT pair_id, system, error,
           CASE WHEN error IS NOT NULL THEN {text(fixed.FAILED_CALL_RESPONSE)} ELSE response END AS raw_response,
           {', '.join(keys)},
           CASE WHEN error IS NULL THEN ({' + '.join(keys)}) / 5e0 END AS overall_score, feedback, parse_method
    FROM (SELECT *, {scores},
                 CASE parse_method
                   WHEN 'json' THEN CASE WHEN list_contains(json_keys(obj), 'feedback')
                                         THEN json_extract_string(obj, '$.feedback')
                                         ELSE {text(fixed.FEEDBACK_MISSING_IN_JSON)} END
                   WHEN 'default' THEN {text(fixed.FEEDBACK_UNPARSED)}
                   WHEN 'failed' THEN NULL ELSE feedback_text END AS feedback
          FROM (SELECT *, CASE WHEN error IS NOT NULL THEN 'failed' WHEN json_ok THEN 'json' WHEN label_ok THEN 'label'
                               WHEN number_ok THEN 'number' ELSE 'default' END AS parse_method,
                       CASE WHEN bare = '' THEN {text(fixed.FEEDBACK_MISSING_IN_TEXT)}
                            ELSE regexp_replace(bare, '^\\s+|\\s+$', '', 'g') END AS feedback_text
                FROM judge_parsed))"""


MARKERS = f"[{words(fixed.CORRUPTION_MARKERS)}]"
BROKEN_SENTENCES = (
    "list_filter(list_transform(string_split(regexp_replace({0}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
    "lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '')"
)


def sentence_list(column: str) -> str:
    return BROKEN_SENTENCES.format(column)


METRICS = [*fixed.JUDGE_CRITERIA, "overall_score"]

VIEWS: dict[str, tuple[list[str], str]] = {
    "messages": ([], """
        SELECT conv_id, turn, CASE role WHEN 'user' THEN 'proponent' WHEN 'assistant' THEN 'opponent' ELSE role END
               AS role, text AS content FROM conversations"""),
    "parted": (["messages"], f"""
        SELECT *, (turn // {transcripts.TURN_BLOCK}) * {transcripts.PIECES} + coalesce(cast(sum(strlen(line) + 1) OVER (
                      PARTITION BY conv_id, turn // {transcripts.TURN_BLOCK} ORDER BY turn
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) // {transcripts.PART_BYTES} AS part
        FROM (SELECT *, concat_ws(': ', role, content) AS line FROM messages)"""),
    "doc_topics": ([], f"SELECT doc_id, {TOPIC} AS topic, lang AS position FROM documents"),
    "walked": (["messages"], """
        SELECT conv_id, turn, before_text AS proponent, content AS opponent
        FROM (SELECT *, lag(role) OVER w AS before_role, lag(content) OVER w AS before_text FROM messages
              WHERE role IN ('proponent', 'opponent') WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        WHERE role = 'opponent' AND before_role = 'proponent' AND before_text <> ''"""),
    "pairs": (["walked", "doc_topics"], """
        SELECT conv_id * 1000000 + turn AS pair_id, conv_id, topic, position, proponent, opponent
        FROM walked LEFT JOIN doc_topics ON conv_id = doc_id"""),
    "marked_pairs": (["pairs"], f"""
        SELECT * REPLACE (opponent || coalesce(' ' || ({MARKERS})[conv_id % 20 + 1], '') AS opponent) FROM pairs"""),
    "flagged": (["marked_pairs"], _flagged()),
    "rubric": (["pairs"], _rubric()),
    "parsed_rubric": (["rubric"], _parsed_rubric()),
    "filled": (["parsed_rubric"], _filled()),
    "responses_scored": (["filled"], _responses_scored()),
    "scored": (["flagged", "responses_scored"], _scored()),
    "judge_responses": (["pairs"], _judge()),
    "judge_parsed": (["judge_responses"], _judge_parsed()),
    "judged": (["judge_parsed"], _judged()),
    "gold_judged": (["judged"], "SELECT * EXCLUDE (system) FROM judged WHERE system = 'gold'"),
    "toxicity": (["pairs"], _toxicity()),
    "judge_means": (["judged"], "SELECT system, " + ", ".join(
        f"CAST(sum(CAST(coalesce({m}, 0e0) AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS avg_{m}" for m in METRICS)
        + " FROM judged GROUP BY system"),
    "toxicity_means": (["toxicity"], """
        SELECT system, side, attribute, CAST(sum(CAST(CASE WHEN valid THEN score ELSE 0e0 END AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS avg_all,
               CAST(sum(CAST(score AS DECIMAL(28,12))) FILTER (valid) AS DOUBLE) / count(score) FILTER (valid) AS avg_valid
        FROM (SELECT system, attribute, valid, 'hate' AS side, hate AS score FROM toxicity
              UNION ALL SELECT system, attribute, valid, 'counter', counter FROM toxicity)
        GROUP BY ALL"""),
    "toxicity_drops": (["toxicity"], """
        SELECT system, attribute,
               CAST(sum(CAST(hate - counter AS DECIMAL(28,12))) AS DOUBLE) / count(hate - counter) AS avg_reduction,
               CAST(sum(CAST(CASE WHEN hate > 0 THEN (hate - counter) / hate * 100e0 WHEN counter = 0 THEN 0e0 ELSE -100e0 END
                             AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS avg_reduction_percent,
               avg(CASE WHEN hate - counter > 0 THEN 1e0 ELSE 0e0 END) AS samples_with_reduction
        FROM toxicity WHERE valid GROUP BY ALL"""),
    "evaluated": (["scored"], """
        SELECT *, conv_id % 5 AS kind, ROW_NUMBER() OVER (ORDER BY pair_id) AS id FROM scored"""),
    "resolved": (["evaluated"], "SELECT pair_id, id, topic, proponent, opponent, " + ", ".join(
        f"CASE WHEN kind = 1 THEN 0e0 ELSE {k} END AS {k}" for k in PAIR_SCORES)
        + ", CASE WHEN kind = 1 THEN '' ELSE assessment END AS assessment FROM evaluated"),
    "node_sentences": (["resolved"], f"""
        SELECT ROW_NUMBER() OVER (ORDER BY paragraph_id, position) AS id, content, paragraph_id
        FROM (SELECT id AS paragraph_id, unnest(s) AS content, generate_subscripts(s, 1) AS position
              FROM (SELECT id, {sentence_list('proponent')} AS s FROM resolved))"""),
    "paragraphs": ([], f"""
        SELECT doc_id AS id, text AS content, {TOPIC} AS topic, doc_id + 1 AS source_debate,
               4e0 + (doc_id % 7) * 0.5e0 AS representativeness, 4e0 + (doc_id % 5) * 0.5e0 AS coherence,
               5e0 + (doc_id % 11) * 0.5e0 AS harmfulness, 5e0 + (doc_id % 11) * 0.5e0 AS quality_score,
               CASE (doc_id // 20) % 5 WHEN 0 THEN true WHEN 1 THEN false END AS is_synthetic,
               CASE WHEN (doc_id // 20) % 5 = 0 THEN 2::BIGINT ELSE 1::BIGINT END AS layer
        FROM documents"""),
    "sentences": ([], "SELECT vec_id AS id, (vec_id // 3) * 7 AS paragraph_id, embedding FROM embeddings"),
    "counters": (["pairs", "doc_topics"], """
        SELECT *, (directness + evidence_quality + persuasiveness) / 3e0 AS quality_score, '' AS assessment
        FROM (SELECT pair_id AS id, p.conv_id * 7 AS counters_id, opponent AS content, d.topic,
                     4e0 + (pair_id % 7) * 0.5e0 AS directness, 4e0 + (pair_id % 5) * 0.5e0 AS evidence_quality,
                     4e0 + (pair_id % 3) * 0.5e0 AS persuasiveness
              FROM pairs p LEFT JOIN doc_topics d ON p.conv_id * 7 = d.doc_id)"""),
    "topics": (["paragraphs"], "SELECT DISTINCT topic AS name FROM paragraphs WHERE topic <> ''"),
    "stored": ([], """
        SELECT vec_id AS id, embedding,
               (['array', 'json', 'csv', 'unknown', 'missing'])[vec_id % 5 + 1] AS format FROM embeddings"""),
    "example_lines": ([], """
        SELECT doc_id AS line, source AS topic, CASE WHEN doc_id % 10 <> 7 THEN text END AS content,
               CASE WHEN doc_id % 39 = 0 THEN 'rejected' WHEN doc_id % 31 = 0 THEN 'blank'
                    WHEN doc_id % 26 = 0 THEN 'untitled' ELSE 'accepted' END AS outcome
        FROM documents"""),
    "examples": (["example_lines"], "SELECT line, topic, content FROM example_lines WHERE outcome = 'accepted'"),
    "records": ([], f"""
        SELECT topic, gen_id, record_no, record
        FROM (SELECT topic, gen_id, record, row_number() OVER (PARTITION BY topic ORDER BY gen_id, position) AS record_no
              FROM (SELECT topic, gen_id, position, regexp_replace(piece, '^\\s+|\\s+$', '', 'g') AS record
                    FROM (SELECT topic, gen_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS position
                          FROM (SELECT source AS topic, doc_id AS gen_id,
                                       string_split(replace(text, chr(10), ' EXAMPLE: '), 'EXAMPLE:') AS pieces
                                FROM documents))
                    WHERE position > 1)
              WHERE record <> '' AND length(record) <= {fixed.RECORD_MAX_CHARS})
        WHERE record_no <= {fixed.RECORDS_PER_TOPIC}"""),
    "text_queries": ([], "SELECT item_id AS query_id, text AS query FROM benchmark"),
    "query_words_v1": (["text_queries"], _terms(5, 1)),
    "query_words_v2": (["text_queries"], _terms(10, 2)),
    "terms_v1": (["query_words_v1"], _weighted("query_words_v1")),
    "terms_v2": (["query_words_v2"], _weighted("query_words_v2")),
    "matches_v1": (["terms_v1", "paragraphs"], _matches("terms_v1")),
    "matches_v2": (["terms_v2", "paragraphs"], _matches("terms_v2")),
    "single_hits": (["matches_v1"], f"""
        SELECT * FROM (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
                       FROM matches_v1 WHERE layer = 1) WHERE rank <= {fixed.RESULTS_PER_LAYER}"""),
    "two_layer_hits": (["matches_v1"], _layered("matches_v1")),
    "phrase_hits": (["matches_v2"], _layered("matches_v2")),
    "nearest": (["sentences", "text_queries"], f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, sentence_id) AS place
                       FROM (SELECT query_id, s.id AS sentence_id,
                                    round(list_cosine_similarity(q.embedding::DOUBLE[], s.embedding::DOUBLE[]), 9) AS similarity
                             FROM text_queries JOIN embeddings q ON q.vec_id = query_id, sentences s))
        WHERE place <= {fixed.VECTOR_OVERFETCH * fixed.RESULTS_PER_LAYER}"""),
    "near_enough": (["nearest"], f"SELECT * FROM nearest WHERE similarity >= {fixed.SIMILARITY_THRESHOLD}e0"),
    "rolled": (["near_enough", "sentences", "paragraphs"], """
        SELECT query_id, p.id, layer, quality_score, max(similarity) AS similarity_score
        FROM near_enough n JOIN sentences s ON s.id = n.sentence_id JOIN paragraphs p ON p.id = s.paragraph_id
        GROUP BY ALL"""),
    "semantic_hits": (["rolled"], _semantic("similarity_score")),
    "quality_hits": (["rolled"], _semantic("quality_score")),
    "hybrid_hits": (["semantic_hits", "phrase_hits"], f"""
        SELECT * FROM (SELECT query_id, id, layer, similarity_score,
                              row_number() OVER (PARTITION BY query_id ORDER BY source, listed) AS rank
                       FROM (SELECT *, row_number() OVER (PARTITION BY query_id, id ORDER BY source, listed) AS copy
                             FROM (SELECT query_id, id, layer, similarity_score, 1 AS source, rank AS listed
                                   FROM semantic_hits
                                   UNION ALL SELECT query_id, id, layer, NULL, 2, rank FROM phrase_hits))
                       WHERE copy = 1) WHERE rank <= {2 * fixed.RESULTS_PER_LAYER}"""),
    "topic_hits": (["paragraphs"], """
        SELECT query_id, p.id, p.layer, row_number() OVER (PARTITION BY query_id ORDER BY p.id) AS rank
        FROM (SELECT item_id AS query_id, 'src' || item_id % 12 AS query FROM benchmark)
        JOIN paragraphs p ON p.topic <> '' AND contains(lower(p.topic), query)"""),
    "syntax_hits": (["phrase_hits"], "SELECT query_id, id, layer, rank, CAST(NULL AS DOUBLE) AS similarity_score FROM phrase_hits"),
    "first_counter": (["counters"], """
        SELECT counters_id AS id, id AS counter_id, content AS counter_content, directness, evidence_quality, persuasiveness
        FROM counters QUALIFY row_number() OVER (PARTITION BY counters_id ORDER BY id) = 1"""),
    "topic_counter": (["counters"], """
        SELECT topic, id AS counter_id, content AS counter_content, directness, evidence_quality, persuasiveness
        FROM counters WHERE topic <> '' QUALIFY row_number() OVER (PARTITION BY topic ORDER BY id) = 1"""),
}
for _method in ("semantic", "hybrid", "syntax"):
    VIEWS[f"{_method}_filled"] = (
        [f"{_method}_hits", "paragraphs", "first_counter", "topic_counter"], _context(f"{_method}_hits"))
    VIEWS[f"{_method}_context"] = ([f"{_method}_filled"], _ready_context(f"{_method}_filled"))
    VIEWS[f"{_method}_assessed"] = ([f"{_method}_context", "text_queries"], _assessed(f"{_method}_context"))


def with_views(select: str, *needed: str) -> str:
    """The query with the views it needs in front, each after the ones it reads."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for below in VIEWS[name][0]:
            visit(below)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        visit(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered) + "\n" + select
