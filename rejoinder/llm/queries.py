"""Registered queries of this package; every one reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rejoinder.llm import (
    bpe, byte_dedup, collocations, decontamination, exact_dedup, language, near_dedup, quality, secret_ledger, spelling, substring_dedup,
    toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_report(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.secret_report(_table(spark, sf_dir, "documents"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_dedup.byte_report(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(_table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(_table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_substring_dedup, op3_toxicity, op4_quality, op5_language, op6_secrets, op7_suffix_array,
        op8_exact_dedup, op9_bpe, op10_near_dedup, op11_collocations, op12_spelling, op13_warc, pipeline,
    )
}

LLM_ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
            FROM documents),
        starts AS (
            SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM split WHERE len(words) >= 13),
        windows AS (
            SELECT doc_id, place, min(doc_id) OVER w AS first_id, max(doc_id) OVER w AS last_id
            FROM starts WINDOW w AS (PARTITION BY words[place:place + 12])),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place FROM windows WHERE first_id < doc_id),
        lost AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
        ladder AS (
            SELECT DISTINCT 13::BIGINT AS size, doc_id FROM windows WHERE first_id < last_id
            UNION ALL
            SELECT DISTINCT 2 * size, doc_id FROM (
                SELECT size, doc_id, min(doc_id) OVER w <> max(doc_id) OVER w AS held
                FROM (SELECT size, doc_id, unnest([md5(array_to_string(words[i:i + 2 * size - 1], ' ')) FOR i IN range(1, len(words) - 2 * size + 2)]) AS part
                      FROM ladder JOIN split USING (doc_id))
                WINDOW w AS (PARTITION BY part))
            WHERE held),
        longest AS (SELECT doc_id, max(size) AS size FROM ladder GROUP BY doc_id),
        told AS (
            SELECT doc_id, words, coalesce(places, []) AS places FROM split LEFT JOIN lost USING (doc_id))
        SELECT doc_id, len(words) AS n_words, len(places) AS n_removed,
               sha256(coalesce(array_to_string([words[i] FOR i IN range(1, len(words) + 1) IF NOT list_contains(places, i)], ' '), '')) AS kept_sha256,
               coalesce(size, 0)::BIGINT AS longest_repeat
        FROM told LEFT JOIN longest USING (doc_id)
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        split AS (
            SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS words FROM pieces),
        totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang),
        runs AS (
            SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place
            FROM split, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(words) >= size),
        counted AS (
            SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*) AS a
            FROM runs GROUP BY ALL HAVING count(*) >= 100),
        cuts AS (
            SELECT lang, size, phrase, a, k, string_split(phrase, ' ') AS words
            FROM counted, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < size),
        scored AS (
            SELECT c.lang, c.size, c.phrase, c.a, c.k, f.a AS l, b.a AS r, n, (1000::HUGEINT * c.a * n) // (f.a::HUGEINT * b.a) AS score
            FROM cuts c
            JOIN counted f ON f.lang = c.lang AND f.phrase = array_to_string(c.words[1:c.k], ' ')
            JOIN counted b ON b.lang = c.lang AND b.phrase = array_to_string(c.words[c.k + 1:], ' ')
            JOIN totals t ON t.lang = c.lang),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
            SELECT * FROM lowest s WHERE NOT EXISTS (
                SELECT 1 FROM counted o
                WHERE o.lang = s.lang AND o.size > s.size AND 100 * o.a >= 100 * s.a
                  AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' ')))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score::BIGINT AS score
        FROM kept QUALIFY rank <= 2000
    """,
    "op13_warc": """
        WITH told AS (
            SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS hex,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages)
        SELECT page_id, strlen(html) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::BIGINT, 1) FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < last THEN last END AS refers_to
        FROM told
    """,
}
