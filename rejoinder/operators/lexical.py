"""Keyword search: weighted terms per query, substring matches, scores, top results."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.text import keywords, phrases
from rejoinder.operators.joins import top_per
from rejoinder.operators.knowledge_base import layer

# Characters of terms one broadcast may hold; more terms are matched block by block.
TERM_BLOCK_CHARS = 2_000_000

# (text, term, query) hits scored together inside a task.
HITS_AT_ONCE = 200_000

LAYERS = 3  # 1 and 2 for texts, 0 for topic names

MATCH_SCHEMA = "query_id bigint, id bigint, layer int, score bigint, qualifies boolean"


def terms_v1(queries: DataFrame) -> DataFrame:
    """Whole query 5, each keyword 1 per occurrence. Without keywords the whole query qualifies a text."""
    return _weighted(queries, keywords(F.col("query")), F.array().cast("array<string>"), 5)


def terms_v2(queries: DataFrame, stop_words: list[str] = fixed.STOP_WORDS) -> DataFrame:
    """Whole query 10, phrases 3, keywords without stop words 1."""
    text = F.col("query")
    return _weighted(queries, keywords(text, stop_words), phrases(text, stop_words), 10)


def _weighted(queries: DataFrame, words: Column, several: Column, whole_weight: int) -> DataFrame:
    """Terms with their summed weight; the whole query qualifies a text only if it is all there is."""

    def weighted(terms: Column, weight: int, qualifies: Column) -> Column:
        return F.transform(
            terms,
            lambda term: F.struct(term.alias("term"), F.lit(weight).alias("weight"), qualifies.alias("qualifies")),
        )

    alone = (F.size("_words") == 0) & (F.size("_phrases") == 0)
    every = F.concat(
        weighted(F.col("_words"), 1, F.lit(True)),
        weighted(F.col("_phrases"), 3, F.lit(True)),
        weighted(F.array(F.lower("query")), whole_weight, alone),
    )
    return (
        queries.select("query_id", "query", words.alias("_words"), several.alias("_phrases"))
        .select("query_id", F.explode(every).alias("_t"))
        .groupBy("query_id", F.col("_t.term").alias("term"))
        .agg(F.sum("_t.weight").alias("weight"), F.bool_or("_t.qualifies").alias("qualifies"))
        .filter(F.col("term") != "")
    )


_matchers: dict[str, tuple] = {}


def _matcher(name: str, shared) -> tuple:
    """Automaton over the block's terms and, per term, the queries it scores for.

    Built once per Python worker and block.
    """
    if name not in _matchers:
        block = shared.value
        automaton = ahocorasick.Automaton()
        names, number = np.unique(block["term"].to_numpy(dtype=object), return_inverse=True)
        for position, term in enumerate(names):
            automaton.add_word(term, position)
        automaton.make_automaton()
        order = np.argsort(number, kind="stable")
        starts = np.searchsorted(number[order], np.arange(len(names) + 1))
        ids, query = np.unique(block["query_id"].to_numpy(), return_inverse=True)
        _matchers.clear()
        _matchers[name] = (
            automaton, starts, ids, query[order],
            block["weight"].to_numpy()[order], block["qualifies"].to_numpy(dtype=bool)[order],
        )
    return _matchers[name]


def _scored(batch: pd.DataFrame, text: list[int], term: list[int], block: tuple) -> pd.DataFrame:
    """Weights of the (text, term) hits added up per (text, query)."""
    _, starts, ids, query, weight, qualifying = block
    row, hit = np.array(text), np.array(term)
    many = starts[hit + 1] - starts[hit]
    first = np.repeat(starts[hit] - np.r_[0, np.cumsum(many)[:-1]], many)
    use = first + np.arange(many.sum())
    pair, slot = np.unique(np.repeat(row, many) * len(ids) + query[use], return_inverse=True)
    row, asked = np.divmod(pair, len(ids))
    return pd.DataFrame(
        {
            "query_id": ids[asked],
            "id": batch["id"].to_numpy()[row],
            "layer": batch["layer"].to_numpy()[row],
            "score": np.bincount(slot, weights=weight[use]).astype(np.int64),
            "qualifies": np.bincount(slot, weights=qualifying[use]) > 0,
        }
    )


def _score_texts(name: str, shared, keep: int | None):
    """Scores of one partition's texts; with ``keep`` the best per query and layer only."""

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = _matcher(name, shared)
        askers = np.diff(block[1])  # queries per term
        for batch in batches:
            text: list[int] = []
            term: list[int] = []
            uses = 0
            for row, content in enumerate(batch["text"]):
                hits = list({position for _, position in block[0].iter(content)})
                text.extend([row] * len(hits))
                term.extend(hits)
                uses += int(askers[hits].sum()) if hits else 0
                if uses > HITS_AT_ONCE:
                    yield _scored(batch, text, term, block)
                    text, term, uses = [], [], 0
            if term:
                yield _scored(batch, text, term, block)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _matcher(name, shared)[2]
        # Score and id of the last kept row per query and layer, once there are enough.
        last_score = np.zeros((len(ids), LAYERS))
        last_id = np.full((len(ids), LAYERS), np.iinfo(np.int64).max)
        kept = None
        for scored in scores(batches):
            place = np.searchsorted(ids, scored["query_id"]), scored["layer"].to_numpy()
            ahead = (scored["score"] > last_score[place]) | (
                (scored["score"] == last_score[place]) & (scored["id"] < last_id[place])
            )
            rows = scored[scored["qualifies"] & ahead]
            if rows.empty:
                continue
            rows = rows if kept is None else pd.concat([kept, rows])
            rows = rows.sort_values(["query_id", "layer", "score", "id"], ascending=[True, True, False, True])
            order = rows.groupby(["query_id", "layer"]).cumcount()
            kept = rows[order < keep]
            last = rows[order == keep - 1]
            place = np.searchsorted(ids, last["query_id"]), last["layer"].to_numpy()
            last_score[place], last_id[place] = last["score"], last["id"]
        if kept is not None:
            yield kept

    return scores if keep is None else best


def match_terms(
    texts: DataFrame, terms: DataFrame, keep: int | None = None,
    chars: int | None = None, block_chars: int = TERM_BLOCK_CHARS,
) -> DataFrame:
    """Score of every (query, text) with at least one qualifying term contained in the text.

    ``texts`` has ``id, layer, text`` (lower case). One pass over the texts finds all terms of
    a block at once, so the work grows with the text, not with text times terms, and nothing
    but matches leaves the task; with ``keep`` only those leave it that can be among the
    ``keep`` best of a query and layer. ``chars`` is an upper bound of the terms' length; where
    it does not settle the matter the terms are counted. Up to ``block_chars`` they are one
    broadcast; beyond it the queries are cut by hash into blocks of that size, each matched in
    its own pass. A block holds whole queries, so scores are final and ``keep`` holds for any size.
    """
    spark = texts.sparkSession
    blocks = 1
    if chars is None or chars > block_chars:
        size = terms.agg(F.coalesce(F.sum(F.length("term")), F.lit(0))).first()[0]
        blocks = max(1, math.ceil(size / block_chars))
    if blocks > 1:
        blocks = 2 * blocks  # hashed blocks differ in size; halve the mean to stay below the bound
        terms = terms.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    narrow = texts.select("id", "layer", "text")
    passes = []
    for block in range(blocks):
        part = terms.filter(F.col("_block") == block) if blocks > 1 else terms
        rows = part.select("query_id", "term", "weight", "qualifies").toPandas()
        if rows.empty:
            continue
        shared = spark.sparkContext.broadcast(rows)
        passes.append(narrow.mapInPandas(_score_texts(uuid.uuid4().hex, shared, keep), MATCH_SCHEMA))
    if not passes:
        return spark.createDataFrame([], MATCH_SCHEMA).drop("qualifies")
    matched = passes[0]
    for more in passes[1:]:
        matched = matched.unionAll(more)
    return matched.filter("qualifies").drop("qualifies")


def _most_chars(queries: DataFrame) -> int:
    """Upper bound of the length of all terms: a token is in one keyword, two two-token and
    three three-token phrases with three blanks in all, and the whole query; lower case may lengthen a letter."""
    return 20 * queries.agg(F.coalesce(F.sum(F.length("query")), F.lit(0))).first()[0]


def lowered(paragraphs: DataFrame) -> DataFrame:
    return paragraphs.select("id", layer().alias("layer"), F.lower("content").alias("text")).filter(
        F.col("text").isNotNull()
    )


def score_v1(queries: DataFrame, paragraphs: DataFrame, **options) -> DataFrame:
    return match_terms(lowered(paragraphs), terms_v1(queries), chars=_most_chars(queries), **options)


def score_v2(queries: DataFrame, paragraphs: DataFrame, **options) -> DataFrame:
    return match_terms(lowered(paragraphs), terms_v2(queries), chars=_most_chars(queries), **options)


def best_first() -> list:
    return [F.desc("score"), F.asc("id")]


def single_layer_hits(queries: DataFrame, paragraphs: DataFrame, k: int = fixed.RESULTS_PER_LAYER) -> DataFrame:
    """First version, texts that are not synthetic."""
    first = paragraphs.filter(~F.coalesce(F.col("is_synthetic"), F.lit(False)))
    return top_per(score_v1(queries, first, keep=k), ["query_id"], best_first(), k)


def _layered(hits: DataFrame, k: int) -> DataFrame:
    """Top ``k`` of each layer, ranked with layer 1 first."""
    top = top_per(hits, ["query_id", "layer"], best_first(), k, "_place")
    listed = Window.partitionBy("query_id").orderBy("layer", "_place")
    return top.withColumn("rank", F.row_number().over(listed)).drop("_place")


def two_layer_hits(queries: DataFrame, paragraphs: DataFrame, k: int = fixed.RESULTS_PER_LAYER) -> DataFrame:
    return _layered(score_v1(queries, paragraphs, keep=k), k)


def phrase_hits(queries: DataFrame, paragraphs: DataFrame, k: int = fixed.RESULTS_PER_LAYER) -> DataFrame:
    return _layered(score_v2(queries, paragraphs, keep=k), k)
