"""Byte-level BPE over a table of distinct words (operator 9).

Spark splits texts into words; a pack of documents keeps, for every position, the number of
its word in the pack's own list of distinct words. The lists meet in hashed buckets, where
every distinct word of the corpus is encoded once; the ids come back in the order of the
list, so they are joined back by position. Decoding joins ids with the table of pieces, one
row for each id of the vocabulary.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.packs import (
    BLOCK_SCHEMA, PACK_BYTES, answered, bucket_count, bucket_edges, expand, from_ipc, gather, in_order, new_pack_id,
    squeeze, to_ipc, written_packs,
)
from rejoinder.llm.text import release

#: The vocabulary file that is read where no path is given.
DEFAULT_TOKENIZER = "byte_bpe_50k.json"

#: Distinct words of all packs that meet in one task.
BUCKET_BYTES = 6 << 20

#: Words that the tokenizer is given at once, and that are hashed or counted at once; neither changes any result.
ENCODED_AT_ONCE = 2000
WORDS_AT_ONCE = 50_000

#: White space and the word pattern of byte-level tokenizers.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def default_tokenizer() -> str:
    import public_tokenizers  # needed by the driver only

    return str(public_tokenizers.path(DEFAULT_TOKENIZER))


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file; only plain byte-level BPE can be split into words beforehand."""
    path = path or default_tokenizer()
    with open(path, encoding="utf-8") as file:
        text = file.read()
    told = json.loads(text)
    pre = told.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or told.get("normalizer"):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in told["added_tokens"]):
        raise ValueError(f"{path}: added tokens that take neighbouring characters are not supported")
    return text


def words_of(text: Column, specials: list[str]) -> Column:
    """The words of a text in order; their concatenation is the text. Added tokens are words of their own."""
    plain = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    if not specials:
        return plain
    any_special = "|".join("\\Q" + s + "\\E" for s in sorted(specials, key=len, reverse=True))
    found = F.regexp_extract_all(text, F.lit(any_special), F.lit(0))
    between = F.transform(F.split(text, any_special, -1), lambda part: F.regexp_extract_all(part, F.lit(WORD), F.lit(0)))
    zipped = F.zip_with(between, found, lambda part, special: F.when(special.isNull(), part).otherwise(F.concat(part, F.array(special))))
    return F.when(F.size(found) > 0, F.flatten(zipped)).otherwise(plain)


@cache
def _tokenizer(text: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_str(text)


def piece_table(text: str) -> pa.Array:
    """The bytes of every id of the vocabulary, at the id's place."""
    told = json.loads(text)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    pieces = {i: bytes(byte_of[c] for c in piece) for piece, i in told["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in told["added_tokens"]}
    return pa.array([pieces.get(i, b"") for i in range(max(pieces) + 1)], pa.large_binary())


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A number for each word; some words at a time, as every byte of them takes several numbers on the way."""
    parts = [_hashes(words.slice(at, WORDS_AT_ONCE)) for at in range(0, len(words), WORDS_AT_ONCE)]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _hashes(words: pa.Array) -> np.ndarray:
    from rejoinder.llm.text import flat, mix, powers

    data, at = flat(words)
    length = np.diff(at)
    place = np.arange(len(data)) - np.repeat(at[:-1], length)
    value = (data.astype(np.uint64) + np.uint64(1)) * powers(int(length.max(initial=1)))[place]
    np.cumsum(value, out=value)
    edges = np.concatenate([np.zeros(1, np.uint64), value])[at]
    total = edges[1:] - edges[:-1]
    return mix(total + length.astype(np.uint64))


def _coded(places: np.ndarray) -> bytes:
    """Places below 255 as one byte each, the others after them."""
    return to_ipc(pa.table({"near": [squeeze(np.minimum(places, 255).astype(np.uint8))], "far": [squeeze(places[places >= 255])]}))


def _decoded(block: bytes) -> np.ndarray:
    (row,) = from_ipc(block).to_pylist()
    places = expand(row["near"], np.uint8).astype(np.int32)
    places[places == 255] = expand(row["far"], np.int32)
    return places


def _packed(batches: Iterator[pa.RecordBatch], key: str, words: str) -> Iterator[pa.RecordBatch]:
    """One row for each pack: keys and word counts of its rows, distinct words, a word number for each position."""

    def text_bytes(batch: pa.RecordBatch) -> int:
        values = batch.column(words).flatten()
        return len(values) * 4 + (pc.sum(pc.binary_length(values)).as_py() or 0)

    for table in gather(batches, text_bytes, PACK_BYTES):
        lists = table.column(words)
        values = [chunk.flatten() for chunk in lists.chunks]
        encoded = pc.dictionary_encode(pa.chunked_array(values, lists.type.value_type)).combine_chunks()
        dictionary = encoded.dictionary
        order = np.argsort(_word_hashes(dictionary), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        numbers = rank[encoded.indices.to_numpy(zero_copy_only=False)]
        # positions hold places by frequency, which compress well; the counts give them back
        times = np.zeros(len(order), np.int32)
        for at in range(0, len(numbers), 10 * WORDS_AT_ONCE):
            times += np.bincount(numbers[at : at + 10 * WORDS_AT_ONCE], minlength=len(order)).astype(np.int32)
        by_frequency = np.empty(len(order), np.int32)
        by_frequency[np.argsort(-times, kind="stable")] = np.arange(len(order), dtype=np.int32)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "pack_id": [new_pack_id()],
                "n_bytes": pa.array([pc.sum(pc.binary_length(dictionary)).as_py() or 0], pa.int64()),
                "rows": [to_ipc(pa.table({"key": table.column(key), "n_words": counts}))],
                "numbers": [_coded(by_frequency[numbers])],
                "times": [squeeze(times)],
                "words": [to_ipc(pa.table({"word": dictionary.take(pa.array(order))}))],
            }
        )


def _asked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pack_id, block in zip(batch["pack_id"].to_pylist(), batch["words"].to_pylist(), strict=True):
            words = from_ipc(block).column("word").combine_chunks()
            edges = bucket_edges(_word_hashes(words), buckets)
            for bucket in np.flatnonzero(np.diff(edges)):
                mine = words.slice(edges[bucket], edges[bucket + 1] - edges[bucket])
                yield pa.RecordBatch.from_pydict(
                    {"pack_id": [pack_id], "bucket": pa.array([bucket], pa.int32()), "block": [to_ipc(pa.table({"word": mine}))]}
                )


def _encoded(blocks: list[bytes], tokenizer: str) -> list[bytes]:
    asked = [from_ipc(b).column("word").combine_chunks() for b in blocks]
    joined = pc.dictionary_encode(pa.concat_arrays(asked))
    sizes, ids = [np.zeros(1, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(joined.dictionary), ENCODED_AT_ONCE):  # ids as numbers, not as Python's lists of all words
        words = joined.dictionary.slice(at, ENCODED_AT_ONCE).to_pylist()
        own = [e.ids for e in _tokenizer(tokenizer).encode_batch(words, add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, own), np.int32, len(own)))
        ids.append(np.fromiter(chain.from_iterable(own), np.int32))
    ends = np.cumsum(np.concatenate(sizes), dtype=np.int64)
    table = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
    answers, at = [], 0
    for block in asked:
        mine = table.take(joined.indices.slice(at, len(block)))
        sizes = pc.list_value_length(mine).to_numpy(zero_copy_only=False)
        answers.append(to_ipc(pa.table({"size": [squeeze(sizes.astype(np.int32))], "ids": [squeeze(mine.flatten().to_numpy().astype(np.int32))]})))
        at += len(block)
    return answers


def encode_documents(docs: DataFrame, key: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """For every row its tokens and what they decode to: (key, ids array<int>, decoded binary).

    A null text counts as empty and gives no ids. The vocabulary is the only thing broadcast.
    """
    return _finished(docs, key, text_col, tokenizer, digest=False)


def encode_digests(docs: DataFrame, key: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """For every row: (key, n_tokens, ids_sha256, decoded_sha256), without moving the ids."""
    return _finished(docs, key, text_col, tokenizer, digest=True)


def _finished(docs: DataFrame, key: str, text_col: str, tokenizer: str | None, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    text = tokenizer_json(tokenizer)
    vocabulary = spark.sparkContext.broadcast(text)
    specials = [t["content"] for t in json.loads(text)["added_tokens"]]
    key_type = docs.schema[key].dataType
    split = docs.select(F.col(key).alias("key"), words_of(F.coalesce(F.col(text_col), F.lit("")), specials).alias("words"))
    packs, _ = written_packs(
        split.mapInArrow(lambda batches: _packed(batches, "key", "words"), "pack_id string, n_bytes bigint, rows binary, numbers binary, times binary, words binary"),
        "bpe-packs",
    )
    buckets = bucket_count(packs, "n_bytes", BUCKET_BYTES)
    questions = packs.select("pack_id", "words").mapInArrow(partial(_asked, buckets=buckets), BLOCK_SCHEMA)
    answers = answered(questions, lambda blocks: _encoded(blocks, vocabulary.value))

    def assembled(pack: pa.Table, replies: pa.Table) -> pa.Table:
        row = {name: pack.column(name)[0].as_py() for name in ("rows", "numbers", "times")}
        rows = from_ipc(row["rows"])
        numbers = np.argsort(-expand(row["times"], np.int32), kind="stable").astype(np.int32)[_decoded(row["numbers"])]
        blocks = [from_ipc(b).to_pylist()[0] for b in in_order(replies)]
        none = np.zeros(0, np.int32)
        sizes, values = (np.concatenate([none, *(expand(b[name], np.int32) for b in blocks)]) for name in ("size", "ids"))
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))
        told = _documents(rows, numbers, ids, vocabulary.value, digest)
        release()
        return told

    out_type = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded binary"
    schema = f"`{key}` {key_type.simpleString()}, {out_type}"
    return (
        packs.select("pack_id", "rows", "numbers", "times").groupBy("pack_id")
        .cogroup(answers.groupBy("pack_id"))
        .applyInArrow(lambda p, r: assembled(p, r).rename_columns([key, *[c.split()[0] for c in out_type.split(", ")]]), schema)
    )


@cache
def _decimal(size: int) -> pa.Array:
    return pa.array([b"%d," % i for i in range(size)], pa.large_binary())


@cache
def _pieces(text: str) -> pa.Array:
    return piece_table(text)


def _bytes_between(values: pa.Array, edges: np.ndarray) -> Iterator[memoryview]:
    """The concatenated bytes of ``values[edges[i]:edges[i + 1]]`` for each i."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1][edges]
    view = memoryview(data) if data is not None else memoryview(b"")
    for start, end in zip(at, at[1:], strict=False):
        yield view[start:end]


def _documents(rows: pa.Table, numbers: np.ndarray, ids: pa.Array, vocabulary: str, digest: bool) -> pa.Table:
    """Join ids back by position, a run of documents at a time, and decode them by the piece table."""
    pieces = _pieces(vocabulary)
    n_words = rows.column("n_words").to_numpy()
    ends = np.cumsum(n_words)
    parts: list[list[pa.Array]] = []
    at = 0
    while at < len(n_words):
        start = ends[at] - n_words[at]
        upto = max(at + 1, int(np.searchsorted(ends, start + 500_000, "right")))
        lists = ids.take(pa.array(numbers[start : ends[upto - 1]]))
        flat_ids = lists.flatten()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[start], ends[at:upto]]) - start]
        decoded = pieces.take(flat_ids)
        if digest:
            decimal = _decimal(len(pieces)).take(flat_ids)
            told = [hashlib.sha256(v[: max(0, len(v) - 1)]).hexdigest() for v in _bytes_between(decimal, edges)]
            back = [hashlib.sha256(v).hexdigest() for v in _bytes_between(decoded, edges)]
            parts.append([pa.array(np.diff(edges)), pa.array(told, pa.string()), pa.array(back, pa.string())])
        else:
            own = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), flat_ids)
            parts.append([own, pa.array([bytes(v) for v in _bytes_between(decoded, edges)], pa.binary())])
        at = upto
    types = [pa.int64(), pa.string(), pa.string()] if digest else [pa.list_(pa.int32()), pa.binary()]
    arrays = [pa.chunked_array([part[i] for part in parts], t) for i, t in enumerate(types)]
    return pa.table([rows.column("key"), *arrays], names=["key", *(f"c{i}" for i in range(len(arrays)))])
