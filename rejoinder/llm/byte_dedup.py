"""Removal of repeated byte strings by a collection suffix array (operator 7).

Every window of ``least`` bytes has a speaker: the half-length string with the least hash among
those it holds, so equal windows have equal speakers at the same place. The windows of one
speaker lie side by side; the bytes they cover are a segment. Speakers that occur once in the
corpus are done with. Speakers whose segments are all equal need no more either: their windows
repeat if the segment does. The different segments of each other speaker are brought together,
a suffix array of the segments is built by columns (``suffix_array``) and common prefixes of
``least`` bytes tell which windows repeat.

A speaker with very many different segments (a line that very many documents hold) would put
an unbounded collection into one task; its windows are asked one by one by their hashes instead,
which spreads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.packs import (
    BLOCK_SCHEMA, answered, bucket_count, bucket_edges, expand, from_ipc, in_order, squeeze, to_ipc, written_packs,
)
from rejoinder.llm.substring_dedup import PACK_SCHEMA, packed
from rejoinder.llm.suffix_array import repeated_starts
from rejoinder.llm.text import U64, flat, inverse_powers, least_of, mix, powers, windows
from rejoinder.session import scratch_path

LEAST = 200
PACK_BYTES = 8 << 20
#: Bytes looked at together inside a pack; windows that begin in a chunk are looked at whole.
CHUNK = 1 << 16
#: Different segments of one speaker that are still put into one collection.
MOST_SEGMENTS = 20_000
#: Segments of one suffix array.
COLLECTION = 2_000

ONCE, ALL, SOME, MANY = 0, 1, 2, 3  # answers of the first level


class Pack:
    """Bytes of a pack and its segments: speaker, content, first window and number of windows."""

    def __init__(self, rows: bytes, least: int):
        table = from_ipc(rows)
        self.key = table.column("doc_id").combine_chunks()
        self.data, self.offsets = flat(table.column("text"))
        self.least, self.half = least, -(-least // 2)
        parts = [x for start, end in self._chunks() if (x := self._segments(start, end)) is not None]
        none = (np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.speaker, self.content, self.first, self.count = (np.concatenate(x) for x in zip(*(parts or [none]), strict=True))

    def _chunks(self) -> Iterator[tuple[int, int]]:
        """Ranges of window starts, each inside one text or over whole texts."""
        at, n = 0, len(self.data)
        while at < n:
            upto = min(n, at + CHUNK)
            yield at, upto
            at = upto

    def _segments(self, start: int, end: int):
        """The segments whose speakers begin in [start, end); look-back and look-ahead show them whole."""
        least, half = self.least, self.half
        # look back and ahead, so that segments that touch the chunk are seen whole
        low, high = max(0, start - least), min(len(self.data), end + 2 * least)
        size = high - low
        if size < least:
            return None
        # running sums of bytes times powers; a range times its inverse power depends on its content alone
        sums = np.concatenate([np.zeros(1, U64), np.cumsum((self.data[low:high].astype(U64) + U64(1)) * powers(size))])
        inverse = inverse_powers(size)
        halves = mix((sums[half:] - sums[:-half]) * inverse[: size - half + 1])
        place = np.arange(len(halves), dtype=U64)
        bits = U64(20)
        key = ((halves >> bits) << bits) | place
        at = (least_of(key, least - half + 1) & U64((1 << 20) - 1)).astype(np.int64)
        texts = slice(np.searchsorted(self.offsets, low, "right") - 1, np.searchsorted(self.offsets, low + len(at), "left"))
        edges = np.clip(np.append(self.offsets[texts], low + len(at)), low, low + len(at))
        owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        text_end = self.offsets[texts.start + 1 : texts.stop + 1]
        good = np.arange(low + least, low + least + len(at)) <= text_end[owner]
        # a new segment where the speaker or the text changes
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | ~good[:-1] | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new & good)
        edge = np.flatnonzero(new | ~good)
        nxt = np.searchsorted(edge, first, "right")
        count = np.where(nxt < len(edge), edge[np.minimum(nxt, len(edge) - 1)], len(at)) - first
        # a chunk owns the segments whose speaker lies in it
        spot = at[first] + low
        mine = (spot >= start) & (spot < end)
        first, count = first[mine], count[mine]
        if not len(first):
            return None
        speaker = mix(halves[at[first]])  # the least hashes are all small: mixed once more they spread over the buckets
        whole = (sums[first + count + least - 1] - sums[first]) * inverse[first]
        content = mix(mix(whole) + count.astype(U64) + mix((at[first] - first).astype(U64)))
        return speaker, content, first + low, count

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First of each different (speaker, content), in their order; each segment's place among them; how often each occurs."""
        order = np.lexsort((self.content, self.speaker))
        s, c = self.speaker[order], self.content[order]
        new = np.ones(len(order), bool)
        new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return order[new], place, np.bincount(place, minlength=int(new.sum()))


def _first_level(buckets: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack_id, rows in zip(batch["pack_id"].to_pylist(), batch["rows"].to_pylist(), strict=True):
                pack = Pack(rows, least)
                some, _, times = pack.distinct()
                speaker, content = pack.speaker[some], pack.content[some]
                edges = bucket_edges(speaker, buckets)
                for bucket in np.flatnonzero(np.diff(edges)):
                    cut = slice(edges[bucket], edges[bucket + 1])
                    block = {"speaker": [squeeze(speaker[cut])], "content": [squeeze(content[cut])], "several": [squeeze(times[cut] > 1)]}
                    yield pa.RecordBatch.from_pydict({"pack_id": [pack_id], "bucket": pa.array([bucket], pa.int32()), "block": [to_ipc(pa.table(block))]})

    return run


def _first_answer(blocks: list[bytes], most_segments: int) -> list[bytes]:
    asked = [from_ipc(b).to_pylist()[0] for b in blocks]
    sizes = [len(expand(a["several"], bool)) for a in asked]
    speaker, content, several = (np.concatenate([expand(a[k], t) for a in asked]) for k, t in (("speaker", U64), ("content", U64), ("several", bool)))
    order = np.lexsort((content, speaker))
    s, c = speaker[order], content[order]
    new_speaker = np.append(True, s[1:] != s[:-1])
    new = new_speaker | np.append(True, c[1:] != c[:-1])
    of_segment, of_speaker = np.cumsum(new) - 1, np.cumsum(new_speaker) - 1
    different = np.bincount(of_speaker[new])
    times = np.bincount(of_segment) + np.bincount(of_segment, several[order])
    kinds = different[of_speaker]
    code = np.where(times[of_segment] > 1, ALL, np.where(kinds == 1, ONCE, SOME))
    # a repeated segment of a speaker with others still has to be shown to the others
    code = np.where((code == ALL) & (kinds > 1), SOME + 4, code)
    code = np.where((kinds > most_segments) & ((code & 3) == SOME), code + (MANY - SOME), code)
    back = np.empty(len(order), np.uint8)
    back[order] = code
    return [squeeze(x) for x in np.split(back, np.cumsum(sizes)[:-1])]


def _second_level(pack_id: str, pack: Pack, code: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Segments that need a suffix array, by speaker, and windows of segments that are too many, by hash."""
    some, _, _ = pack.distinct()

    def out(bucket: int, block: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"pack_id": [pack_id], "bucket": pa.array([bucket], pa.int32()), "block": [to_ipc(pa.table(block))]})

    few = some[(code & 3) == SOME]
    edges = bucket_edges(pack.speaker[few], buckets)
    for bucket in np.flatnonzero(np.diff(edges)):
        mine = few[edges[bucket] : edges[bucket + 1]]
        texts = [pack.data[f : f + n + pack.least - 1].tobytes() for f, n in zip(pack.first[mine], pack.count[mine], strict=True)]
        keys = {"speaker": [squeeze(pack.speaker[mine])], "content": [squeeze(pack.content[mine])]}
        yield out(int(bucket), keys | {"texts": pa.array([texts], pa.list_(pa.binary()))})
    hashes, _, times = _window_hashes(pack, some[(code & 3) == MANY])
    edges = bucket_edges(hashes, buckets)
    for bucket in np.flatnonzero(np.diff(edges)):
        cut = slice(edges[bucket], edges[bucket + 1])
        yield out(buckets + int(bucket), {"hash": [squeeze(hashes[cut])], "several": [squeeze(times[cut] > 1)]})


def _window_hashes(pack: Pack, segments: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct window hashes of some segments, each segment's windows as places among them, and how often each occurs."""
    each = [windows(pack.data[pack.first[i] : pack.first[i] + pack.count[i] + pack.least - 1].astype(U64) + U64(1), pack.least) for i in segments]
    hashes, place, times = np.unique(np.concatenate([np.zeros(0, U64), *each]), return_inverse=True, return_counts=True)
    return hashes, np.split(place, np.cumsum([len(x) for x in each])[:-1]) if each else [], times


def _second_answer(blocks: list[bytes], least: int) -> list[bytes]:
    if "hash" in from_ipc(blocks[0]).column_names:
        asked = [from_ipc(b).to_pylist()[0] for b in blocks]
        hashes = [expand(a["hash"], U64) for a in asked]
        several = np.concatenate([expand(a["several"], bool) for a in asked])
        _, group, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        repeated = count > 1
        repeated[group[several]] = True
        return [squeeze(x) for x in np.split(repeated[group], np.cumsum([len(h) for h in hashes])[:-1])]
    tables = [from_ipc(b) for b in blocks]
    speaker = np.concatenate([expand(t.column("speaker")[0].as_py(), U64) for t in tables])
    content = np.concatenate([expand(t.column("content")[0].as_py(), U64) for t in tables])
    texts = pa.concat_arrays([t.column("texts").combine_chunks().flatten() for t in tables])
    sizes = [len(t.column("texts")[0]) for t in tables]
    # one text for each different segment; a speaker's segments stay together
    order = np.lexsort((content, speaker))
    s, c = speaker[order], content[order]
    new = np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]))
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    chosen, owner = order[new], s[new]
    # speakers with texts of like length side by side: an array takes as many rounds as its longest text has bytes
    length = pc.binary_length(texts).to_numpy()[chosen]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    longest = np.repeat(np.maximum.reduceat(length, first), np.diff(np.append(first, len(owner))))
    by_length = np.argsort(longest, kind="stable")
    chosen, owner = chosen[by_length], owner[by_length]
    place = np.empty(len(by_length), np.int64)
    place[by_length] = np.arange(len(by_length))
    which = place[which]
    bits: list[np.ndarray] = []
    at = 0
    while at < len(chosen):
        upto = min(len(chosen), at + COLLECTION)
        while upto < len(chosen) and owner[upto] == owner[upto - 1]:
            upto += 1
        data, offsets = flat(texts.take(pa.array(chosen[at:upto])))
        starts = repeated_starts(data, offsets, least)
        bits += [starts[a : b - least + 1] for a, b in zip(offsets, offsets[1:], strict=False)]
        at = upto
    counts = np.array([len(b) for b in bits])
    flat_bits = np.concatenate(bits)
    begin = np.cumsum(counts) - counts
    answers, at = [], 0
    for size in sizes:
        mine = which[at : at + size]
        at += size
        answers.append(squeeze(np.concatenate([flat_bits[begin[i] : begin[i] + counts[i]] for i in mine])))
    return answers


def _split(replies: pa.Table, level: int) -> pa.Table:
    return replies.filter(pc.equal(replies.column("level"), level))


def _joined(blocks: list[bytes], dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(expand(b, dtype) for b in blocks)])


def _repeated(pack: Pack, replies: pa.Table, buckets: int) -> np.ndarray:
    """For each byte of a pack whether the window that begins there is repeated."""
    some, place, _ = pack.distinct()
    code = _joined(in_order(_split(replies, 0)), np.uint8)
    second = _split(replies, 1)
    by_segment = second.filter(pc.less(second.column("bucket"), buckets))
    by_window = second.filter(pc.greater_equal(second.column("bucket"), buckets))
    bits, at = _joined(in_order(by_segment), bool), 0
    told = [np.zeros(0, bool)] * len(some)
    for i in np.flatnonzero((code & 3) == SOME):
        n = pack.count[some[i]]
        told[i] = bits[at : at + n]
        at += n
    many = np.flatnonzero((code & 3) == MANY)
    if len(many):
        _, places, _ = _window_hashes(pack, some[many])
        answer = _joined(in_order(by_window), bool)
        for i, where in zip(many, places, strict=True):
            told[i] = answer[where]
    kind = code[place]
    whole = (kind == ALL) | (kind >= 4)
    edge = np.zeros(len(pack.data) + 1, np.int32)
    edge[pack.first[whole]] += 1  # segments do not share their first windows
    np.add.at(edge, pack.first[whole] + pack.count[whole], -1)
    out = np.cumsum(edge)[:-1] > 0
    for i in np.flatnonzero(~whole & (kind != ONCE)):
        out[pack.first[i] : pack.first[i] + pack.count[i]] = told[place[i]]
    return out


def _spans(docs: DataFrame, least: int, pack_bytes: int, most_segments: int, finish, schema: str) -> DataFrame:
    spark = docs.sparkSession
    narrow = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    packs, _ = written_packs(narrow.mapInArrow(partial(packed, pack_bytes=pack_bytes), PACK_SCHEMA), "byte-packs")
    buckets = bucket_count(packs, "n_bytes", 8 << 20)
    whole, path = packs.select("pack_id", "rows"), scratch_path(spark, "segments")
    answer_schema = BLOCK_SCHEMA + ", level int"
    first = answered(whole.mapInArrow(_first_level(buckets, least), BLOCK_SCHEMA), partial(_first_answer, most_segments=most_segments))
    first.withColumn("level", F.lit(0)).write.parquet(path)
    known = spark.read.schema(answer_schema).parquet(path)
    arrow = pa.schema([("pack_id", pa.string()), ("bucket", pa.int32()), ("block", pa.binary())])

    def ask(pack: pa.Table, replies: pa.Table) -> pa.Table:
        (rows,), (pack_id,) = pack.column("rows").to_pylist(), pack.column("pack_id").to_pylist()
        code = _joined(in_order(replies), np.uint8)
        return pa.Table.from_batches(list(_second_level(pack_id, Pack(rows, least), code, buckets)), arrow)

    questions = whole.groupBy("pack_id").cogroup(known.groupBy("pack_id")).applyInArrow(ask, BLOCK_SCHEMA)
    second = answered(questions, partial(_second_answer, least=least))
    second.withColumn("level", F.lit(1)).write.mode("append").parquet(path)
    answers = spark.read.schema(answer_schema).parquet(path)

    def run(pack: pa.Table, replies: pa.Table) -> pa.Table:
        (rows,) = pack.column("rows").to_pylist()
        own = Pack(rows, least)
        sums = np.concatenate([np.zeros(least, np.int32), np.cumsum(_repeated(own, replies, buckets), dtype=np.int32)])
        return finish(own, sums[least:] > sums[:-least])

    return whole.groupBy("pack_id").cogroup(answers.groupBy("pack_id")).applyInArrow(run, schema)


def byte_report(docs: DataFrame, least: int = LEAST, pack_bytes: int = PACK_BYTES, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    A byte is removed if a string of ``least`` bytes over it starts anywhere else too, in the same text or
    in another row, copies of a row included. Strings do not cross texts. A null text is empty;
    texts shorter than ``least`` lose nothing; ids are only carried along, null or repeated.
    """

    def finish(own: Pack, removed: np.ndarray) -> pa.Table:
        sums = np.concatenate([[0], np.cumsum(removed)])
        begins = removed.copy()
        begins[1:] &= ~removed[:-1]
        border = own.offsets[:-1][own.offsets[:-1] < len(removed)]
        begins[border] = removed[border]
        runs = np.concatenate([[0], np.cumsum(begins)])
        digests = [hashlib.sha256(own.data[a:b][~removed[a:b]].tobytes()).hexdigest() for a, b in zip(own.offsets, own.offsets[1:], strict=False)]
        per = [np.diff(x[own.offsets]).astype(np.int64) for x in (sums, runs)]
        columns = [own.key, pa.array(np.diff(own.offsets)), pa.array(per[0]), pa.array(per[1]), pa.array(digests, pa.string())]
        return pa.table(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return _spans(docs, least, pack_bytes, most_segments, finish, schema)


def without_repeats(docs: DataFrame, least: int = LEAST, pack_bytes: int = PACK_BYTES, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(doc_id, bytes that are left, as binary: a cut may split a character, removed spans as (start, end) in bytes)."""

    def finish(own: Pack, removed: np.ndarray) -> pa.Table:
        kept, spans = [], []
        for a, b in zip(own.offsets, own.offsets[1:], strict=False):
            gone = removed[a:b]
            kept.append(own.data[a:b][~gone].tobytes())
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([own.key, pa.array(kept, pa.binary()), pa.array(spans, span)], names=["doc_id", "kept", "removed"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _spans(docs, least, pack_bytes, most_segments, finish, f"doc_id {id_type}, kept binary, removed array<struct<start:bigint,end:bigint>>")
