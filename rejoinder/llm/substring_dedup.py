"""Removal of repeated word passages by level-wise doubling (operator 2).

Whether a long window repeats is asked only where its half does. The first level asks for
windows of half the length, and for one of them in each long window: the least by its hash
among those the long window holds, which equal long windows choose alike. Where that half
occurs in one document only, the long window cannot repeat. The windows that are left are asked at
the full length, which decides what is removed. With ``extend`` the doubling goes on, from
windows repeated at one length to windows of twice that length that begin and end with one,
until none survives; this tells the longest repeat of each document. From here on only the
surviving places and their hashes travel, no texts: the hash of a window of twice the length is made of those of
its two halves.

Questions travel as sorted distinct hashes of a pack of documents, answers as one small number
for each, in the same order; so a passage that many documents share costs one entry for each pack.
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

from rejoinder.llm.columns import drop_path
from rejoinder.llm.packs import (
    BLOCK_SCHEMA, answered, bucket_count, bucket_edges, expand, from_ipc, in_order, new_pack_id, squeeze,
    to_ipc, written_packs,
)
from rejoinder.llm.text import BASE, BLANK_SEPARATED, U64, Words, flat, inside_text, least_of, mix, release, slices, windows
from rejoinder.session import scratch_path, written

WINDOW = 13
PACK_BYTES = 8 << 20
#: Words, windows or hashes looked at together inside a pack or a bucket; changes no result.
AT_ONCE = 1 << 17
#: Stands for a missing id; larger than every id.
NO_ID = np.iinfo(np.int64).max
PACK_SCHEMA = "pack_id string, n_bytes bigint, rows binary"

EARLIER, SHARED = 1, 2  # bits of an answer: in a document with a smaller id; in several documents


def packed(batches: Iterator[pa.RecordBatch], pack_bytes: int) -> Iterator[pa.RecordBatch]:
    """Packs of whole rows (key, text)."""

    def run(some: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(some).combine_chunks()
        return pa.RecordBatch.from_pydict({"pack_id": [new_pack_id()], "n_bytes": pa.array([size], pa.int64()), "rows": [to_ipc(table)]})

    waiting, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", pack_bytes // 4):
            waiting.append(part)
            size += int(flat(part.column("text"))[1][-1])
            if size >= pack_bytes:
                yield run(waiting, size)
                waiting, size = [], 0
    if waiting:
        yield run(waiting, size)


class Pack:
    """The words of a pack and the questions it asks at each level."""

    def __init__(self, rows: bytes):
        table = from_ipc(rows)
        ids = table.column("doc_id").combine_chunks()
        self.key = ids
        self.ids = ids.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.data, self.offsets = flat(table.column("text"))
        self.words = Words(self.data, self.offsets, BLANK_SEPARATED)
        self.owner = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.words.first))

    def windows(self, n: int) -> np.ndarray:
        """``windows`` of all words, made some at a time."""
        hashes = self.words.hash
        out = np.empty(max(0, len(hashes) - n + 1), U64)
        for a in range(0, len(out), AT_ONCE):
            out[a : a + AT_ONCE] = windows(hashes[a : a + AT_ONCE + n - 1], n)
        return out

    def halves(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of ``n`` words, and the place of the half window that speaks for each."""
        half = -(-n // 2)
        start = np.flatnonzero(inside_text(self.words.first, n)).astype(np.int32)
        self.half = self.windows(half)
        chosen = np.empty(max(0, len(self.half) - (n - half)), np.int32)
        for a in range(0, len(chosen), AT_ONCE):
            some = self.half[a : a + AT_ONCE + n - half]
            key = np.minimum(some >> U64(24), U64((1 << 39) - 1)) << U64(24)
            key |= np.arange(len(key), dtype=U64)  # of equal hashes the leftmost
            chosen[a : a + AT_ONCE] = a + (least_of(key, n - half + 1) & U64((1 << 24) - 1)).astype(np.int64)
        return start, chosen[start]

    def question(self, level: int, lengths: list[int], answers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each asked window, its start, place of its hash among the sorted distinct ones) of one level."""
        if level == 0:
            self.start, self.speaker = self.halves(lengths[1])
            speaks = np.zeros(len(self.half), bool)
            speaks[self.speaker] = True
            asked = np.flatnonzero(speaks).astype(np.int32)
            # speakers have small hashes, which would meet in the first buckets; mixed once more they are spread
            hashes = mix(self.half[asked])
            self.half = None
        else:
            _, before_start, before_place = self.asked[level - 1]
            shared = np.zeros(len(self.words), bool)
            shared[before_start[(answers[level - 1][before_place] & SHARED) > 0]] = True
            asked = self.start[shared[self.speaker]]
            hashes = self.windows(lengths[level])[asked]
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(_first_of_equals(hashes[order]), dtype=np.int32) - 1
        return hashes, asked, place

    def ask(self, lengths: list[int], answers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The question after the given answers: sorted distinct hashes, the smallest id of each, whether several documents hold it."""
        self.asked = []
        for level in range(len(answers) + 1):
            self.asked.append(self.question(level, lengths, answers))
        hashes, start, place = self.asked[-1]
        if not len(start):
            return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, bool)
        order = np.argsort(place)
        edge = np.flatnonzero(_first_of_equals(place[order]))
        owner = self.owner[start[order]]
        several = np.minimum.reduceat(owner, edge) < np.maximum.reduceat(owner, edge)
        return hashes[order[edge]], np.minimum.reduceat(self.ids[owner], edge), several


def _first_of_equals(values: np.ndarray) -> np.ndarray:
    """For sorted values: whether each is the first of its kind."""
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return first


def _blocks(pack_id: str, asked: tuple[np.ndarray, np.ndarray, np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    hashes, least, several = asked
    edges = bucket_edges(hashes, buckets)
    for bucket in np.flatnonzero(np.diff(edges)):
        cut = slice(edges[bucket], edges[bucket + 1])
        block = to_ipc(pa.table({"hash": [squeeze(hashes[cut])], "least": [squeeze(least[cut])], "several": [squeeze(several[cut])]}))
        yield pa.RecordBatch.from_pydict({"pack_id": [pack_id], "bucket": pa.array([bucket], pa.int32()), "block": [block]})


def _answer(blocks: list[bytes]) -> list[bytes]:
    """For each hash asked: whether a document with a smaller id than any of the asking pack's holds it, and whether several do."""
    asked = [from_ipc(b).to_pylist()[0] for b in blocks]
    hashes = [expand(a["hash"], np.uint64) for a in asked]
    least = [expand(a["least"], np.int64) for a in asked]
    several = [expand(a["several"], bool) for a in asked]
    codes = [np.empty(len(h), np.uint8) for h in hashes]
    for cuts in _ranges(hashes):
        code = _coded(*(np.concatenate([part[cut] for part, cut in zip(x, cuts, strict=True)]) for x in (hashes, least, several)))
        ends = np.cumsum([cut.stop - cut.start for cut in cuts])
        for own, cut, end in zip(codes, cuts, ends, strict=True):
            own[cut] = code[end - (cut.stop - cut.start) : end]
    return [squeeze(own) for own in codes]


def _ranges(hashes: list[np.ndarray]) -> Iterator[list[slice]]:
    """Where each of equal ranges of the hash lies in each of the sorted arrays; a range has about ``AT_ONCE`` hashes of all arrays."""
    ranges = -(-sum(map(len, hashes)) // AT_ONCE)
    low, high = int(min(h[0] for h in hashes)), int(max(h[-1] for h in hashes))
    inner = np.array([low + (high - low) * k // ranges for k in range(1, ranges)], U64)
    begin = [0] * len(hashes)
    for upper in inner:
        end = [int(np.searchsorted(h, upper)) for h in hashes]
        yield list(map(slice, begin, end))
        begin = end
    yield list(map(slice, begin, map(len, hashes)))


def _coded(hashes: np.ndarray, least: np.ndarray, several: np.ndarray) -> np.ndarray:
    _, group, count = np.unique(hashes, return_inverse=True, return_counts=True)
    smallest = np.full(len(count), NO_ID)
    np.minimum.at(smallest, group, least)
    shared = count > 1
    shared[group[several]] = True
    return ((smallest[group] < least) * EARLIER + shared[group] * SHARED).astype(np.uint8)


def _codes(replies: pa.Table, level: int) -> np.ndarray:
    mine = replies.filter(pc.equal(replies.column("level"), level))
    blocks = [expand(b, np.uint8) for b in in_order(mine)]
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)


def _levels(docs: DataFrame, window: int, pack_bytes: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Packs, the answers at half the window and at the window (written), and these two lengths."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    packs, _ = written_packs(narrow.mapInArrow(partial(packed, pack_bytes=pack_bytes), PACK_SCHEMA), "word-packs")
    buckets = bucket_count(packs, "n_bytes")
    lengths, path = [-(-window // 2), window], scratch_path(spark, "levels")
    schema = BLOCK_SCHEMA + ", level int"
    whole = packs.select("pack_id", "rows")
    for level in range(2):
        if level == 0:
            questions = whole.mapInArrow(_first_questions(lengths, buckets), BLOCK_SCHEMA)
        else:
            known = spark.read.schema(schema).parquet(path)
            questions = whole.groupBy("pack_id").cogroup(known.groupBy("pack_id")).applyInArrow(_later_questions(lengths, level, buckets), BLOCK_SCHEMA)
        answered(questions, _answer).withColumn("level", F.lit(level)).write.mode("append").parquet(path)
    return packs, spark.read.schema(schema).parquet(path), lengths


def _first_questions(lengths: list[int], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack_id, rows in zip(batch["pack_id"].to_pylist(), batch["rows"].to_pylist(), strict=True):
                yield from _blocks(pack_id, Pack(rows).ask(lengths, []), buckets)
                release()

    return run


def _later_questions(lengths: list[int], level: int, buckets: int):
    arrow = pa.schema([("pack_id", pa.string()), ("bucket", pa.int32()), ("block", pa.binary())])

    def run(pack: pa.Table, replies: pa.Table) -> pa.Table:
        out = [
            batch
            for pack_id, rows in zip(pack.column("pack_id").to_pylist(), pack.column("rows").to_pylist(), strict=True)
            for batch in _blocks(pack_id, Pack(rows).ask(lengths, [_codes(replies, k) for k in range(level)]), buckets)
        ]
        release()
        return pa.Table.from_batches(out, arrow)

    return run


def _decided(own: Pack, pack_id: str, codes: list[np.ndarray], lengths: list[int]) -> tuple[Pack, np.ndarray, str, Windows]:
    """A pack, whether each of its words is removed, its id, and its windows that another row shares."""
    _, least, _ = own.ask(lengths, codes[:1])
    hashes, start, place = own.asked[1]
    own.start = own.speaker = own.asked = None
    code = codes[1][place]
    # a pack's smallest holder is not covered unless a document outside the pack comes earlier
    gone = start[((code & EARLIER) > 0) | (own.ids[own.owner[start]] > least[place])]
    covered = np.zeros(len(own.words) + 1, np.int32)
    covered[gone] += 1  # every window has its own start
    covered[gone + lengths[1]] -= 1
    np.cumsum(covered, out=covered)
    repeated = (code & SHARED) > 0
    at = start[repeated].astype(np.int64)
    return own, covered[:-1] > 0, pack_id, (at, own.owner[at], hashes[repeated])


def _result(packs: DataFrame, answers: DataFrame, lengths: list[int], finish, schema: str) -> DataFrame:
    def run(pack: pa.Table, replies: pa.Table) -> pa.Table:
        ((pack_id, rows),) = zip(pack.column("pack_id").to_pylist(), pack.column("rows").to_pylist(), strict=True)
        told = finish(*_decided(Pack(rows), pack_id, [_codes(replies, k) for k in range(2)], lengths))
        release()
        return told

    return packs.select("pack_id", "rows").groupBy("pack_id").cogroup(answers.groupBy("pack_id")).applyInArrow(run, schema)


#: Windows of one pack: where they start (in words of the pack), in which of its rows, and their hashes.
Windows = tuple[np.ndarray, np.ndarray, np.ndarray]
WINDOWS_SCHEMA = "n_bytes bigint, start binary, owner binary, hash binary"


def _twice(repeated: Windows, length: int) -> Windows:
    """The windows of twice ``length`` that begin and end with one of the given; a window's hash is made of its halves' hashes."""
    start, owner, hashes = repeated
    if not len(start):
        return repeated
    at = np.minimum(np.searchsorted(start, start + length), len(start) - 1)
    first = np.flatnonzero((start[at] == start + length) & (owner[at] == owner))
    return start[first], owner[first], mix(hashes[first] * BASE + mix(hashes[at[first]]))


def _stored(some: Windows) -> dict[str, list]:
    start, owner, hashes = some
    return {"n_bytes": [8 * len(start)], "start": [squeeze(start)], "owner": [squeeze(owner.astype(np.int32))], "hash": [squeeze(hashes)]}


def _read(row: dict) -> Windows:
    return expand(row["start"], np.int64), expand(row["owner"], np.int32).astype(np.int64), expand(row["hash"], np.uint64)


def _window_questions(buckets: int):
    """Sorted distinct hashes of each pack's windows and whether several of its rows hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, owner, hashes = _read(row)
                distinct, place = np.unique(hashes, return_inverse=True)
                low, high = np.full(len(distinct), NO_ID), np.full(len(distinct), -1)
                np.minimum.at(low, place, owner)
                np.maximum.at(high, place, owner)
                yield from _blocks(row["pack_id"], (distinct, np.zeros(len(distinct), np.int64), low < high), buckets)

    return run


def _survivors(length: int):
    """The rows of a pack that share a window of ``length``, and their windows of twice that length."""
    arrow = pa.schema(
        [("pack_id", pa.string()), ("held_by", pa.list_(pa.int64())), ("n_bytes", pa.int64()), ("start", pa.binary()), ("owner", pa.binary()), ("hash", pa.binary())]
    )

    def run(asked: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        blocks = [expand(b, np.uint8) for b in in_order(replies)]
        code = np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)
        for row in asked.to_pylist():
            some = _read(row)
            repeated = (code[np.unique(some[2], return_inverse=True)[1]] & SHARED) > 0
            kept = tuple(part[repeated] for part in some)
            told = {"pack_id": [row["pack_id"]], "held_by": [np.unique(kept[1]).tolist()], **_stored(_twice(kept, length))}
            out.append(pa.table(told, arrow))
        return pa.concat_tables(out) if out else arrow.empty_table()

    return run


def _longest(first: DataFrame, window: int) -> DataFrame:
    """(pack_id, row, length): the largest length of the ladder above ``window`` that a row shares, for the rows that share one.

    ``first`` has the windows of twice ``window``. Each round writes what survives to the shared folder; the
    number of rounds is the logarithm of the longest repeat.
    """
    spark = first.sparkSession
    path, length, asked = scratch_path(spark, "ladder"), 2 * window, first.where("n_bytes > 0")
    found = None
    while not asked.isEmpty():
        buckets = bucket_count(asked, "n_bytes")
        replies = answered(asked.mapInArrow(_window_questions(buckets), BLOCK_SCHEMA), _answer)
        schema = f"pack_id string, held_by array<bigint>, {WINDOWS_SCHEMA}"
        told = asked.groupBy("pack_id").cogroup(replies.groupBy("pack_id")).applyInArrow(_survivors(length), schema)
        told.write.parquet(f"{path}/{length}")
        told = spark.read.schema(schema).parquet(f"{path}/{length}")
        rows = told.select("pack_id", F.explode("held_by").alias("row"), F.lit(length).cast("bigint").alias("length"))
        found = rows if found is None else found.unionByName(rows)
        asked, length = told.select("pack_id", "n_bytes", "start", "owner", "hash").where("n_bytes > 0"), 2 * length
    if found is None:
        return spark.createDataFrame([], "pack_id string, row bigint, length bigint")
    return found.groupBy("pack_id", "row").agg(F.max("length").alias("length"))


def _kept_texts(own: Pack, removed: np.ndarray) -> Iterator[memoryview]:
    """The kept words of each text, joined by one blank."""
    w = own.words
    kept = np.flatnonzero(~removed)
    first = np.searchsorted(kept, w.first)
    data = own.data
    for a, b in zip(first, first[1:], strict=False):
        if a == b:
            yield memoryview(b"")
            continue
        size = w.end[kept[a:b]] - w.start[kept[a:b]]
        out, filled = np.full(int(size.sum()) + int(b - a) - 1, 32, np.uint8), 0
        for at in range(a, b, AT_ONCE):
            mine = kept[at : min(b, at + AT_ONCE)]
            start, length = w.start[mine], w.end[mine] - w.start[mine]
            begin = filled + np.cumsum(length + 1) - (length + 1)
            shift = np.repeat(begin - start, length)
            source = np.arange(len(shift)) + np.repeat(start - (np.cumsum(length) - length), length)
            out[source + shift] = data[source]
            filled = int(begin[-1] + length[-1]) + 1
        yield memoryview(out)


def passage_report(docs: DataFrame, window: int = WINDOW, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, longest_repeat) for every row of ``docs``.

    A word is removed if a window of ``window`` words over it also starts in a document with a
    smaller id. Null ids count as larger than all others, and rows with one id as one document
    that removes nothing from itself. Null and empty texts have no words; texts shorter than a
    window lose none. ``longest_repeat`` is the largest of the lengths ``window``, twice, four times it and so on
    of which the row shares a window with another row, 0 if none.
    """
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "longest_repeat"]

    def finish(own: Pack, removed: np.ndarray, pack_id: str, repeated: Windows) -> pa.Table:
        count = np.diff(own.words.first)
        lost = np.diff(np.concatenate([[0], np.cumsum(removed)])[own.words.first])
        digest = [hashlib.sha256(text).hexdigest() for text in _kept_texts(own, removed)]
        longest = np.zeros(len(count), np.int64)
        longest[repeated[1]] = window
        rows = pa.table([own.key, pa.array(count), pa.array(lost.astype(np.int64)), pa.array(digest, pa.string()), pa.array(longest)], names=names)
        rows = rows.append_column("pack_id", pa.array([pack_id] * len(count), pa.string())).append_column("row", pa.array(np.arange(len(count))))
        ladder = pa.table({"pack_id": [pack_id], **_stored(_twice(repeated, window))})
        return pa.concat_tables([rows, ladder], promote_options="default").select([*names, "pack_id", "row", "n_bytes", "start", "owner", "hash"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string, longest_repeat bigint, pack_id string, row bigint"
    told = written(_result(*_levels(docs, window, pack_bytes), finish, f"{columns}, {WINDOWS_SCHEMA}"), "passages")
    longer = _longest(told.where("row IS NULL").select("pack_id", "n_bytes", "start", "owner", "hash"), window)
    return (
        told.where("row IS NOT NULL").select(*names, "pack_id", "row").join(longer, ["pack_id", "row"], "left")
        .select(*names[:-1], F.coalesce("length", "longest_repeat").alias("longest_repeat"))
    )


def without_passages(docs: DataFrame, window: int = WINDOW, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(doc_id, text) with the words that are left, joined by one blank."""

    def finish(own: Pack, removed: np.ndarray, pack_id: str, repeated: Windows) -> pa.Table:
        texts = [bytes(t).decode() for t in _kept_texts(own, removed)]
        return pa.table([own.key, pa.array(texts, pa.string())], names=["doc_id", "text"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _result(*_levels(docs, window, pack_bytes), finish, f"doc_id {id_type}, text string")
