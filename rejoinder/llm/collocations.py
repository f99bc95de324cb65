"""Phrases of two to five words that occur together more often than their parts explain.

Direct-address tiling, the same step for every length. Words that are frequent enough to be part of
a candidate are numbered by frequency. Two neighbours in a text are a cell of a matrix of numbers, which
is cut into tiles of at most 2^24 cells: narrow ones for the frequent numbers, wide ones for the rare. A
pack of documents counts its cells and sends one block for each tile; tiles that many packs fill are
added up in a dense array, the others as sorted coordinates. The cells that reach the least count are
numbered by frequency again and take the place of the words, so that two neighbours are now two
overlapping phrases, which together are the phrase one word longer.

A pack is a run of whole rows of one input partition, written once under an id of its own. It asks for the
numbers of its distinct words in the same way: one block for each bucket of words. Its blocks and the answers to
them never hold more entries than the pack has words. A tile or bucket is added up by groups of ``FAN_IN``
packs, then by groups of such sums, so that no task reads more than that many blocks.

Nulls: a null or empty text has no words, a null language is ``und``; other columns are not read. Repeated
rows count each time, ties are broken by the phrase, an empty table gives an empty table. Counts are exact
and of all documents: words and cells are compared by their content, not by hashes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import drop_path
from rejoinder.llm.packs import from_ipc, to_ipc
from rejoinder.llm.text import flat, slices
from rejoinder.operators.joins import top_per_merged
from rejoinder.operators.ordinals import with_ordinal
from rejoinder.session import scratch_path, written

LEAST_COUNT = 100
MOST_WORDS = 5
KEPT = 2000

PACK_BYTES = 16 << 20
CHUNK_BYTES = 2 << 20
#: Blocks of one tile or bucket that a task adds up.
FAN_IN = 64
#: Words of all packs, counted once for each pack, that fall into one bucket.
BUCKET_WORDS = 500_000

#: Kinds of bytes: 0 belongs to a word, 1 separates words, 2 ends a piece.
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = 1
KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

PACK_SCHEMA = "pack string, lang string, n_words bigint, words array<string>, counts array<bigint>, block binary"
STEP_SCHEMA = "kind int, pack string, lang string, row_band int, col_band int, block binary"
WORD_SCHEMA = "pack string, lang string, bucket int, block binary"
CELL_SCHEMA = "lang string, x bigint, y bigint, a bigint"
ANSWER_SCHEMA = "pack string, lang string, block binary"


def _pressed(*arrays: np.ndarray) -> bytes:
    """Arrays of natural numbers, or -1, in the least width that holds them."""
    parts = []
    for a in arrays:
        top, low = int(a.max(initial=0)), int(a.min(initial=0))
        kind = next(k for k in (("i1", "i2", "i4", "i8") if low < 0 else ("u1", "u2", "u4", "i8")) if top <= np.iinfo(k).max)
        raw = np.ascontiguousarray(np.ascontiguousarray(a.astype(kind)).view(np.uint8).reshape(len(a), np.dtype(kind).itemsize).T).tobytes()
        parts.append(kind.encode() + len(raw).to_bytes(8, "little") + raw)
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=2).compress(raw, asbytes=True)


def _unpressed(block: bytes) -> list[np.ndarray]:
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 0
    while at < len(raw):
        kind, size = np.dtype(raw[at : at + 2].decode()), int.from_bytes(raw[at + 2 : at + 10], "little")
        planes = np.frombuffer(raw, np.uint8, size, at + 10).reshape(kind.itemsize, size // kind.itemsize)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind).astype(np.int64))
        at += 10 + size
    return out


def _chunks(data: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of about ``CHUNK_BYTES`` that end with a separator or the text; a longer word is not cut."""
    at = 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data) and KINDS[data[end - 1]] == 0:
            gap = np.flatnonzero(KINDS[data[end : end + CHUNK_BYTES]])
            end = min(len(data), end + (int(gap[0]) + 1 if len(gap) else CHUNK_BYTES))
        yield data[at:end]
        at = end


def numbered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some texts, and their places in all texts in turn, -1 between two pieces."""
    ended = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_binary()), b""), pa.scalar(b".", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    data = LOWER[flat(ended)[0]]
    words, pieces, before = [], [], 0
    for chunk in _chunks(data):
        kind = KINDS[chunk]
        inside = kind == 0
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        stops = np.flatnonzero(kind == 2)
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        letters = np.ascontiguousarray(chunk[inside])
        words.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]))
        pieces.append(before + np.searchsorted(stops, start))
        before += len(stops)
    if not sum(map(len, words)):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    coded = pa.chunked_array(words).dictionary_encode().combine_chunks()
    codes, piece = coded.indices.to_numpy(zero_copy_only=False), np.concatenate(pieces)
    order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")  # small numbers for frequent words
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    codes = place_of[codes]
    cut = np.diff(piece, prepend=piece[:1]) != 0
    places = np.full(len(codes) + int(cut.sum()), -1, np.int64)
    places[np.arange(len(codes)) + np.cumsum(cut)] = codes
    return coded.dictionary.take(pa.array(order)), places


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = pc.fill_null(table.column("lang").cast(pa.string()), "und")
        pack = uuid.uuid4().hex
        for lang in pc.unique(langs).to_pylist():
            texts = table.column("text").filter(pc.equal(langs, lang)).combine_chunks()
            words, places = numbered_words(texts)
            counts = np.bincount(places[places >= 0], minlength=len(words))
            yield pa.RecordBatch.from_pydict(
                {
                    "pack": [pack], "lang": [lang], "n_words": [int(counts.sum())],
                    "words": pa.ListArray.from_arrays([0, len(words)], words.cast(pa.large_string()).cast(pa.string())),
                    "counts": pa.ListArray.from_arrays([0, len(words)], pa.array(counts, pa.int64())),
                    "block": pa.array([_pressed(places)], pa.binary()),
                }
            )

    waiting, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", PACK_BYTES // 4):
            waiting.append(part)
            size += pc.sum(pc.fill_null(pc.binary_length(part.column("text")), 0)).as_py() or 0
            if size >= PACK_BYTES:
                yield from rows(pa.Table.from_batches(waiting))
                waiting, size = [], 0
    if waiting:
        yield from rows(pa.Table.from_batches(waiting))


def bands(x: np.ndarray) -> np.ndarray:
    """The strip of the matrix that a number falls in: 1024, 1024, 2048 and then 4096 numbers wide."""
    return np.where(x < 2048, x >> 10, np.where(x < 4096, 2, 2 + (x >> 12)))


def band_start(band: np.ndarray | int) -> np.ndarray:
    return np.where(np.asarray(band) < 2, np.asarray(band) << 10, np.where(np.asarray(band) == 2, 2048, (np.asarray(band) - 2) << 12))


def band_width(band: np.ndarray | int) -> np.ndarray:
    return np.where(np.asarray(band) < 2, 1024, np.where(np.asarray(band) == 2, 2048, 4096))


def cell_counts(places: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cells of neighbours by tile: (row band, column band, ascending cells, counts)."""
    x, y = places[:-1], places[1:]
    both = (x >= 0) & (y >= 0)
    x, y = x[both], y[both]
    head = (x < 1024) & (y < 1024)
    if head.any():  # the tile that nearly every pack fills
        full = np.bincount((x[head] << 10) | y[head], minlength=1 << 20)
        cells = np.flatnonzero(full)
        yield 0, 0, cells, full[cells]
        x, y = x[~head], y[~head]
    if not len(x):
        return
    row, col = bands(x), bands(y)
    wide = int(col.max()) + 1
    cell = (x - band_start(row)) * band_width(col) + (y - band_start(col))
    keys, counts = np.unique(((row * wide + col) << 24) | cell, return_counts=True)
    tile = keys >> 24
    for part in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(tile)) + 1):
        t = int(tile[part[0]])
        yield t // wide, t % wide, keys[part] & ((1 << 24) - 1), counts[part]


def added(blocks: list[bytes], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of blocks of one tile of ``cells`` cells: dense where they fill it, else sorted coordinates."""
    parts = [_unpressed(b) for b in blocks]
    if 8 * sum(len(p[0]) for p in parts) >= cells:
        full = np.zeros(cells, np.int64)
        for steps, counts in parts:
            full[np.cumsum(steps)] += counts  # the cells of one block are distinct
        at = np.flatnonzero(full)
        return at, full[at]
    at = np.concatenate([np.cumsum(p[0]) for p in parts])
    order = np.argsort(at, kind="stable")
    at, counts = at[order], np.concatenate([p[1] for p in parts])[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], np.add.reduceat(counts, first)


def _block(cells: np.ndarray, counts: np.ndarray) -> bytes:
    return _pressed(np.diff(cells, prepend=0), counts)


def _next_step(pack: str, lang: str, places: np.ndarray) -> pa.Table:
    """A pack with its new numbers (kind 0) and what it asks of each tile (kind 1); nothing if no two numbers meet."""
    rows = [(1, pack, lang, r, c, _block(cells, counts)) for r, c, cells, counts in cell_counts(places)]
    if rows:
        rows.append((0, pack, lang, -1, -1, _pressed(places)))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["kind", "pack", "lang", "row_band", "col_band", "block"])


def _worded(pack: pa.Table, told: pa.Table) -> pa.Table:
    """Word places to numbers of frequent words."""
    if not pack.num_rows:
        return _next_step("", "", np.zeros(0, np.int64))
    places = _unpressed(pack.column("block")[0].as_py())[0]
    number = np.full(int(places.max(initial=-1)) + 2, -1, np.int64)  # the last stays -1, for the gaps
    for block in told.column("block").to_pylist():
        at, ids = _unpressed(block)
        number[at] = ids
    return _next_step(pack.column("pack")[0].as_py(), pack.column("lang")[0].as_py(), number[places])


def _renumbered(pack: pa.Table, told: pa.Table) -> pa.Table:
    """Pairs of numbers to numbers of frequent pairs; a place gets the number of the pair that starts there."""
    if not pack.num_rows or not told.num_rows:
        return _next_step("", "", np.zeros(0, np.int64))
    places = _unpressed(pack.column("block")[0].as_py())[0]
    x, y, number = (np.concatenate(c) for c in zip(*(_unpressed(b) for b in told.column("block").to_pylist()), strict=True))
    wide = int(places.max(initial=0)) + 1
    order = np.argsort(x * wide + y)
    keys, number = (x * wide + y)[order], number[order]
    asked = np.where((places[:-1] >= 0) & (places[1:] >= 0), places[:-1] * wide + places[1:], -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return _next_step(pack.column("pack")[0].as_py(), pack.column("lang")[0].as_py(), np.where(keys[at] == asked, number[at], -1))


def _step(packs: DataFrame, told: DataFrame, move) -> tuple[DataFrame, DataFrame, str]:
    """Packs with new numbers, and their questions, written once."""
    spark = packs.sparkSession
    keys = ["pack", "lang"]
    path = scratch_path(spark, "collocation-step")
    own = packs.select("pack", "lang", "block").toDF(*keys, "block")  # new column identities: the answers may come from the same table
    both = own.groupBy(*keys).cogroup(told.toDF(*told.columns).groupBy(*keys)).applyInArrow(move, STEP_SCHEMA)
    both.write.partitionBy("kind").parquet(path)
    table = spark.read.schema(STEP_SCHEMA).parquet(path)
    return table.where("kind = 0").drop("kind", "row_band", "col_band"), table.where("kind = 1").drop("kind"), path


def _word_questions(packs: DataFrame, buckets: int) -> DataFrame:
    """For every pack and bucket of words: the words with their places and counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, lang, words, counts in zip(*(batch.column(c) for c in ("pack", "lang", "words", "counts")), strict=True):
                words = words.values
                if not words:
                    continue
                bucket = (np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.int64) * buckets) >> 32
                table = pa.table({"word": words, "n": counts.values, "place": pa.array(np.arange(len(words)), pa.int32())})
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                found = [(b, order[lo:hi]) for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)) if hi > lo]
                blocks = [to_ipc(table.take(pa.array(rows)).sort_by("word")) for _, rows in found]
                yield pa.RecordBatch.from_pydict(
                    {"pack": [pack.as_py()] * len(found), "lang": [lang.as_py()] * len(found), "bucket": pa.array([b for b, _ in found], pa.int32()), "block": pa.array(blocks, pa.binary())}
                )

    return packs.select("pack", "lang", "words", "counts").mapInArrow(ask, WORD_SCHEMA)


def _word_sums(blocks: list[bytes]) -> pa.Table:
    tables = [from_ipc(b).select(["word", "n"]) for b in blocks]
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _by_rounds(asked: DataFrame, keys: list[str], add: Callable[[list[bytes], pa.Table], bytes], last: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """The blocks of each of ``keys`` put together by ``FAN_IN``, as often as it takes, and then by ``last``."""
    salts = _salts(asked)
    sums = asked.select(*keys, F.pmod(F.xxhash64("pack"), F.lit(salts)).alias("part"), "block")
    inner = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sums.schema)

    def partial(table: pa.Table) -> pa.Table:
        return table.select([*keys, "part"]).slice(0, 1).append_column("block", pa.array([add(table.column("block").to_pylist(), table)], pa.binary()))

    while salts > 1:
        sums = sums.groupBy(*keys, "part").applyInArrow(partial, inner)
        salts = -(-salts // FAN_IN)
        sums = sums.withColumn("part", F.pmod("part", F.lit(salts)))
    return sums.groupBy(*keys).applyInArrow(last, schema)


def _salts(asked: DataFrame) -> int:
    return max(1, -(-asked.select("pack").distinct().count() // FAN_IN))


def _frequent_words(asked: DataFrame, least: int) -> DataFrame:
    """(lang, word, a) of all words with a >= least."""

    def last(table: pa.Table) -> pa.Table:
        sums = _word_sums(table.column("block").to_pylist())
        sums = sums.filter(pc.greater_equal(sums.column("n"), least))
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * sums.num_rows, pa.string()), "word": sums.column("word"), "a": sums.column("n")})

    return _by_rounds(asked, ["lang", "bucket"], lambda blocks, _: to_ipc(_word_sums(blocks)), last, "lang string, word string, a bigint")


def _word_answers(asked: DataFrame, ranked: DataFrame, buckets: int) -> DataFrame:
    """To every pack, of each bucket it asked, the places and numbers of its frequent words."""
    salts = _salts(asked)
    bucket = F.shiftright(F.crc32("word") * F.lit(buckets).cast("bigint"), 32).cast("int")
    known = ranked.select("lang", bucket.alias("bucket"), "word", "id").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    keys = ["lang", "bucket", "part"]

    def tell(asking: pa.Table, frequent: pa.Table) -> pa.Table:
        out = {"pack": [], "lang": [], "block": []}
        if asking.num_rows and frequent.num_rows:
            words, number = frequent.column("word").combine_chunks(), frequent.column("id").to_numpy()
            for pack, lang, block in zip(*(asking.column(c).to_pylist() for c in ("pack", "lang", "block")), strict=True):
                own = from_ipc(block)
                at = pc.index_in(own.column("word"), value_set=words)
                hit = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
                if len(hit):
                    out["pack"].append(pack)
                    out["lang"].append(lang)
                    ids = number[pc.fill_null(at, 0).to_numpy(zero_copy_only=False)[hit]]
                    out["block"].append(_pressed(own.column("place").to_numpy()[hit].astype(np.int64), ids))
        return pa.table({"pack": pa.array(out["pack"], pa.string()), "lang": pa.array(out["lang"], pa.string()), "block": pa.array(out["block"], pa.binary())})

    asking = asked.withColumn("part", F.pmod(F.xxhash64("pack"), F.lit(salts)))
    return asking.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(tell, ANSWER_SCHEMA)


def _cells_of(row_band: int, col_band: int) -> int:
    return int(band_width(row_band)) * int(band_width(col_band))


def _tile(table: pa.Table) -> tuple[str, int, int]:
    return table.column("lang")[0].as_py(), table.column("row_band")[0].as_py(), table.column("col_band")[0].as_py()


def _frequent_cells(asked: DataFrame, least: int) -> DataFrame:
    """(lang, x, y, a) of all cells with a >= least, added up by groups of ``FAN_IN`` blocks, then of sums."""

    def add(blocks: list[bytes], table: pa.Table) -> bytes:
        _, r, c = _tile(table)
        return _block(*added(blocks, _cells_of(r, c)))

    def last(table: pa.Table) -> pa.Table:
        lang, r, c = _tile(table)
        cells, counts = added(table.column("block").to_pylist(), _cells_of(r, c))
        cells, counts = cells[counts >= least], counts[counts >= least]
        x, y = band_start(r) + cells // int(band_width(c)), band_start(c) + cells % int(band_width(c))
        return pa.table({"lang": pa.array([lang] * len(x), pa.string()), "x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64()), "a": pa.array(counts, pa.int64())})

    return _by_rounds(asked, ["lang", "row_band", "col_band"], add, last, CELL_SCHEMA)


def _ranked(counted: DataFrame, ties: list[str]) -> DataFrame:
    """``id``: the rank in its language by count from 0, ties by ``ties``."""
    placed = with_ordinal(counted, [F.asc("lang"), F.desc("a"), *(F.asc(c) for c in ties)])
    first = placed.groupBy("lang").agg(F.min("ordinal").alias("first"))
    return placed.join(first, "lang").withColumn("id", F.col("ordinal") - F.col("first")).drop("ordinal", "first")


def _answers(asked: DataFrame, ranked: DataFrame) -> DataFrame:
    """To every pack, of each tile it asked, the cells it has that are frequent: (x, y, id) as one block."""
    salts = _salts(asked)
    band = lambda c: F.when(F.col(c) < 2048, F.shiftright(c, 10)).when(F.col(c) < 4096, 2).otherwise(2 + F.shiftright(c, 12)).cast("int")
    known = ranked.select("lang", band("x").alias("row_band"), band("y").alias("col_band"), "x", "y", "id")
    known = known.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    keys = ["lang", "row_band", "col_band", "part"]

    def tell(asking: pa.Table, frequent: pa.Table) -> pa.Table:
        out = {"pack": [], "lang": [], "block": []}
        if asking.num_rows and frequent.num_rows:
            lang, r, c = _tile(asking)
            x, y, number = (frequent.column(k).to_numpy() for k in ("x", "y", "id"))
            cell = (x - band_start(r)) * int(band_width(c)) + (y - band_start(c))
            order = np.argsort(cell)
            cell, x, y, number = cell[order], x[order], y[order], number[order]
            for pack, block in zip(asking.column("pack").to_pylist(), asking.column("block").to_pylist(), strict=True):
                own = np.cumsum(_unpressed(block)[0])
                at = np.minimum(np.searchsorted(cell, own), len(cell) - 1)
                at = at[cell[at] == own]
                if len(at):
                    out["pack"].append(pack)
                    out["lang"].append(lang)
                    out["block"].append(_pressed(x[at], y[at], number[at]))
        return pa.table({"pack": pa.array(out["pack"], pa.string()), "lang": pa.array(out["lang"], pa.string()), "block": pa.array(out["block"], pa.binary())})

    asking = asked.withColumn("part", F.pmod(F.xxhash64("pack"), F.lit(salts)))
    return asking.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(tell, ANSWER_SCHEMA)


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = MOST_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """Words counted per language, and for each length from 1 its frequent phrases.

    The first is (lang, n). A phrase is (lang, id, phrase, a, fronts, backs, x, y): the counts of its first 1, 2, ... words
    and of its last 1, 2, ... words, and the ids of the two phrases one word shorter.
    """
    spark = docs.sparkSession
    packs = written(docs.select("lang", "text").mapInArrow(_packed, PACK_SCHEMA), "collocation-packs")
    totals = packs.groupBy("lang").agg(F.sum("n_words").alias("n"))
    buckets = max(1, -(-(packs.agg(F.sum(F.size("words"))).first()[0] or 0) // BUCKET_WORDS))
    asked = written(_word_questions(packs, buckets), "collocation-words")
    ranked = written(_ranked(_frequent_words(asked, least), ["word"]), "collocation-words")
    told = _word_answers(asked, ranked, buckets)
    levels = [
        ranked.select(
            "lang", "id", F.col("word").alias("phrase"), "a", F.array("a").alias("fronts"), F.array("a").alias("backs"),
            F.lit(None).cast("bigint").alias("x"), F.lit(None).cast("bigint").alias("y"),
        )
    ]
    move, old = _worded, None
    for length in range(2, longest + 1):
        packs, asked, path = _step(packs, told, move)
        if old:
            drop_path(spark, old)
        old, move = path, _renumbered
        ranked = written(_ranked(_frequent_cells(asked, least), ["x", "y"]), "collocation-cells")
        levels.append(written(_spelled(ranked, levels[-1]), "collocation-phrases"))
        if length < longest:
            told = _answers(asked, ranked)
    if old:
        drop_path(spark, old)
    return totals, levels


def _spelled(ranked: DataFrame, shorter: DataFrame) -> DataFrame:
    """Cells with their words and the counts of their first and last words."""
    front = shorter.select("lang", F.col("id").alias("x"), F.col("phrase").alias("_phrase"), F.col("fronts").alias("_fronts"))
    back = shorter.select("lang", F.col("id").alias("y"), F.element_at(F.split("phrase", " "), -1).alias("_last"), F.col("backs").alias("_backs"))
    return ranked.join(front, ["lang", "x"]).join(back, ["lang", "y"]).select(
        "lang", "id", F.concat_ws(" ", "_phrase", "_last").alias("phrase"), "a",
        F.concat("_fronts", F.array("a")).alias("fronts"), F.concat("_backs", F.array("a")).alias("backs"), "x", "y",
    )


def _cuts(length: int) -> Column:
    """The lowest score over all cuts, then the smallest cut; products are decimals of 38 digits, exact to 10^35."""
    wide = lambda c: c.cast("decimal(19,0)")
    scored = []
    for k in range(1, length):
        left, right = F.col("fronts")[k - 1], F.col("backs")[length - k - 1]
        product = (wide(F.col("a")) * wide(F.col("n"))).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
        score = F.call_function("div", product.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))
        scored.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*scored))


def scored_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = MOST_WORDS) -> DataFrame:
    """All candidates that no longer candidate holds as often: lang, phrase, a, l, r, n, score.

    A longer phrase occurs at most as often as a phrase in it, and each phrase between the two is a
    candidate as well; so looking one word further finds all of them.
    """
    totals, levels = frequent_phrases(docs, least, longest)
    kept = None
    for length, level in enumerate(levels[1:], start=2):
        here = level.join(totals, "lang")
        if length < longest:
            longer = levels[length]
            around = longer.select("lang", F.explode(F.array("x", "y")).alias("id"), "a").groupBy("lang", "id").agg(F.max("a").alias("_around"))
            here = here.join(around, ["lang", "id"], "left").where("_around is null or 100 * _around < 100 * a")
        here = here.withColumn("cut", _cuts(length)).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        kept = here if kept is None else kept.unionByName(here)
    return kept


def collocations(docs: DataFrame, least: int = LEAST_COUNT, longest: int = MOST_WORDS, most: int = KEPT) -> DataFrame:
    """The first ``most`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = top_per_merged(scored_phrases(docs, least, longest), ["lang"], order, most)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
