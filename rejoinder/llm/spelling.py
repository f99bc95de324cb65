"""Groups of words that are one letter apart, each led to the spelling that is used most.

The vocabulary is indexed in both directions. A word is cut into two halves; a word one letter away
keeps one half unchanged. So the first half is matched exactly from the start, and the rest is
extended to the right with one error; the second half is matched exactly from the end, and the rest is
extended to the left with one error. Both are the same search over an FM-index, once over the words and
once over the reversed words: a row of the index is a place in a word, rows are sorted by the letters before
their place, read backwards to the delimiter, and an interval of rows stands for all words with one beginning.
Since words are listed in order, the next letters of such an interval are sorted, so its branches are runs.

The index is cut into blocks by what the exact half already tells: the direction, the length of the shorter
word of a pair, and the first letters of the half. A word is listed twice in each direction, with its own length and
with that of words one letter shorter, and asks once in each. Beginnings that hold more words than a block are
dealt over several blocks, which all get the beginning's questions. Every pair is told by one block only.

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lowered; where crc32 of ``<doc_id>:<run>`` is a multiple of 97, the
code point at crc32 modulo the length is left out. Nulls: a null text has no words, a null id reads as an empty
one. Repeated rows count each time; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import drop_path
from rejoinder.llm.text import flat, slices
from rejoinder.operators.joins import broadcast_if_small
from rejoinder.session import scratch_path, written

ONE_IN = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3

SLICE_BYTES = 4 << 20
#: Distinct words a task holds before it hands their counts on.
HELD_WORDS = 500_000
#: Letters of the exact half that deal words to blocks, and words of a block.
KEY_LETTERS = 4
BLOCK_WORDS = 40_000
#: Words that ask at once.
ASKED_AT_ONCE = 20_000

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_shifts: dict[int, np.ndarray] = {}
LONGEST_SHIFT = 64


def _shift(length: int) -> np.ndarray:
    """Four tables of 256 that carry a crc32 over ``length`` bytes to come."""
    if length not in _shifts:
        basis = np.arange(256, dtype=np.uint64)[None, :] << (8 * np.arange(4, dtype=np.uint64))[:, None]
        one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint64)  # the table of the polynomial
        for _ in range(length):
            basis = (basis >> np.uint64(8)) ^ one[basis & np.uint64(255)]
        _shifts[length] = basis
    return _shifts[length]


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of A followed by B, from both crc32 and the bytes of B (at most ``LONGEST_SHIFT``)."""
    sizes, at = np.unique(length, return_inverse=True)
    tables = np.stack([_shift(int(n)) for n in sizes]) if len(sizes) else np.zeros((0, 4, 256), np.uint64)
    out = second.astype(np.uint64)
    for k in range(4):
        out ^= tables[at, k, (first >> np.uint64(8 * k)) & np.uint64(255)]
    return out


def _without(word: str, place: int) -> str:
    return word[:place] + word[place + 1 :]


def counted_runs(batch: pa.RecordBatch, one_in: int = ONE_IN, least_letters: int = LEAST_LETTERS) -> pa.Table:
    """(word, n) of one batch with doc_id and text."""
    texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
    blank = pa.scalar(b" ", pa.large_binary())
    data, offsets = flat(pc.binary_join_element_wise(texts, blank, pa.scalar(b"", pa.large_binary())))
    data = LOWER[data]
    inside = LETTER[data]
    wide = data == 0xC3  # the first byte of U+00C0 to U+00FF; the second follows
    inside |= wide
    inside[1:] |= wide[:-1]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = runs.dictionary_encode()
    code, kinds = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    before = np.array([zlib.crc32(b":" if i is None else b"%d:" % i) for i in batch.column("doc_id").to_pylist()], np.uint64)[np.searchsorted(offsets, start, "right") - 1]
    own = np.array([zlib.crc32(k) for k in kinds], np.uint64)
    size = np.array([len(k) for k in kinds], np.int64)
    crc = np.zeros(len(code), np.uint64)
    short = size[code] <= LONGEST_SHIFT
    crc[short] = joined_crc(before[short], own[code[short]], size[code[short]])
    for i in np.flatnonzero(~short):
        crc[i] = zlib.crc32(kinds[code[i]], int(before[i]))
    cut = crc % np.uint64(one_in) == 0
    letters = pc.utf8_length(coded.dictionary.cast(pa.large_string())).to_numpy(zero_copy_only=False)
    whole = np.bincount(code[~cut], minlength=len(kinds))
    kept = np.flatnonzero((whole > 0) & (letters >= least_letters))
    words, counts = [kinds[i].decode() for i in kept], whole[kept].tolist()
    lost, times = np.unique(np.stack([code[cut], (crc[cut] % letters[code[cut]].astype(np.uint64)).astype(np.int64)]), axis=1, return_counts=True)
    for c, place, n in zip(lost[0], lost[1], times, strict=True):
        if letters[c] > least_letters:
            words.append(_without(kinds[c].decode(), int(place)))
            counts.append(int(n))
    return pa.table({"word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    total = lambda: pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
    size = 0
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            held.append(counted_runs(part))
            size += held[-1].num_rows
            if size > HELD_WORDS:
                held = [total()]
                if held[0].num_rows > HELD_WORDS:
                    yield from held[0].to_batches()
                    held = []
                size = sum(t.num_rows for t in held)
    if held:
        yield from total().to_batches()


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words that occur at least ``least_count`` times."""
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    counts = docs.select(ids, "text").mapInArrow(_counted, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class OneError:
    """An FM-index over sorted, distinct strings of numbers from 1, which are searched from their start.

    ``row`` (j, i) is the place before letter i of string j. Rows are sorted by the letters before their place, last letter
    first, then by j. ``step`` holds the next letters in that order; the rows after a letter are a block of their own.
    """

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        count = len(lengths)
        first = np.concatenate([[0], np.cumsum(lengths + 1)])  # a string has one place more than letters
        rows = int(first[-1])
        owner = np.repeat(np.arange(count), lengths + 1)
        place = np.arange(rows) - first[owner]
        after = np.zeros(rows, np.int64)
        after[place < lengths[owner]] = letters
        rank = np.zeros(rows, np.int64)
        rank[1:] = np.where(place[1:] > 0, after[:-1], 0)
        reach, longest = 1, int(lengths.max(initial=0))
        while reach <= longest:  # by doubling the letters looked back on
            back = np.where(place >= reach, rank[np.maximum(np.arange(rows) - reach, 0)], 0)
            kinds, rank = np.unique(rank * (rows + 1) + back, return_inverse=True)
            reach *= 2
            if len(kinds) == rows:
                break
        order = np.argsort(rank, kind="stable")
        self.owner, rank, self.step = owner[order], rank[order], after[order]
        self.rows, self.strings = rows, count
        inner = np.flatnonzero(self.step)
        inner = inner[np.argsort(self.step[inner], kind="stable")]
        self.keys = self.step[inner] * rows + inner
        self.next = np.zeros(rows, np.int64)
        self.next[inner] = count + np.arange(len(inner))
        fresh = np.ones(rows, bool)
        fresh[1:] = (self.step[1:] != self.step[:-1]) | (rank[1:] != rank[:-1])
        self.run = np.cumsum(fresh) - 1
        self.run_start = np.flatnonzero(fresh)
        self.run_size = np.diff(np.append(self.run_start, rows))

    def extend(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which intervals go on with ``letter``, and their new intervals."""
        if not len(self.keys):
            return np.zeros(0, np.int64), lo[:0], lo[:0]
        at = np.searchsorted(self.keys, letter * self.rows + lo)
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        ok = np.flatnonzero((at < len(self.keys)) & (key < letter * self.rows + hi))
        row = key[ok] - letter[ok] * self.rows
        start = self.strings + at[ok]
        return ok, start, start + self.run_size[self.run[row]]

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ways to go on: (which interval, letter, new interval)."""
        begin, end = self.run[lo], self.run[hi - 1] + 1
        which = np.repeat(np.arange(len(lo)), end - begin)
        run = np.arange(len(which)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + begin[which]
        row = self.run_start[run]
        inner = self.step[row] > 0
        which, run, row = which[inner], run[inner], row[inner]
        return which, self.step[row], self.next[row], self.next[row] + self.run_size[run]

    def search(self, letters: np.ndarray, first: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (question, string): the string is the question with one letter replaced, or one more letter, at or after ``exact``."""
        asks, lo, hi = np.arange(len(lengths)), np.zeros(len(lengths), np.int64), np.full(len(lengths), self.strings)
        wrong = [np.zeros(0, np.int64)] * 4  # question, its place, interval: one error made
        found: list[tuple[np.ndarray, np.ndarray]] = []
        depth = 0
        while len(asks) or len(wrong[0]):
            q, place, low, high = wrong
            done = place == lengths[q]
            ends = done & (self.step[np.minimum(low, self.rows - 1)] == 0)
            found.append((q[ends], self.owner[low[ends]]))
            q, place, low, high = (x[~done] for x in (q, place, low, high))
            ok, start, end = self.extend(low, high, letters[first[q] + place])
            later = [(q[ok], place[ok] + 1, start, end)]
            if len(asks):
                may = np.flatnonzero(depth >= exact[asks])
                which, letter, start, end = self.branches(lo[may], hi[may])
                q = asks[may[which]]
                inside = depth < lengths[q]
                wanted = np.where(inside, letters[np.minimum(first[q] + depth, len(letters) - 1)], 0)
                other = letter != wanted  # the same letter is no error, and as one more letter it is tried further on
                q, start, end, inside = q[other], start[other], end[other], inside[other]
                later.append((q, np.full(len(q), depth), start, end))
                later.append((q[inside], np.full(int(inside.sum()), depth + 1), start[inside], end[inside]))
                going = depth < lengths[asks]
                asks, lo, hi = asks[going], lo[going], hi[going]
                ok, lo, hi = self.extend(lo, hi, letters[first[asks] + depth])
                asks = asks[ok]
            wrong = [np.concatenate(x) for x in zip(*later, strict=True)]
            depth += 1
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (asks, asks)


BLOCK_SCHEMA = "word string, n_near bigint, near_n bigint, near string"


def _symbols(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings as numbers from 1, each behind a delimiter of its class; where each begins, and its length."""
    spelled = table.column("spelled").to_pylist()
    points = np.frombuffer("".join(spelled).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.array([len(s) for s in spelled], np.int64)
    _, points = np.unique(points, return_inverse=True)
    classes, sort = np.unique(table.column("shorter").to_numpy(), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.zeros(int(first[-1]), np.int64)
    out[first[:-1]] = 1 + sort
    rest = np.ones(len(out), bool)
    rest[first[:-1]] = False
    out[rest] = 1 + len(classes) + points
    return out, first[:-1], size + 1


def near_words(table: pa.Table) -> pa.Table:
    """What one block tells: per word, how many words of the block are near it and the foremost of these.

    ``table``: spelled (reversed where ``backward``), backward, shorter (the length of the shorter word of a pair), n, asks, listed.
    """
    table = table.sort_by([("backward", "ascending"), ("shorter", "ascending"), ("spelled", "ascending")])
    letters, first, size = _symbols(table)
    backward, listed, asks = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("backward", "listed", "asks"))
    shorter, n = table.column("shorter").to_numpy(), table.column("n").to_numpy()
    left = shorter // 2
    exact = 1 + np.where(backward, shorter - left, left)
    pairs = []
    for side in (False, True):
        here = np.flatnonzero(listed & (backward == side))
        asking = np.flatnonzero(asks & (backward == side))
        if not len(here) or not len(asking):
            continue
        within = np.concatenate([np.arange(first[i], first[i] + size[i]) for i in here]) if len(here) < len(size) else np.arange(len(letters))
        index = OneError(letters[within], size[here])
        for at in range(0, len(asking), ASKED_AT_ONCE):
            own = asking[at : at + ASKED_AT_ONCE]
            q, j = index.search(letters, first[own], size[own], exact[own])
            q, j = own[q], here[j]
            if side:  # pairs with equal first halves are told by the other direction
                same = np.ones(len(q), bool)
                for k in range(int(left[q].max(initial=0))):
                    still = k < left[q]
                    same &= ~still | (letters[first[q] + size[q] - 1 - np.minimum(k, size[q] - 1)] == letters[first[j] + size[j] - 1 - np.minimum(k, size[j] - 1)])
                q, j = q[~same], j[~same]
            pairs.append((q, j))
            longer = size[j] > size[q]  # equal lengths ask each other, a longer word does not ask the shorter
            pairs.append((j[longer], q[longer]))
    spelled = table.column("spelled").combine_chunks()
    words = pc.if_else(pa.array(backward), pc.utf8_reverse(spelled), spelled)
    # a word may stand in several rows: its name here is its place among the sorted words
    names = pc.unique(words).sort()
    name = pc.index_in(words, names).to_numpy()
    q, j = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
    order = np.lexsort((name[j], -n[j], name[q]))
    q, j = q[order], j[order]
    lead = np.flatnonzero(np.diff(name[q], prepend=-1))
    return pa.table(
        {
            "word": names.take(pa.array(name[q[lead]], pa.int64())).cast(pa.string()),
            "n_near": pa.array(np.diff(np.append(lead, len(q))), pa.int64()),
            "near_n": pa.array(n[j[lead]], pa.int64()),
            "near": names.take(pa.array(name[j[lead]], pa.int64())).cast(pa.string()),
        }
    )


def _blocks(words: DataFrame, rows: int) -> DataFrame:
    """The rows of all blocks (block, part); ``rows`` is the number of words."""
    length = F.length("word")
    listed = (
        words.withColumn("backward", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("shorter", F.explode(F.when(length > LEAST_LETTERS, F.array(length, length - 1)).otherwise(F.array(length))))
        .withColumn("spelled", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")))
    )
    half = F.floor(F.col("shorter") / 2)
    half = F.when(F.col("backward"), F.col("shorter") - half).otherwise(half)
    listed = listed.withColumn("key", F.xxhash64("backward", "shorter", F.expr("spelled").substr(F.lit(1), F.least(half, F.lit(KEY_LETTERS)).cast("int"))))
    # keys with more words than a block: at most 4 * rows / BLOCK_WORDS of them
    heavy = listed.groupBy("key").count().where(F.col("count") > BLOCK_WORDS).select("key", F.ceil(F.col("count") / BLOCK_WORDS).cast("int").alias("parts"))
    dealt = listed.join(broadcast_if_small(heavy, 4 * rows // BLOCK_WORDS), "key", "left")
    own = F.when(F.col("parts").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("word"), F.col("parts"))).cast("int")
    asks = F.length("word") == F.col("shorter")
    every = F.when(F.col("parts").isNull() | ~asks, F.array(own)).otherwise(F.sequence(F.lit(1), F.col("parts")))
    blocks = max(1, -(-4 * rows // BLOCK_WORDS))
    return dealt.withColumn("part", F.explode(every)).select(
        F.pmod("key", F.lit(blocks)).alias("block"), "part", "spelled", "backward", F.col("shorter").cast("bigint").alias("shorter"), "n",
        asks.alias("asks"), (F.col("part") == own).alias("listed"),
    )


def neighbours(words: DataFrame, rows: int) -> DataFrame:
    """(word, n_near, near_n, near) for every word that has a near word: how many, and the one used most (ties: the first)."""
    told = _blocks(words, rows).groupBy("block", "part").applyInArrow(near_words, BLOCK_SCHEMA)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return told.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each (word, form), by doubling the way; a form is used at least twice as often, so ways end soon."""
    spark = forms.sparkSession
    ways = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    last = None
    while True:
        path = scratch_path(spark, "spelling-roots")
        ways.write.parquet(path)
        if last:
            drop_path(spark, last)
        last, ways = path, spark.read.schema("word string, root string, moved boolean").parquet(path)
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        ways = ways.drop("moved").join(on, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = written(vocabulary(docs), "spelling-words")
    near = neighbours(words, words.count())
    told = words.join(near, "word", "left")
    leads = F.col("near_n") >= 2 * F.col("n")
    told = written(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(leads, F.col("near")).alias("form"), F.when(leads, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(told.where("form is not null").select("word", "form"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
