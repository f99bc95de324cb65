"""Benchmark decontamination by CGK embedding and bit sampling (operator 1).

The CGK embedding walks over a word sequence; at each step it emits the word under the pointer and
a random bit of (step, word) decides whether the pointer moves on. Sequences at a small edit
distance become sequences at a small Hamming distance. Each of ``REPEATS`` embeddings is sampled
at two different steps, both before ``REACH`` times the length, as the pointer passes the end
at about twice the length; the sampled words are a key. A key that met the end is no key. Windows of a
document as long as a benchmark item that share a key with the item are candidates, and
the exact edit distance, in words, of the item to the text around the window decides.

Which windows are embedded: an item of m words with at most k = RATE * m edits keeps one of k + 1
pieces whole, so only windows that hold some run of q = min(4, m // (k + 1)) words of an item at
its place can match. This leaves nothing out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import fresh
from rejoinder.llm.text import ALPHANUMERIC, U64, Words, flat, inside_text, mix, slices, windows

#: Edits allowed for each word of an item.
RATE = 0.2
REPEATS = 64
SAMPLED = 2
#: Steps of a walk that are sampled, for each word of the sequence.
REACH = 1.6
PIECE = 4
#: Text of the items that one pass over the documents holds.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
#: Cells of a walk or an edit table handled at once.
CELLS = 4_000_000


def _matches(sorted_keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in ``asked``, place in ``sorted_keys``) of equal numbers."""
    low, high = np.searchsorted(sorted_keys, asked, "left"), np.searchsorted(sorted_keys, asked, "right")
    count = high - low
    hit = np.repeat(np.arange(len(asked)), count)
    within = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
    return hit, low[hit] + within


def cgk_keys(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sampled keys (row x repeat) of word sequences, given one by row and zero past their ``size``.

    Zero stands for a key that is none: one of its steps came after the last word. A sequence of
    one word samples its one step twice.
    """
    n, width = rows.shape
    reach = np.maximum((REACH * size).astype(np.int64), 1)
    steps = int(reach.max(initial=1))
    # a step's hash may not depend on the width of this table
    step_hash = mix(np.arange(1, REPEATS + 1, dtype=U64)[:, None] * U64(1 << 32) + np.arange(steps, dtype=U64)) | U64(1)
    share = np.random.default_rng(12).random((REPEATS, SAMPLED))
    first = (share[:, 0, None] * reach).astype(np.int64)
    second = (first + 1 + (share[:, 1, None] * (reach - 1)).astype(np.int64)) % reach
    wanted = np.stack([first, second], 1)  # repeat x sample x row
    padded = np.concatenate([rows, np.zeros((n, 1), U64)], 1)
    pointer = np.zeros((REPEATS, n), np.int64)
    keys = np.zeros((REPEATS, SAMPLED, n), U64)
    at = np.arange(n)
    for step in range(steps):
        symbol = padded[at, np.minimum(pointer, width)]
        now = wanted == step
        if now.any():
            keys = np.where(now, symbol[:, None, :], keys)
        pointer += (mix(symbol * step_hash[:, step : step + 1]) >> U64(63)).astype(np.int64)
    out = np.arange(1, REPEATS + 1, dtype=U64)[:, None] * U64(0x9E3779B97F4A7C15) + size.astype(U64)
    for k in range(SAMPLED):
        out = mix(out * U64(0xD1B54A32D192ED03) + keys[:, k])
    return np.where((keys == 0).any(1), U64(0), out | U64(1)).T


def edit_distances(items: np.ndarray, size: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """The least edit distance of each item (a row of ``size`` words) to any run of its region (a row; zero past its end)."""
    n, width = regions.shape
    ramp = np.arange(width + 1)
    row = np.zeros((n, width + 1), np.int64)
    best = np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        cost = (regions != items[:, i : i + 1]) | (regions == 0)
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + cost, row[:, 1:] + 1)
        row = np.minimum.accumulate(new - ramp, 1) + ramp
        done = size == i + 1
        best[done] = row[done].min(1)
    return best


class Items:
    """Benchmark items of one block: words, pieces and keys, for lookups in any number of texts."""

    def __init__(self, ids: list, texts: pa.Array):
        words = Words(*flat(pc.utf8_lower(texts)), ALPHANUMERIC)
        words.hash = words.hash | U64(1)  # zero means no word
        self.ids, self.first = ids, words.first
        self.size = np.diff(words.first)
        self.edits = (self.size * RATE).astype(np.int64)
        self.words = words.hash
        piece = np.minimum(PIECE, self.size // (self.edits + 1))
        self.pieces = {}
        owner = np.repeat(np.arange(len(ids)), self.size)
        for q in np.unique(piece[piece > 0]):
            value = windows(words.hash, int(q))
            good = inside_text(words.first, int(q)) & (piece[owner[: len(value)]] == q)
            place = np.flatnonzero(good)
            # a window depends on the size of an item and the place of the piece in it, not on the item
            told = np.stack([self.size[owner[place]].astype(U64), (place - words.first[owner[place]]).astype(U64), value[place]], 1)
            told = np.unique(told, axis=0)
            told = told[np.argsort(told[:, 2], kind="stable")]
            self.pieces[int(q)] = (told[:, 2], told[:, 0].astype(np.int64), told[:, 1].astype(np.int64))
        keys, whose = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for some in self.runs(np.arange(len(ids)), REPEATS * SAMPLED):
            k = cgk_keys(self.rows(some), self.size[some])
            keys.append(k.reshape(-1))
            whose.append(np.repeat(some, REPEATS))
        keys, whose = np.concatenate(keys), np.concatenate(whose)
        order = np.argsort(keys, kind="stable")
        order = order[keys[order] > 0]
        self.keys, self.key_items = keys[order], whose[order]

    def runs(self, items: np.ndarray, factor: int) -> Iterator[np.ndarray]:
        """Items (with words) of similar size, few enough for a table of ``factor`` cells a word."""
        items = items[self.size[items] > 0]
        items = items[np.argsort(self.size[items], kind="stable")]
        at = 0
        while at < len(items):
            n = max(1, CELLS // (factor * int(self.size[items[min(len(items) - 1, at + 999)]])))
            yield items[at : at + min(n, 1000)]
            at += min(n, 1000)

    def rows(self, some: np.ndarray) -> np.ndarray:
        return _cut(self.words, self.first[some], self.size[some])

    def found(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, first word of the window) of the best match of each text and item."""
        words = Words(*flat(pc.utf8_lower(texts)), ALPHANUMERIC)
        own = words.hash | U64(1)
        owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
        seen = [np.zeros((0, 2), np.int64)]
        for q, (value, length, offset) in self.pieces.items():
            here = windows(own, q)
            here_at = np.flatnonzero(inside_text(words.first, q))
            hit, place = _matches(value, here[here_at])
            # a window that a border cuts off is taken as far as it goes
            start = here_at[hit] - offset[place]
            text = owner[here_at[hit]]
            seen.append(np.stack([np.maximum(start, words.first[text]), length[place]], 1))
        seen = np.unique(np.concatenate(seen), axis=0)
        if not len(seen):
            return []
        start, wide = seen[:, 0], seen[:, 1]
        text = owner[start]
        pairs = []
        order = np.argsort(wide, kind="stable")
        at = 0
        while at < len(order):
            n = max(1, CELLS // (REPEATS * SAMPLED * int(wide[order[min(len(order) - 1, at + 499)]])))
            some = order[at : at + min(n, 500)]
            at += len(some)
            length = np.minimum(wide[some], words.first[text[some] + 1] - start[some])
            keys = cgk_keys(_cut(own, start[some], length), wide[some]).reshape(-1)
            real = np.flatnonzero(keys)
            hit, place = _matches(self.keys, keys[real])
            window, other = some[real[hit] // REPEATS], self.key_items[place]
            same = self.size[other] == wide[window]
            pairs.append(np.unique(np.stack([window[same], other[same]], 1), axis=0))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        order = np.argsort(self.size[pairs[:, 1]], kind="stable")
        at = 0
        while at < len(order):
            n = max(1, CELLS // (8 * int(self.size[pairs[order[min(len(order) - 1, at + 999)], 1]])))
            some = pairs[order[at : at + min(n, 1000)]]
            at += len(some)
            which, size, edits = some[:, 1], self.size[some[:, 1]], self.edits[some[:, 1]]
            low = np.maximum(words.first[text[some[:, 0]]], start[some[:, 0]] - edits)
            high = np.minimum(words.first[text[some[:, 0]] + 1], start[some[:, 0]] + size + edits)
            distance = edit_distances(self.rows(which), size, _cut(own, low, high - low))
            for w, i, d in zip(some[:, 0], which, distance, strict=True):
                if d <= self.edits[i]:
                    key = (int(text[w]), int(i))
                    told = (int(d), int(start[w] - words.first[text[w]]))
                    best[key] = min(best.get(key, told), told)
        return [(t, i, d, s) for (t, i), (d, s) in sorted(best.items())]


def _cut(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Runs of words as rows, zero past their length."""
    width = int(length.max(initial=1))
    at = start[:, None] + np.arange(width)
    inside = np.arange(width) < length[:, None]
    return np.where(inside, words[np.minimum(at, len(words) - 1)], U64(0))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, item_words, start_word) for every row of ``docs`` and item it holds.

    Words are runs of letters and digits in lower case. An item is held if some run of the text is
    within RATE edits (in words, for each word of the item) of the whole item. Null and empty
    texts hold nothing; an item without words is held nowhere; rows that repeat a text are each
    reported; a null id is reported as null. Items of several rows are separate rows of the result.
    The benchmark goes to the tasks in blocks of bounded size, with one pass over the documents
    for each; documents are never shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, distance int, item_words int, start_word int"
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    passes = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        shipped = spark.sparkContext.broadcast((own.column("item_id").to_pylist(), own.column("text").to_pylist()))
        passes.append(texts.mapInArrow(_search(shipped), schema))
    return reduce(DataFrame.unionByName, passes)


def _search(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = shipped.value
        items = Items(ids, pa.array(texts, pa.string()))
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = items.found(part.column("text"))
                if found:
                    doc = part.column("doc_id").take(pa.array([t for t, *_ in found]))
                    columns = {
                        "item_id": [items.ids[i] for _, i, _, _ in found],
                        "distance": pa.array([d for *_, d, _ in found], pa.int32()),
                        "item_words": pa.array([int(items.size[i]) for _, i, _, _ in found], pa.int32()),
                        "start_word": pa.array([s for *_, s in found], pa.int32()),
                    }
                    yield pa.RecordBatch.from_pydict({"doc_id": doc, **columns})

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns; rows that repeat an id share its fate, rows without an id stay."""
    (gone,) = fresh(docs, "gone")
    dropped = contaminated(docs, benchmark).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped[gone], "left_anti")
