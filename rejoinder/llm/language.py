"""Language identification by hyperdimensional profiles (operator 5).

Every letter has a random vector of +1 and -1. A trigram is bound as the product of its letters'
vectors, each permuted (rotated) by its place; a text is the bundle (sum) of its trigrams; a
language is the sum of its texts' unit vectors. A text gets the language with the largest cosine.
Runs of other characters between words are one boundary sign, which takes part in trigrams.
"""

from __future__ import annotations

import unicodedata  # noqa: F401  (str.isalpha follows its tables)
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import held_out
from rejoinder.llm.samples import first_by_hash
from rejoinder.llm.text import flat, slices

SIZE = 1024
#: Bound of the sample: rows of each language.
MOST_ROWS = 500
SLICE_BYTES = 1 << 20
#: Trigrams handled at once; bounds the matrix of their vectors.
BLOCK = 4096


def letter_vectors(points: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The fixed random vector of each code point (0 is the boundary)."""
    return np.stack([np.where(np.random.default_rng([7, int(p)]).integers(0, 2, size) == 1, 1, -1) for p in points]).astype(np.int8)


class Letters:
    """Which code points are letters, and their vectors; grows with the letters met."""

    def __init__(self):
        self.known = np.full(0x110000, -1, np.int32)  # place among the vectors; 0 is no letter
        self.vectors = letter_vectors(np.array([0]))

    def symbols(self, points: np.ndarray) -> np.ndarray:
        out = self.known[points]
        if (out < 0).any():
            new = np.unique(points[out < 0])
            letters = np.array([p for p in new if chr(p).isalpha()], int)
            self.known[new] = 0
            if len(letters):
                self.known[letters] = np.arange(len(letters)) + len(self.vectors)
                self.vectors = np.concatenate([self.vectors, letter_vectors(letters)])
            out = self.known[points]
        return out


def _symbols(texts: pa.Array, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, boundaries single and on both ends, and the text of each symbol."""
    lower = pc.utf8_lower(texts)
    points = np.frombuffer(flat(lower)[0].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    length = pc.fill_null(pc.utf8_length(lower), 0).to_numpy(zero_copy_only=False)
    # one boundary before each text and one after the last
    ends = np.cumsum(length)
    spaced = np.insert(letters.symbols(points), np.append(ends - length, len(points)), 0)
    owner = np.repeat(np.arange(len(length) + 1), np.append(length + 1, 1))
    keep = np.ones(len(spaced), bool)
    keep[1:] = (spaced[1:] != 0) | (spaced[:-1] != 0)
    keep[np.append(0, ends[:-1] + np.arange(1, len(ends)))] = True if len(ends) else keep[:1]
    return spaced[keep], owner[keep]


def text_vectors(texts: pa.Array, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of each text (float32) and whether it has a letter."""
    symbols, owner = _symbols(texts, letters)
    n = len(texts)
    out = np.zeros((n, SIZE), np.float32)
    has = np.bincount(owner[symbols > 0], minlength=n + 1)[:n] > 0
    if len(symbols) < 3:
        return out, has
    a, b, c = symbols[:-2].astype(np.int64), symbols[1:-1].astype(np.int64), symbols[2:].astype(np.int64)
    mine = owner[:-2]
    # a trigram may end on the boundary that opens the next text; it may not hold that text's letters
    good = (b > 0) & ((owner[2:] == mine) | (c == 0)) & (owner[1:-1] == mine)
    k = len(letters.vectors)
    key, mine = (a * k * k + b * k + c)[good], mine[good]
    grams, at = np.unique(key, return_inverse=True)
    counts = np.unique(mine * len(grams) + at, return_counts=True) if len(grams) else (np.zeros(0, int), np.zeros(0, int))
    row, col = counts[0] // max(1, len(grams)), counts[0] % max(1, len(grams))
    order = np.argsort(col, kind="stable")
    row, col, value = row[order], col[order], counts[1][order].astype(np.float32)
    v = letters.vectors
    first, second = np.roll(v, 2, axis=1), np.roll(v, 1, axis=1)
    edges = np.searchsorted(col, np.arange(0, len(grams) + BLOCK, BLOCK))
    for block, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        own = grams[block * BLOCK : (block + 1) * BLOCK]
        bound = (first[own // (k * k)] * second[own // k % k] * v[own % k]).astype(np.float32)
        for r0 in range(0, n, 256):
            sel = slice(lo, hi)
            inside = (row[sel] >= r0) & (row[sel] < r0 + 256) if n > 256 else slice(None)
            dense = np.zeros((min(256, n - r0), len(own)), np.float32)
            dense[row[sel][inside] - r0, col[sel][inside] - block * BLOCK] = value[sel][inside]
            out[r0 : r0 + 256] += dense @ bound
    return out, has


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def learn(docs: DataFrame, most: int = MOST_ROWS) -> tuple[list[str], np.ndarray]:
    """Language names and unit prototypes from at most ``most`` rows of each language of the learning fold."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = first_by_hash(usable.select("doc_id", "lang").distinct(), "lang", most)
    sample = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, total = Letters(), {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                units = _unit(text_vectors(part.column("text"), letters)[0]).astype(np.float64)
                langs = part.column("lang").to_pylist()
                for i, lang in enumerate(langs):
                    total[lang] = total.get(lang, 0) + units[i]
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "total": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    rows = sample.repartition(16).mapInArrow(sums, "lang string, total binary").toArrow().to_pylist()
    total: dict[str, np.ndarray] = {}
    for row in rows:
        total[row["lang"]] = total.get(row["lang"], 0) + np.frombuffer(row["total"])
    names = sorted(total)
    return names, _unit(np.stack([total[x] for x in names])) if names else np.zeros((0, SIZE))


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """For every row: (doc_id, lang_pred, score). ``und`` and 0 where the text is null or has no letter, or nothing was learned.

    The score is the cosine with the chosen prototype, negative ones as 0. Equal cosines: the first name in order.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((names, prototypes.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own, profile), letters = shipped.value, Letters()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                vectors, has = text_vectors(part.column("text"), letters)
                if own:
                    cosine = np.clip(_unit(vectors) @ profile.T, 0, 1)
                    best = cosine.argmax(1)
                    lang = np.where(has, np.array(own, object)[best], "und")
                    value = np.where(has, cosine[np.arange(len(best)), best], 0.0)
                else:
                    lang, value = np.full(len(has), "und", object), np.zeros(len(has))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "lang_pred": pa.array(lang.tolist(), pa.string()), "score": pa.array(value, pa.float64())}
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    found = predict(docs, *learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
