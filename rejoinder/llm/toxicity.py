"""Toxicity by non-negative positive-unlabelled learning (operator 3).

Linear classifiers in numpy learn from texts confirmed as toxic and from unlabelled texts. The
risk is the class-prior-corrected estimate: prior * positive loss + max(0, unlabelled negative
loss - prior * positives' negative loss); where the second part falls below zero, its gradient is
reversed. Rows marked as not toxic serve as unlabelled rows only, and to estimate the prior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import fresh
from rejoinder.llm.samples import labelled, report, unlabelled
from rejoinder.llm.text import ALPHANUMERIC, BASE, Words, flat, mix, slices

#: Bounds of the sample: confirmed toxic rows, and unlabelled rows.
MOST_POSITIVE = 3000
MOST_UNLABELLED = 6000
#: Words that a classifier may look at, chosen from the sample.
MOST_WORDS = 2000
LEAST_DOCUMENTS = 3
#: First bytes of a longer word that count as its stem.
STEMS = (4, 5, 6, 8)
MEMBERS = 3
STEPS = 1000
THRESHOLD = 0.3
SLICE_BYTES = 2 << 20


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text and their stems (first bytes of longer words), as numbers, and the text of each."""
    data, offsets = flat(pc.utf8_lower(texts))
    words = Words(data, offsets, ALPHANUMERIC)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    found, owners = [words.hash], [owner]
    for size in STEMS:
        longer = np.flatnonzero(words.end - words.start > size)
        stem = np.full(len(longer), size, np.uint64)
        for k in range(size):
            stem = stem * BASE + data[words.start[longer] + k]
        found.append(mix(stem))
        owners.append(owner[longer])
    return np.concatenate(found), np.concatenate(owners)


def distinct(numbers: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number once for each text, by text."""
    order = np.lexsort((numbers, owner))
    owner, numbers = owner[order], numbers[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (numbers[1:] != numbers[:-1])
    return numbers[new], owner[new]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            hashes, owner = distinct(*features(part.column("text")))
            edges = np.searchsorted(owner, np.arange(part.num_rows + 1))
            blobs = [hashes[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"words": pa.array(blobs, pa.binary())})


def _collected(sample: DataFrame) -> list[np.ndarray]:
    """The word sets of a bounded sample, on the driver, without copies and most near copies.

    Copies would count as independent evidence for every word in them. Sets that agree in three
    min-hashes are taken for copies of one text.
    """
    rows = sample.select("text").repartition(16).mapInArrow(_sets, "words binary").toArrow()
    sets = sorted((np.frombuffer(b, np.uint64) for b in rows.column("words").to_pylist()), key=lambda a: (len(a), a.tobytes()))
    del rows
    pa.default_memory_pool().release_unused()  # the driver goes on with other stages
    seen = {tuple(int(mix(own ^ np.uint64(k)).min()) for k in (1, 2, 3)) if len(own) else (): own for own in reversed(sets)}
    return list(seen.values())


def vocabulary(positive: list[np.ndarray], other: list[np.ndarray], prior: float, most: int = MOST_WORDS) -> np.ndarray:
    """The words that point to toxic texts.

    ``prior`` times the ratio of the document frequencies estimates the share of toxic texts among
    those that hold the word; it must reach one half. The log-likelihood ratio must be clear.
    """
    none = [np.zeros(0, np.uint64)]
    p_words, p_count = np.unique(np.concatenate(positive or none), return_counts=True)
    u_words, u_count = np.unique(np.concatenate(other or none), return_counts=True)
    words = np.union1d(p_words[p_count >= LEAST_DOCUMENTS], u_words[u_count >= 4 * LEAST_DOCUMENTS])
    count = lambda known, counts: np.where(np.isin(words, known), counts[np.minimum(np.searchsorted(known, words), len(known) - 1)] if len(known) else 0, 0)
    a, b = count(p_words, p_count).astype(float), count(u_words, u_count).astype(float)
    n, m = max(1, len(positive)), max(1, len(other))
    mean = np.clip((a + b) / (n + m), 1e-9, 1 - 1e-9)
    part = lambda k, size: k * np.log(np.maximum(k, 1e-12) / size / mean) + (size - k) * np.log(np.maximum(size - k, 1e-12) / size / (1 - mean))
    gain = part(a, n) + part(b, m)
    # a word must beat what chance would give the best of so many words
    clear = np.flatnonzero((gain > np.log(len(words) + 1) + 3) & (prior * (a / n) >= 0.5 * (b / m)))
    return np.sort(words[clear[np.argsort(-gain[clear], kind="stable")[:most]]])


def _matrix(sets: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(words)), np.float32)
    for i, own in enumerate(sets):
        at = np.searchsorted(words, own)
        hit = np.flatnonzero(at < len(words))
        out[i, at[hit[words[at[hit]] == own[hit]]]] = 1
    return out


def nn_pu(positive: np.ndarray, other: np.ndarray, prior: float, seed: int, steps: int = STEPS, decay: float = 1e-4) -> np.ndarray:
    """Weights and bias (last) that minimise the non-negative risk with the logistic loss, by Adam."""
    rng = np.random.default_rng(seed)
    weight = np.zeros(positive.shape[1] + 1)
    weight[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(weight), np.zeros_like(weight)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        p = positive[rng.integers(0, len(positive), min(256, len(positive)))]
        u = other[rng.integers(0, len(other), min(1024, len(other)))]
        inner = weight[:-1].astype(np.float32)
        zp, zu = (p @ inner).astype(float) + weight[-1], (u @ inner).astype(float) + weight[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        # logistic loss: softplus(-z) for a positive, softplus(z) for a negative
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = prior * (sp - 1) / len(p), np.zeros(len(u))
        if negative_risk >= 0:
            gp, gu = gp - prior * sp / len(p), su / len(u)
        else:  # only undo what drove the estimate below zero
            gp, gu = prior * sp / len(p), -su / len(u)
        gradient = np.append(gp.astype(np.float32) @ p + gu.astype(np.float32) @ u, gp.sum() + gu.sum())
        gradient[:-1] += decay * weight[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = 0.05 * min(1, 2 * (1 - step / (steps + 1)))
        weight -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weight


class Model:
    """Word numbers with the weights of every member."""

    def __init__(self, words: np.ndarray, weights: np.ndarray):
        self.words, self.weights = words, weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        hashes, owner = features(texts)
        at = np.searchsorted(self.words, hashes)
        if len(self.words):
            known = np.flatnonzero(self.words[np.minimum(at, len(self.words) - 1)] == hashes)
            at, owner = distinct(at[known], owner[known])
        else:
            at, owner = at[:0], owner[:0]
        total = np.zeros(len(texts))
        for w in self.weights:
            z = w[-1] + np.bincount(owner, w[:-1][at], len(texts))
            total += 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return total / len(self.weights)


def learn(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Train on a bounded sample (``MOST_POSITIVE`` toxic, ``MOST_UNLABELLED`` unlabelled rows).

    ``prior`` is the share of toxic texts; by default it is estimated from the labels of the
    learning fold. Without a toxic row every text gets the prior as its score.
    """
    from rejoinder.llm.columns import held_out

    positive = _collected(labelled(docs, labels.where("toxic = 1"), "toxic", MOST_POSITIVE))
    other = _collected(unlabelled(docs, MOST_UNLABELLED))
    if prior is None:
        share = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).agg(F.avg("toxic")).first()[0]
        prior = min(0.9, max(0.001, share or 0.0))
    if not positive or not other:
        return Model(np.zeros(0, np.uint64), np.array([[np.log(prior / (1 - prior))]]))
    words = vocabulary(positive, other, prior)
    p, u = _matrix(positive, words), _matrix(other, words)
    return Model(words, np.stack([nn_pu(p, u, prior, seed) for seed in range(MEMBERS)]))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a new column ``name`` between 0 and 1; a null text is scored as empty.

    ``name`` must not be a column of ``docs``.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((model.words, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shipped.value)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                scores = own.scores(part.column(text))
                columns = [*part.columns[:-1], pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], name])

    (text,) = fresh(docs, "content")
    keyed = docs.withColumn(text, F.coalesce("text", F.lit("")))
    schema = docs.withColumn(name, F.lit(0.0)).schema
    return keyed.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The score of every row of ``docs`` with its fold and its prediction."""
    return report(docs, score(docs.select("doc_id", "text"), learn(docs, labels)), THRESHOLD)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    (name,) = fresh(docs, "score")
    return score(docs, learn(docs, labels), name).where(F.col(name) < threshold).drop(name)
