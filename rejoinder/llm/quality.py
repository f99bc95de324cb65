"""Text quality by a byte-level convolutional network in numpy (operator 4).

A text is cut into chunks of ``CHUNK`` bytes that overlap by one filter width less one byte, so
every run of bytes that a filter can see lies in a chunk. Learned filters run over each chunk, a
chunk keeps the maximum of each filter, the mean over all chunks of the text goes through
a logistic unit. Training uses a bounded sample of labelled rows; scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import fresh
from rejoinder.llm.samples import labelled, report
from rejoinder.llm.text import flat, slices

CHUNK = 256
WIDTH = 8
STRIDE = CHUNK - WIDTH + 1
SIZE = 4
FILTERS = 16
#: Bound of the sample: rows of each label, and chunks (spread evenly) of a row in one step.
MOST_ROWS = 1500
CHUNKS_PER_ROW = 6
#: Passes over the sample, and the least number of steps; a small sample is passed more often.
EPOCHS = 8
LEAST_STEPS = 250
BATCH = 64
THRESHOLD = 0.7
SLICE_BYTES = 1 << 20


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts (rows of bytes, zero past the end) and the number of chunks of each text; an empty text has one."""
    length = np.diff(offsets)
    count = np.maximum(1, -(-(length - (WIDTH - 1)) // STRIDE))
    owner = np.repeat(np.arange(len(length)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[owner] + place * STRIDE
    at = start[:, None] + np.arange(CHUNK)
    inside = at < offsets[owner + 1][:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(at, len(data))], 0).astype(np.uint8), count


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (256, SIZE)).astype(np.float32)
        self.filters = rng.normal(0, (WIDTH * SIZE) ** -0.5, (WIDTH * SIZE, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(FILTERS + 1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out]

    def _unrolled(self, rows: np.ndarray) -> np.ndarray:
        x = self.embed[rows].reshape(len(rows), -1)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * SIZE, axis=1)[:, ::SIZE]

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The maximum of every filter over each chunk."""
        out = np.empty((len(rows), FILTERS), np.float32)
        for at in range(0, len(rows), 128):
            seen = self._unrolled(rows[at : at + 128])
            flat_view = np.ascontiguousarray(seen).reshape(-1, WIDTH * SIZE)
            out[at : at + 128] = (flat_view @ self.filters).reshape(seen.shape[0], seen.shape[1], FILTERS).max(1)
        return np.maximum(out + self.shift, 0)

    def probability(self, rows: np.ndarray, count: np.ndarray) -> np.ndarray:
        pooled = self.pooled(rows)
        mean = np.add.reduceat(pooled, np.cumsum(count) - count, axis=0) / count[:, None] if len(count) else np.zeros((0, FILTERS))
        return 1 / (1 + np.exp(-np.clip(mean @ self.out[:-1] + self.out[-1], -30, 30).astype(np.float64)))

    def gradients(self, rows: np.ndarray, count: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        seen = np.ascontiguousarray(self._unrolled(rows))
        response = seen @ self.filters
        best = response.argmax(1)  # chunk x filter
        top = np.take_along_axis(response, best[:, None], 1)[:, 0] + self.shift
        pooled = np.maximum(top, 0)
        first = np.cumsum(count) - count
        mean = np.add.reduceat(pooled, first, axis=0) / count[:, None]
        p = 1 / (1 + np.exp(-np.clip(mean @ self.out[:-1] + self.out[-1], -30, 30)))
        error = ((p - target) * weight / weight.sum()).astype(np.float32)
        g_out = np.append(mean.T @ error, error.sum()).astype(np.float32)
        g_pool = np.repeat(error[:, None] * self.out[:-1] / count[:, None], count, axis=0) * (top > 0)
        picked = seen[np.arange(len(rows))[:, None], best]  # chunk x filter x inputs
        g_filters = np.einsum("cf,cfi->if", g_pool, picked)
        g_input = g_pool[:, :, None] * self.filters.T[None]
        g_embed = np.zeros_like(self.embed)
        byte_at = best[:, :, None] + np.arange(WIDTH)
        np.add.at(g_embed, rows[np.arange(len(rows))[:, None, None], byte_at].reshape(-1), g_input.reshape(-1, SIZE))
        return [g_embed, g_filters.astype(np.float32), g_pool.sum(0).astype(np.float32), g_out]


def train(texts: list[bytes], target: np.ndarray, share: float, seed: int = 0) -> Network:
    """Fit by Adam; ``share`` is the share of label 1 outside the sample, to which rows are weighted."""
    net, rng = Network(seed), np.random.default_rng(seed)
    cut = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        cut.append(chunks(data, np.array([0, len(data)]))[0])
    seen_share = min(0.999, max(0.001, float(target.mean())))
    weight = np.where(target == 1, share / seen_share, (1 - share) / (1 - seen_share))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    per_pass = -(-len(texts) // BATCH)
    passes = max(EPOCHS, -(-LEAST_STEPS // per_pass))
    step, total = 0, passes * per_pass
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            step += 1
            mine = order[at : at + BATCH]
            picked = [cut[i][np.sort(rng.permutation(len(cut[i]))[:CHUNKS_PER_ROW])] for i in mine]
            grads = net.gradients(np.concatenate(picked), np.array([len(x) for x in picked]), target[mine], weight[mine])
            rate = 0.02 * (1 - step / (total + 1))
            for p, g, (m, v) in zip(net.parameters(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def learn(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on at most ``MOST_ROWS`` labelled rows of each label; with none, every text scores one half."""
    rows = labelled(docs, labels, "quality", MOST_ROWS).select("label", F.col("text").cast("binary").alias("text")).toArrow()
    pairs = sorted(zip(rows.column("text").to_pylist(), rows.column("label").to_pylist(), strict=True))
    if not pairs:
        return Network()
    from rejoinder.llm.columns import held_out

    share = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).agg(F.avg("quality")).first()[0]
    return train([t for t, _ in pairs], np.array([y for _, y in pairs], float), share)


def score(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """``docs`` with a new column ``name`` between 0 and 1; a null text is scored as empty. ``name`` must be new."""
    shipped = docs.sparkSession.sparkContext.broadcast(net.parameters())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network()
        own.embed, own.filters, own.shift, own.out = shipped.value
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                scores = own.probability(*chunks(*flat(part.column(text))))
                columns = [*part.columns[:-1], pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], name])

    (text,) = fresh(docs, "content")
    keyed = docs.withColumn(text, F.coalesce("text", F.lit("")))
    return keyed.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The score of every row of ``docs`` with its fold and its prediction."""
    return report(docs, score(docs.select("doc_id", "text"), learn(docs, labels)), THRESHOLD)
