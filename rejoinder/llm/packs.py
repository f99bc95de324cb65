"""Whole documents in packs, and questions that packs put to hashed buckets.

A pack is a run of whole rows of one input partition, about ``PACK_BYTES`` of text, written once
to the shared folder under an id of its own; so a lost executor never changes what a pack holds.
A question travels as one compressed block per (pack, bucket) in place of one row per item,
and its answer comes back in the order of the question, so neither keys nor positions return.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.text import release
from rejoinder.session import scratch_path

PACK_BYTES = 24 << 20
BUCKET_BYTES = 24 << 20

BLOCK_SCHEMA = "pack_id string, bucket int, block binary"


def squeeze(array: np.ndarray) -> bytes:
    """The bytes of an array, byte planes apart, compressed."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T if len(array) else np.zeros((0, 0), np.uint8)
    raw = np.ascontiguousarray(planes).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def expand(block: bytes, dtype) -> np.ndarray:
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(width, len(raw) // width)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def to_ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(data)) as reader:
        return reader.read_all()


def new_pack_id() -> str:
    return uuid.uuid4().hex


def gather(batches: Iterator[pa.RecordBatch], text_bytes: Callable[[pa.RecordBatch], int], most: int) -> Iterator[pa.Table]:
    """Batches joined to tables of about ``most`` bytes of text."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += text_bytes(batch)
        if size >= most:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
            release()
    if waiting:
        yield pa.Table.from_batches(waiting)
    release()


def written_packs(packs: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(packs.sparkSession, name)
    packs.write.parquet(path)
    return packs.sparkSession.read.schema(packs.schema).parquet(path), path


def bucket_count(packs: DataFrame, size_col: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets that hold about ``bucket_bytes`` of question each; their number grows with the input."""
    total = packs.agg(F.sum(size_col)).first()[0] or 0
    return max(1, -(-total // bucket_bytes))


def answered(questions: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """Answers to all questions of a bucket at once; ``answer`` returns one block for each given."""

    def run(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        answers = pa.array(answer(blocks), pa.binary())
        release()
        return pa.table({"pack_id": table.column("pack_id"), "bucket": table.column("bucket"), "block": answers})

    return questions.groupBy("bucket").applyInArrow(run, BLOCK_SCHEMA)


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes; buckets are equal ranges of the hash."""
    high = sorted_hashes >> np.uint64(32)
    bucket = (high * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def in_order(replies: pa.Table) -> list[bytes]:
    """The blocks of a pack's answers by bucket, which is the order of its sorted question."""
    rows = zip(replies.column("bucket").to_pylist(), replies.column("block").to_pylist(), strict=True)
    return [block for _, block in sorted(rows)]
