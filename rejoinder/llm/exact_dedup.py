"""Exact deduplication by Grace hash partitioning (operator 8).

Equal texts meet in one task by a shuffle on a 64-bit hash of the text, after every input
partition has dropped its own copies, so a text that a third of all rows share sends one row
for each partition. Inside a task an open-addressing table compares complete contents. When a
table outgrows its memory, its entries and the rest of the rows go to spill files chosen by the
next bits of the hash, and each file is handled in the same way. Spill files belong to one task
attempt alone and go with it, so a lost executor costs a rerun of its tasks and nothing else.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rejoinder.llm.columns import fresh

#: Memory that the contents of one table may take before it is partitioned.
TABLE_BYTES = 64 << 20
#: Hash bits, and so spill files, used by one round of partitioning.
ROUND_BITS = 4
HASH_BITS = 64

Record = tuple[int, tuple, int]  # hash of the text, row, number of rows it stands for


class ContentTable:
    """Open addressing with linear probing, keyed by complete text."""

    def __init__(self, text_at: int, id_at: int):
        self.text_at, self.id_at = text_at, id_at
        self.slots, self.hashes, self.rows, self.counts, self.bytes = [-1] * 256, [], [], [], 0

    def _slot(self, h: int, text: str) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.rows[entry][self.text_at] == text:
                break
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        for entry, (h, row) in enumerate(zip(self.hashes, self.rows, strict=True)):
            self.slots[self._slot(h, row[self.text_at])] = entry

    def _stays(self, new: tuple, old: tuple) -> bool:
        a, b = new[self.id_at], old[self.id_at]
        if a == b:
            return repr(new) > repr(old)
        return b is None or (a is not None and a > b)

    def add(self, h: int, row: tuple, count: int) -> None:
        at = self._slot(h, row[self.text_at])
        entry = self.slots[at]
        if entry >= 0:
            self.counts[entry] += count
            if self._stays(row, self.rows[entry]):
                self.rows[entry] = row
            return
        self.slots[at] = len(self.rows)
        self.hashes.append(h)
        self.rows.append(row)
        self.counts.append(count)
        self.bytes += 400 + 4 * len(row[self.text_at])
        if 2 * len(self.rows) > len(self.slots):
            self._grow()

    def __iter__(self) -> Iterator[Record]:
        return zip(self.hashes, self.rows, self.counts, strict=True)


class SpillFiles:
    """One file for each value of the hash bits of this round."""

    def __init__(self, level: int):
        self.shift = HASH_BITS - ROUND_BITS * (level + 1)
        self.files = [tempfile.TemporaryFile() for _ in range(1 << ROUND_BITS)]

    def add(self, record: Record) -> None:
        pickle.dump(record, self.files[(record[0] >> self.shift) & (len(self.files) - 1)], pickle.HIGHEST_PROTOCOL)

    def each(self) -> Iterator[Iterator[Record]]:
        for file in self.files:
            file.seek(0)
            yield self._read(file)
            file.close()

    @staticmethod
    def _read(file) -> Iterator[Record]:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace(records: Iterable[Record], text_at: int, id_at: int, table_bytes: int, level: int = 0) -> Iterator[Record]:
    """One record for each distinct text: its row with the largest id, and the rows counted."""
    table, spilled = ContentTable(text_at, id_at), None
    for record in records:
        if spilled is not None:
            spilled.add(record)
            continue
        table.add(*record)
        if table.bytes > table_bytes and ROUND_BITS * (level + 1) <= HASH_BITS:
            spilled = SpillFiles(level)
            for entry in table:
                spilled.add(entry)
            table = None
    if spilled is None:
        yield from table
        return
    for part in spilled.each():
        yield from grace(part, text_at, id_at, table_bytes, level + 1)


def _task(schema: T.StructType, text_at: int, id_at: int, table_bytes: int):
    """The function for ``mapInArrow``: rows end with the hash and the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow: list[pa.Schema] = []

        def records() -> Iterator[Record]:
            for batch in batches:
                arrow[:] = [batch.schema]
                *columns, hashes, counts = (c.to_pylist() for c in batch.columns)
                for row, h, n in zip(zip(*columns, strict=True), hashes, counts, strict=True):
                    yield h & 0xFFFFFFFFFFFFFFFF, row, n

        def batch_of(rows: list[Record]) -> pa.RecordBatch:
            signed = [h - (1 << 64) if h >> 63 else h for h, _, _ in rows]
            columns = [*zip(*(row for _, row, _ in rows), strict=True), signed, [n for _, _, n in rows]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow[0], strict=True)], schema=arrow[0]
            )

        waiting, size = [], 0
        for record in grace(records(), text_at, id_at, table_bytes):
            waiting.append(record)
            size += len(record[1][text_at])
            if size > 4 << 20 or len(waiting) >= 5000:
                yield batch_of(waiting)
                waiting, size = [], 0
        if waiting:
            yield batch_of(waiting)

    return run


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """The row with the largest id of every group of equal texts, with all its columns.

    Texts are compared as they are; a null text counts as empty. A null id is smaller than any
    other; of rows with one text and one id, exactly one stays (the greatest by its printed
    form). ``count_col`` names a new column with the number of rows of the group; it must not be
    a column of ``docs``. An empty table gives an empty table. Other columns keep name and value.
    """
    h, n, text = fresh(docs, "h", "n", "content")
    content = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn(text, content).withColumn(h, F.xxhash64(text)).withColumn(n, F.lit(1).cast("bigint"))
    # the shared form of a null text is dropped again below
    names = keyed.columns
    task = _task(keyed.schema, names.index(text), names.index(id_col), table_bytes)
    merged = keyed.mapInArrow(task, keyed.schema).repartition(h).mapInArrow(task, keyed.schema)
    kept = merged.select(*docs.columns, *([F.col(n).alias(count_col)] if count_col else []))
    return kept


def duplicate_report(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """For each row of ``docs``: the row that stays of its group, the group's size, its own fate and its digest.

    Rows that repeat one id and one text are reported as often as they occur; one of them is
    marked kept if that id stays. Null texts count as empty.
    """
    narrow = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    classes = distinct_documents(narrow, count_col="group_size", table_bytes=table_bytes).select(
        F.sha2("text", 256).alias("text_sha256"), F.col("doc_id").alias("keep_id"), "group_size"
    )
    # copies of one row are counted before the join; the copies of one text may be a third of
    # all rows, and the adaptive skew join splits them
    members = narrow.select("doc_id", F.sha2("text", 256).alias("text_sha256")).groupBy("doc_id", "text_sha256").count()
    return (
        members.join(classes, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "count")))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
        )
    )
