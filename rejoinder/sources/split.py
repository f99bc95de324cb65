"""CSV and JSON arrays whose records hold line breaks, read by byte ranges of one file in many tasks.

Spark's text reader cuts a file at any byte range and gives whole pieces between separators: lines for CSV,
what lies between closing braces for JSON. Whether a piece begins inside quotes, and how deep, is known
only from all that is before it. So the ranges are read twice. First each range tells what it does to either state
it may begin in; these few numbers, one row for each range, are put together in file order. Then each range
is read again with its state and its pieces are joined to records. A record that crosses ranges is put
together from the last piece of one range and the first of the next ones.

The separators are ``\\n`` and ``}``; a carriage return stays part of the text. Compressed files are one range.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_SCHEMA = "file string, start bigint, quoted boolean, ends_quoted boolean, depth bigint, pieces bigint"
PIECE_SCHEMA = "file string, start bigint, part int, number bigint, text string"

#: Kinds of rows of the second pass: a whole record, the end of one that began before, the beginning of one that goes on, a range inside one.
WHOLE, END, BEGIN, INSIDE = 0, 1, 2, 3


class Layout(NamedTuple):
    separator: str
    opens: bytes
    closes: bytes
    escape: bytes  # a byte that takes the meaning from the next one inside quotes; none where quotes are doubled
    level: int  # the depth at which a record ends


CSV_LINES = Layout("\n", b"", b"", b"", 0)
JSON_OBJECTS = Layout("}", b"{[", b"}]", b"\\", 1)


def _escaped(data: np.ndarray, escape: int) -> np.ndarray:
    """Bytes that follow an odd run of escapes."""
    is_escape = data == escape
    place = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(is_escape, -1, place))
    run = place - last_other  # escapes up to and with this byte
    out = np.zeros(len(data), bool)
    out[1:] = is_escape[:-1] & (run[:-1] % 2 == 1)
    return out


def scanned(pieces: pa.Array, layout: Layout, quoted: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """State after each piece and its separator: inside quotes, and the depth outside of them."""
    ended = pc.binary_join_element_wise(pieces.cast(pa.large_binary()), pa.scalar(layout.separator.encode(), pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    _, offsets, data = ended.buffers()
    at = np.frombuffer(offsets, np.int64)[ended.offset : ended.offset + len(ended) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    last = at[1:] - at[0] - 1
    quotes = data == ord('"')
    if layout.escape and (data == layout.escape[0]).any():
        quotes &= ~_escaped(data, layout.escape[0])
    inside = (np.cumsum(quotes) + quoted) % 2 == 1
    if not layout.opens:
        return inside[last], np.zeros(len(last), np.int64)
    step = np.isin(data, list(layout.opens)).astype(np.int64) - np.isin(data, list(layout.closes))
    step[inside] = 0
    return inside[last], depth + np.cumsum(step)[last]


def _lines(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    text = spark.read.option("lineSep", layout.separator).text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The pieces of a batch by range; a task reads one range after the other."""
    start = batch.column("start").to_numpy()
    file = pc.dictionary_encode(batch.column("file")).indices.to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero((np.diff(start) != 0) | (np.diff(file) != 0)) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield (batch.column("file")[a].as_py(), int(start[a])), batch.column("value").slice(a, b - a)


def _summed(layout: Layout):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[tuple[str, int], list[list]] = {}
        for batch in batches:
            for key, pieces in _runs(batch):
                states = now.setdefault(key, [[False, 0, 0], [True, 0, 0]])
                for state in states:
                    quoted, depth = scanned(pieces, layout, state[0], state[1])
                    state[:] = [bool(quoted[-1]), int(depth[-1]), state[2] + len(pieces)]
        rows = [(file, start, began, *states[began]) for (file, start), states in now.items() for began in (0, 1)]
        if rows:
            columns = list(zip(*rows, strict=True))
            types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            names = ["file", "start", "quoted", "ends_quoted", "depth", "pieces"]
            yield pa.RecordBatch.from_arrays([pa.array([bool(x) for x in c] if t == pa.bool_() else c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return summarise


def _chained(table: pa.Table) -> pa.Table:
    """The state each range of one file begins in; a row for each range and state before."""
    does = {(r["start"], r["quoted"]): r for r in table.to_pylist()}
    quoted, depth, rows = False, 0, []
    for start in sorted({s for s, _ in does}):
        rows.append((start, quoted, depth))
        told = does[start, quoted]
        quoted, depth = told["ends_quoted"], depth + told["depth"]
    columns = list(zip(*rows, strict=True))
    return pa.table({"file": table.column("file")[: len(rows)], "start": pa.array(columns[0], pa.int64()), "quoted": pa.array(columns[1]), "depth": pa.array(columns[2], pa.int64())})


def _assembled(layout: Layout, states: dict[tuple[str, int], tuple[bool, int]]):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, held, number, open_before = None, (False, 0), [], 0, False

        def row(part: int, text: str) -> tuple:
            return (*key, part, number, text)

        def rest() -> list[tuple]:
            """What is left of a range: a record that goes on, or a range that is inside one."""
            return [row(INSIDE if open_before else BEGIN, layout.separator.join(held))] if key is not None and held else []

        for batch in batches:
            rows: list[tuple] = []
            for here, pieces in _runs(batch):
                if here != key:
                    rows += rest()
                    key, state, held, number = here, states[here], [], 0
                    open_before = state[0] or state[1] > layout.level
                quoted, depth = scanned(pieces, layout, *state)
                state = (bool(quoted[-1]), int(depth[-1]))
                done = ~quoted & (depth <= layout.level)
                texts, before = pieces.to_pylist(), 0
                for end in np.flatnonzero(done).tolist():
                    whole = layout.separator.join([*held, *texts[before : end + 1]])
                    rows.append(row(END if open_before else WHOLE, whole))
                    held, before, open_before, number = [], end + 1, False, number + 1
                held.extend(texts[before:])
            if rows:
                yield _piece_batch(rows)
        left = rest()
        if left:
            yield _piece_batch(left)

    return assemble


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["file", "start", "part", "number", "text"])


def records(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """(file, start, number, text) of every record: the range it begins in, its place there, its text without the last separator.

    The driver holds one state for each range (some 100 bytes for ``spark.sql.files.maxPartitionBytes`` of input), not one for a record.
    Records that cross ranges, at most one for each range, are the only rows that are shuffled.
    """
    sums = _lines(spark, path, layout).mapInArrow(_summed(layout), RANGE_SCHEMA)
    chained = sums.groupBy("file").applyInArrow(_chained, "file string, start bigint, quoted boolean, depth bigint")
    states = {(r.file, r.start): (r.quoted, r.depth) for r in chained.collect()}
    pieces = _lines(spark, path, layout).mapInArrow(_assembled(layout, states), PIECE_SCHEMA)
    whole = pieces.filter(F.col("part") == WHOLE).drop("part")
    crossing = pieces.filter(F.col("part") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "number")
    # the beginning of a record carries its range and number to the ranges it goes on in
    owner = F.last(F.when(F.col("part") == BEGIN, F.struct("start", "number")), True).over(order)
    owned = crossing.withColumn("_owner", owner).withColumn("_piece", F.struct("start", "text"))
    joined = owned.groupBy("file", "_owner").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    text = F.array_join(F.transform("_pieces", lambda p: p["text"]), layout.separator)
    return whole.unionByName(joined.select("file", "_owner.start", "_owner.number", text.alias("text")))


def read_csv(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """All columns as strings, from files that each begin with a header; quotes inside quotes are doubled."""
    names = spark.read.options(**options).csv(path).columns
    found = records(spark, path, CSV_LINES)
    rows = found.filter(~((F.col("start") == 0) & (F.col("number") == 0)) & (F.col("text") != ""))
    schema = ", ".join(f"`c{n}` string" for n in range(len(names)))
    own = {k: v for k, v in options.items() if k != "header"}
    parsed = rows.select(F.from_csv("text", schema, {**own, "lineSep": "\u0001"}).alias("_r"))
    return parsed.select(*[F.col(f"_r.c{n}").alias(name) for n, name in enumerate(names)])


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of arrays, one array or any run of objects per file; what is no object of this schema is null in its fields."""
    found = records(spark, path, JSON_OBJECTS)
    begins = F.instr("text", "{")
    objects = found.filter(begins > 0).select(F.concat(F.expr("substring(text, instr(text, '{'))"), F.lit("}")).alias("_o"))
    return objects.select(F.from_json("_o", schema).alias("_r")).select("_r.*")
