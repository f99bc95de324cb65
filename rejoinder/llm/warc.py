"""WARC archives of captured pages, and a two-level index that finds captures by URL.

Writing: every capture becomes one gzip member of a ``.warc.gz`` file, so that it can be read alone. Of captures with
equal payloads the one with the largest id is a response, the others are revisits that name it. Tasks write
whole files under names of their own and tell what they wrote; files of a lost or repeated task are not
named by any row and are never read.

Index: captures are sorted by their URL key (host reversed, ``com,example,www)/path?query``) in ranges. A range is one file
of compressed blocks of ``BLOCK_LINES`` lines, with a sparse directory that has one line for each block. The driver
keeps two keys for each range, whose number is the number of partitions and not that of captures.

Reading: a request goes to the ranges that may hold its key. There it is searched in the directory, then in the blocks,
and the records found are read by ranges of bytes, neighbours together. A URL with very many captures is spread
over several ranges, so no task reads more than a range.

Nulls: a null html is an empty payload, a null url has the empty key, a null id is below all others. Rows with the
largest id of their payload are responses, also where the id repeats; every row gives one record. Other columns are not
read. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import drop_path
from rejoinder.session import scratch_path, written

#: The table has no time of capture; every record gets this one.
CAPTURED = "1970-01-01T00:00:00Z"
LEAST_PAYLOAD = 0

ARCHIVE_BYTES = 256 << 20
LEVEL = 4
BLOCK_LINES = 512
#: Records that lie closer than this are read at once, up to so many bytes.
GAP_BYTES = 32 << 10
READ_BYTES = 8 << 20

CAPTURE_SCHEMA = "key string, file string, start bigint, size bigint"
RANGE_SCHEMA = "part string, lines bigint, first_key binary, last_key binary"
RECORD_SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def url_key(url: str | None) -> str:
    """The host reversed, then path and query, without scheme, default port and fragment; no host: the text behind ``)``."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return ")" + quote(url, safe="%:/?=&;,+#[]@!$'()*~")
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        host = f"{host}:{port}"
    name, colon, number = host.partition(":")
    turned = ",".join(reversed(name.split("."))) + colon + number
    rest = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    return turned + ")" + quote(rest, safe="%:/?=&;,+[]@!$'()*~")


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _member(text: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.flush()


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, captured: str = CAPTURED) -> bytes:
    """One response, or a revisit of ``refers_to`` that leaves the payload out but keeps the HTTP header with its length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {captured}",
        *([] if url is None else [f"WARC-Target-URI: {quote(url, safe='%:/?=&;,+#[]@!$()*~' + chr(39))}"]),
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        *([] if refers_to is None else [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _number(name: str | None) -> int | None:
    found = re.search(r"urn:page:(-?\d+)", name or "")
    return int(found[1]) if found else None


def parsed(text: bytes) -> dict:
    """One record as a row; the digest of a payload that is there is taken anew and has to agree."""
    head, _, rest = text.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(http)["content-length"])
    told = warc["warc-payload-digest"].removeprefix("sha1:")
    revisit = warc["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or digest_of(payload) != told):
        raise ValueError(f"damaged record {warc['warc-record-id']}")
    url = warc.get("warc-target-uri")
    return {
        "page_id": _number(warc["warc-record-id"]), "url": None if url is None else unquote(url), "payload_bytes": size, "payload_digest": told,
        "record_type": warc["warc-type"], "refers_to": _number(warc.get("warc-refers-to")), "payload": None if revisit else payload,
    }


def _archived(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (page_id, url, payload, refers_to) to archives below ``folder``, and where each record stands."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows: dict[str, list] = {"key": [], "file": [], "start": [], "size": []}
            for page_id, url, payload, refers in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    note = b"software: rejoinder\r\nformat: WARC File Format 1.1\r\n"
                    info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {CAPTURED}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(note)}\r\n\r\n"
                    at += out.write(_member(info.encode() + note + b"\r\n\r\n"))
                url = url.as_py()
                member = _member(record(page_id.as_py(), url, payload.as_buffer().to_pybytes(), refers.as_py()))
                out.write(member)
                for column, value in (("key", url_key(url)), ("file", name), ("start", at), ("size", len(member))):
                    rows[column].append(value)
                at += len(member)
            yield pa.RecordBatch.from_pydict({"key": pa.array(rows["key"], pa.string()), "file": pa.array(rows["file"], pa.string()), "start": pa.array(rows["start"], pa.int64()), "size": pa.array(rows["size"], pa.int64())})
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, folder: str, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Archives of all rows of ``pages`` (page_id, url, html) in ``folder``: (key, file, start, size) of each record.

    Captures below ``least_payload`` bytes are all responses. Only digests are grouped; payloads move once, to the join
    with the few digests that several ids share, which Spark splits at a payload with very many captures.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    captures = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = captures.where(F.octet_length("payload") >= least_payload)
    shared = large.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("least"), F.count(F.when(F.col("page_id").isNull(), 1)).alias("nameless"))
    shared = shared.where("last is not null and (least < last or nameless > 0)").select("digest", "last")
    told = captures.join(shared, "digest", "left")
    refers = F.when((F.octet_length("payload") >= least_payload) & F.coalesce(F.col("page_id") < F.col("last"), F.lit(True)), F.col("last"))
    _made(spark, folder)
    return written(told.select("page_id", "url", "payload", refers.alias("refers_to")).mapInArrow(_archived(folder), CAPTURE_SCHEMA), "warc-captures")


def _made(spark, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def _indexed(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted captures of one range to a file of blocks and its directory."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        part, at, lines, directory, block = uuid.uuid4().hex, 0, 0, [], []
        out, last = None, b""

        def close_block() -> None:
            nonlocal at, block
            packed = zlib.compress(b"\n".join(block), LEVEL)
            directory.append(b"%s\t%d\t%d" % (block[0].split(b"\t")[0], at, len(packed)))
            at += out.write(packed)
            block = []

        for batch in batches:
            if out is None and batch.num_rows:
                out = store.open_output_stream(f"{root}/{part}.blocks", compression=None)
            for key, file, start, size in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "start", "size")), strict=True):
                last = key.encode()
                block.append(b"%s\t%s\t%d\t%d" % (last, file.encode(), start, size))
                lines += 1
                if len(block) == BLOCK_LINES:
                    close_block()
        if out is None:
            return
        if block:
            close_block()
        out.close()
        with store.open_output_stream(f"{root}/{part}.directory", compression=None) as book:
            book.write(b"\n".join(directory))
        yield pa.RecordBatch.from_pydict({"part": [part], "lines": [lines], "first_key": [directory[0].split(b"\t")[0]], "last_key": [last]})

    return write


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """The index of ``captures`` in ``folder``: one row (part, lines, first_key, last_key) for each range."""
    order = ["key", "file", "start"]
    _made(captures.sparkSession, folder)
    return written(captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_indexed(folder), RANGE_SCHEMA), "warc-ranges")


class _Range:
    """One range of the index: its directory, and the block read last."""

    def __init__(self, store: fs.FileSystem, root: str, part: str):
        with store.open_input_file(f"{root}/{part}.directory") as book:
            rows = [line.split(b"\t") for line in book.read().split(b"\n")]
        self.first, self.at = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
        self.file, self.held, self.lines, self.keys = store.open_input_file(f"{root}/{part}.blocks"), -1, [], []

    def _open(self, block: int) -> None:
        if block != self.held:
            start, size = self.at[block]
            self.file.seek(start)
            self.lines = [line.split(b"\t") for line in zlib.decompress(self.file.read(size)).split(b"\n")]
            self.keys, self.held = [line[0] for line in self.lines], block

    def find(self, key: bytes) -> Iterator[tuple[str, int, int]]:
        block = max(0, bisect_left(self.first, key) - 1)  # the block before may end with the key
        while block < len(self.first) and self.first[block] <= key:
            self._open(block)
            for k in range(bisect_left(self.keys, key), len(self.keys)):
                if self.keys[k] != key:
                    return
                yield self.lines[k][1].decode(), int(self.lines[k][2]), int(self.lines[k][3])
            block += 1


def _read_records(store: fs.FileSystem, root: str, places: list[tuple[str, int, int]]) -> Iterator[bytes]:
    """The records at (file, start, size), neighbours in one read."""
    places.sort()
    i = 0
    while i < len(places):
        name, begin, size = places[i]
        j, end = i + 1, begin + size
        while j < len(places) and places[j][0] == name and places[j][1] - end <= GAP_BYTES and places[j][1] + places[j][2] - begin <= READ_BYTES:
            end = places[j][1] + places[j][2]
            j += 1
        with store.open_input_file(f"{root}/{name}") as file:
            file.seek(begin)
            data = file.read(end - begin)
        for _, start, length in places[i:j]:
            yield zlib.decompress(data[start - begin : start - begin + length], 31)
        i = j


def lookup(keys: DataFrame, ranges: DataFrame, index_folder: str, archive_folder: str, payloads: bool = True) -> DataFrame:
    """All captures of the URL keys in ``keys`` (column key; repeats do no harm), as rows of records."""
    held = sorted((bytes(r.first_key), bytes(r.last_key), r.part) for r in ranges.collect())  # two keys for each partition
    firsts = [h[0] for h in held]
    lasts = [h[1] for h in held]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, asked = [], []
            for key in batch.column("key").to_pylist():
                k = bisect_left(lasts, key.encode())  # ranges follow each other: the first whose end is not below the key
                while k < len(firsts) and firsts[k] <= key.encode():
                    parts.append(held[k][2])
                    asked.append(key)
                    k += 1
            yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.string()), "key": pa.array(asked, pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(index_folder)
        archives, top = _place(archive_folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def told(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] if payloads or n != "payload" else None for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)

        opened, now = None, None
        for batch in batches:
            places: list[tuple[str, int, int]] = []
            for part, key in zip(batch.column("part").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if part != now:
                    opened, now = _Range(store, root, part), part
                places.extend(opened.find(key.encode()))
            rows, size = [], 0
            for text in _read_records(archives, top, places):
                rows.append(parsed(text))
                size += len(text)
                if size > READ_BYTES:
                    yield told(rows)
                    rows, size = [], 0
            if rows:
                yield told(rows)

    routed = keys.select("key").distinct().mapInArrow(route, "part string, key string")
    return routed.repartition("part").sortWithinPartitions("part", "key").mapInArrow(read, RECORD_SCHEMA)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"key": pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())})


def url_keys(pages: DataFrame) -> DataFrame:
    """The key of every url."""
    return pages.select("url").mapInArrow(_keys, "key string")


def archive_report(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write all pages, index them, and read every capture back by its URL: one row per page."""
    spark = pages.sparkSession
    archives, index = scratch_path(spark, "warc-archives"), scratch_path(spark, "warc-index")
    ranges = write_index(write_archives(pages, archives, least_payload), index)
    rows = written(lookup(url_keys(pages), ranges, index, archives, payloads=False).drop("payload", "url"), "warc-records")
    drop_path(spark, archives)
    drop_path(spark, index)
    return rows
