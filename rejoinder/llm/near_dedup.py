"""Near-duplicate detection by DartMinHash and banding (operator 10).

A text is a weighted set: its word shingles with their counts. Every unit of weight of every
shingle is a region along a rank axis; hashed darts fall into it as a Poisson process, so
that equal regions receive equal darts in all texts. A dart names one of ``DARTS`` coordinates
and each coordinate keeps its earliest dart. Two texts agree in a coordinate with the
probability of their weighted Jaccard similarity. A text only draws darts up to a rank that
fills all coordinates, about k ln k + 2k of them whatever its length.

Coordinates are banded; texts that share a band are candidates; candidates are compared
exactly. Links are found between different texts only, copies are collapsed before. Within a
bucket, texts are compared with its smallest id first; only where that leaves a bucket in
several components are the remaining pairs across components compared too, inside the join of the
bucket, which gives out links and not pairs. So no link within a bucket can change the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.columns import fresh
from rejoinder.llm.components import components
from rejoinder.llm.text import ALPHANUMERIC, U64, Words, flat, inside_text, mix, slices, windows
from rejoinder.session import written

SHINGLE = 5
SIMILARITY = 0.8
DARTS = 224
ROWS = 7
BANDS = DARTS // ROWS  # a pair at the limit shares no band with probability (1 - 0.8 ** 7) ** 32 = 0.0005
#: Four bits of each coordinate go with a candidate, as this many bit planes of ``PLANE`` numbers each.
PLANES = 4
PLANE = -(-DARTS // 64)
#: Texts at the limit differ in 42 of 224 such values; more than this many differ with a probability of
#: about one in ten thousand, less than banding loses, and the pair is not compared.
MOST_UNLIKE = 64
#: Bytes kept of a region's number where sets of regions are compared.
REGION_BYTES = 6
#: Bits of the map of texts that share a bucket: 8 MB. One row of it, as Spark's bitmap functions cut it, holds 32,768.
SLOTS = 1 << 26
SLOTS_OF_ROW = 1 << 15
#: Common share of two texts' regions at the limit, s / (1 + s), less a five-hundredth because a shape keeps
#: 32 bits of a number and its rare collisions may hide a region.
LEAST_COMMON = 0.998 * SIMILARITY / (1 + SIMILARITY)
SLICE_BYTES = 2 << 20
#: Rounds of comparing a bucket with its smallest remaining text before all remaining pairs are compared.
HUB_ROUNDS = 2


def regions(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit regions (a number for each shingle and copy) by text, their text, and a digest of each text's words.

    Words are runs of letters and digits in lower case. A text with fewer words than a shingle has
    one shingle of all its words, a text without words has none and digest 0.
    """
    words = Words(*flat(pc.utf8_lower(texts)), ALPHANUMERIC)
    n = len(texts)
    count = np.diff(words.first)
    owner = np.repeat(np.arange(n), count)
    ok = inside_text(words.first, shingle)
    value, whose = windows(words.hash, shingle)[ok], owner[: len(ok)][ok]
    digest = np.zeros(n, U64)
    if len(words):
        place = np.arange(len(words), dtype=U64) - words.first[:-1][owner].astype(U64)
        total = mix(words.hash + mix(place))
        some = np.flatnonzero(count)
        digest[some] = mix(np.add.reduceat(total, words.first[:-1][some]) + count[some].astype(U64))
    short = np.flatnonzero((count > 0) & (count < shingle))
    value, whose = np.concatenate([value, digest[short]]), np.concatenate([whose, short])
    order = np.lexsort((value, whose))
    value, whose = value[order], whose[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (whose[1:] != whose[:-1])
    start = np.flatnonzero(first)
    copy = np.arange(len(value)) - np.repeat(start, np.diff(np.append(start, len(value))))
    return mix(value + copy.astype(U64) * U64(0xD1B54A32D192ED03)), whose, digest


def dart_minhash(region: np.ndarray, owner: np.ndarray, n: int, darts: int = DARTS) -> np.ndarray:
    """The earliest dart of every coordinate for each of ``n`` texts; a text without regions has zeros."""
    size = np.bincount(owner, minlength=n)
    out = np.full(n * darts, np.iinfo(U64).max, U64)
    reach = darts * (np.log(darts) + 2) / np.maximum(size, 1)  # rank up to which darts are drawn
    todo = np.flatnonzero(size)
    while len(todo):
        chosen = np.zeros(n, bool)
        chosen[todo] = True
        keep = chosen[owner]
        live, whose, rank, turn = region[keep], owner[keep], np.zeros(int(keep.sum())), 0
        while len(live):
            turn += 1
            drawn = mix(live + U64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log(((drawn >> U64(11)).astype(float) + 0.5) * 2.0**-53)
            inside = rank < reach[whose]
            live, whose, rank, drawn = live[inside], whose[inside], rank[inside], drawn[inside]
            tag = mix(drawn)
            # earlier rank first; the low bits tell darts apart. Positive floats order as their bits do.
            dart = (rank.view(U64) & ~U64(0xFFFFF)) | (tag & U64(0xFFFFF))
            np.minimum.at(out, whose * darts + ((tag >> U64(20)) % U64(darts)).astype(np.int64), dart)
        reach *= 2
        table = out.reshape(n, darts)
        todo = todo[(table[todo] == np.iinfo(U64).max).any(1)]
    out.reshape(n, darts)[size == 0] = 0
    return out.reshape(n, darts)


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number for each band; the band's place is part of it."""
    n, darts = signature.shape
    out = np.repeat(np.arange(1, darts // rows + 1, dtype=U64)[None], n, 0)
    for k in range(rows):
        out = mix(out * U64(0x9E3779B97F4A7C15) + signature[:, k::rows][:, : out.shape[1]])
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            region, owner, digest = regions(part.column("text"))
            n = part.num_rows
            size = np.bincount(owner, minlength=n)
            darts = dart_minhash(region, owner, n)
            keys = bands(darts).view(np.int64)
            sketch = np.zeros((n, PLANES, PLANE * 8), np.uint8)
            for plane in range(PLANES):
                bits = np.packbits(((darts >> U64(plane)) & U64(1)).astype(bool), axis=1)
                sketch[:, plane, : bits.shape[1]] = bits
            sketches = pa.FixedSizeListArray.from_arrays(pa.array(sketch.reshape(-1).view(np.int64)), PLANES * PLANE).cast(pa.list_(pa.int64()))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part.column("doc_id"), "digest": pa.array(digest.view(np.int64)), "size": pa.array(size.astype(np.int64)), "sketch": sketches, "keys": lists}
            )


#: A sketch has a column for each number, which keeps the code of the join's condition small enough to be compiled.
SKETCH = [f"sketch_{p}_{k}" for p in range(PLANES) for k in range(PLANE)]
UNLIKE = " + ".join("bit_count(" + " | ".join(f"(sketch_{p}_{k} ^ other_sketch_{p}_{k})" for p in range(PLANES)) + ")" for k in range(PLANE))
FITS = f"least(size, other) >= {SIMILARITY} * greatest(size, other) - 1e-6 AND {UNLIKE} <= {MOST_UNLIKE}"


def _other(columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"other_{c}") for c in columns]


def _sets_of(texts: DataFrame, buckets: DataFrame) -> DataFrame:
    """(doc_id, regions, shape) of at least all texts in ``buckets``, written.

    A bitmap of ``SLOTS`` bits, whatever the input, tells which texts may be in a bucket, so that texts are read where
    they are and not shuffled. A text that only shares a slot with another does no harm.
    """
    slot = lambda column: F.pmod(F.xxhash64(column), F.lit(SLOTS))
    used = buckets.select(slot("head").alias("slot"))
    rows = used.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bitmap = np.zeros((SLOTS // SLOTS_OF_ROW + 1, SLOTS_OF_ROW // 8), np.uint8)
    for row in rows:  # at most SLOTS / SLOTS_OF_ROW + 1
        bitmap[row.part] = np.frombuffer(row.bits, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            bit = (shared.value[batch.column("part").to_numpy(), place // 8] >> (place % 8).astype(np.uint8)) & 1
            yield from _region_sets(batch.filter(pa.array(bit.astype(bool))))

    id_type = texts.schema["doc_id"].dataType.simpleString()
    placed = texts.where("doc_id IS NOT NULL").withColumn("slot", slot("doc_id"))
    placed = placed.select("doc_id", "text", F.bitmap_bucket_number("slot").alias("part"), F.bitmap_bit_position("slot").alias("place"))
    found = written(placed.mapInArrow(sets, f"doc_id {id_type}, regions binary, shape array<int>"), "regions")
    shared.destroy()  # the table is written, no task reads the bitmap again
    return found


def _region_sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The regions of each text, ``REGION_BYTES`` bytes each, and its shape, 32 bits of each."""
    if batch.num_rows:
        for part in slices(batch, "text", SLICE_BYTES):
            region, owner, _ = regions(part.column("text"))
            places = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(owner, minlength=part.num_rows))])
            data = np.ascontiguousarray(region.view(np.uint8).reshape(-1, 8)[:, :REGION_BYTES])
            offsets = (places * REGION_BYTES).astype(np.int32)
            sets = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            shape = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array((region >> U64(32)).astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets, shape], ["doc_id", "regions", "shape"])


def _numbered(sets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The regions of some sets, each below the number of its set in the upper bits, and their count by set."""
    data, offsets = flat(sets)
    wide = np.zeros((len(data) // REGION_BYTES, 8), np.uint8)
    wide[:, :REGION_BYTES] = data.reshape(-1, REGION_BYTES)
    size = np.diff(offsets) // REGION_BYTES
    owner = np.repeat(np.arange(len(size), dtype=U64), size)
    return wide.reshape(-1).view(U64) | (owner << U64(8 * REGION_BYTES)), size


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose weighted Jaccard similarity reaches the limit."""
    for batch in batches:
        for part in slices(batch, "left_set", SLICE_BYTES):  # far fewer rows than the upper bits can number
            a, of_a = _numbered(part.column("left_set"))
            b, of_b = _numbered(part.column("right_set"))
            value = np.sort(np.concatenate([a, b]))
            twice = value[1:][value[1:] == value[:-1]] >> U64(8 * REGION_BYTES)
            shared = np.bincount(twice.astype(np.int64), minlength=part.num_rows)
            near = pa.array(shared >= SIMILARITY * (of_a + of_b - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v")], ["u", "v"]).filter(near)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("u"), F.col("regions").alias("left_set"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("regions").alias("right_set"))
    id_type = sets.schema["doc_id"].dataType.simpleString()
    joined = pairs.join(left, "u").join(right, "v").select("u", "v", "left_set", "right_set")
    return joined.mapInArrow(_compared, f"u {id_type}, v {id_type}")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, kept) for every row: the smallest id of its class of near copies, and whether it is that row.

    Two texts are linked if the weighted Jaccard similarity of their five-word shingles is at least
    0.8; classes are the connected components. Texts with the same words in the same order are
    always linked. A text without words, null texts too, is a class of its own, and so is a row
    without an id (class null, kept). Rows that repeat an id share its class.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = written(texts.mapInArrow(_signed, f"doc_id {id_type}, digest bigint, size bigint, sketch array<bigint>, keys array<bigint>"), "darts")
    filled = signed.where("size > 0 AND doc_id IS NOT NULL")
    heads = filled.groupBy("digest", "size").agg(F.min("doc_id").alias("head"))
    own = filled.join(heads, ["digest", "size"]).where("doc_id = head").dropDuplicates(["digest", "size"])
    own = written(own.select("head", "size", "sketch", "keys"), "heads")
    members = own.select("head", F.explode("keys").alias("key"))  # narrow: most buckets hold one text and end here
    crowded = members.groupBy("key").agg(F.count("*").alias("n"), F.min("head").alias("hub")).where("n > 1")
    crowd = members.join(crowded.select("key", "hub"), "key")
    buckets = written(crowd.join(own.select("head", "size", *[F.col("sketch")[n].alias(c) for n, c in enumerate(SKETCH)]), "head"), "buckets")
    sets = _sets_of(texts, buckets)

    roots, inside = buckets.select(F.col("head").alias("u"), F.col("hub").alias("root")).limit(0), buckets
    for _ in range(HUB_ROUNDS):
        hubs = inside.where("head = hub").select("key", F.col("size").alias("other"), *_other(SKETCH))
        pairs = written(
            inside.join(hubs, "key").where(f"head <> hub AND {FITS}").select(F.col("head").alias("u"), F.col("hub").alias("v")).distinct(), "pairs"
        )
        roots = _joined_roots(roots, written(_verified(pairs, sets), "links"))
        # texts that are not in the component of their bucket's hub go on to the next round
        head_root, hub_root = _root_of(roots, "head", "head_root"), _root_of(roots, "hub", "hub_root")
        strays = (
            inside.join(head_root, "head", "left").join(hub_root, "hub", "left")
            .where("coalesce(head_root, head) <> coalesce(hub_root, hub)").select("key", "head", "size", *SKETCH)
        )
        next_hub = strays.groupBy("key").agg(F.min("head").alias("hub"))
        inside = written(strays.join(next_hub, "key"), "strays")

    # All pairs of a bucket that are still in different components: at least one of the two is not in the component
    # of the bucket's hub. They are compared where they meet, so that only links leave the join.
    rooted = (
        buckets.join(_root_of(roots, "head", "root"), "head", "left").join(_root_of(roots, "hub", "hub_root"), "hub", "left")
        .select("key", "head", "size", *SKETCH, F.coalesce("root", "head").alias("root"), F.expr("coalesce(root, head) <> coalesce(hub_root, hub)").alias("stray"))
    )
    mixed = rooted.groupBy("key").agg(F.max("stray").alias("mixed")).where("mixed").select("key")
    shapes = own.select("head", "keys").join(sets.select(F.col("doc_id").alias("head"), "shape"), "head")
    left = rooted.join(mixed, "key", "left_semi").join(shapes, "head").withColumn("earlier", F.expr("slice(keys, 1, cast(greatest(array_position(keys, key) - 1, 0) AS int))"))
    left = written(left, "mixed")
    right = left.where("stray").select("key", *_other(["head", "root", "keys", "shape", *SKETCH]), F.col("size").alias("other"))
    alike = f"size(array_intersect(shape, other_shape)) >= {LEAST_COMMON} * (size + other)"
    across = left.join(right, "key").where(f"root <> other_root AND (NOT stray OR head > other_head) AND {FITS} AND NOT arrays_overlap(earlier, other_keys) AND {alike}")
    across = written(across.select(F.greatest("head", "other_head").alias("u"), F.least("head", "other_head").alias("v")).distinct(), "pairs")
    roots = _joined_roots(roots, written(_verified(across, sets), "links"))

    classes = heads.join(_root_of(roots, "head", "root"), "head", "left").select("digest", "size", F.coalesce("root", "head").alias("class_id"))
    return signed.join(classes, ["digest", "size"], "left").select(
        "doc_id",
        F.when(F.col("size") > 0, F.when(F.col("doc_id").isNotNull(), F.col("class_id"))).otherwise(F.col("doc_id")).alias("class_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def _joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots of known components and new links; a node and its root stand for all older links."""
    return roots if links.isEmpty() else components(roots.select("u", F.col("root").alias("v")).unionByName(links))


def _root_of(roots: DataFrame, node: str, name: str) -> DataFrame:
    return roots.select(F.col("u").alias(node), F.col("root").alias(name))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with their columns; rows without an id stay."""
    (gone,) = fresh(docs, "gone")
    dropped = near_duplicate_classes(docs).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped[gone], "left_anti")
