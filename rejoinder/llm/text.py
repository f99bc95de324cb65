"""Whole columns of text as one byte buffer, and the words in it as 64-bit numbers (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MOST_POWERS = 1 << 20
_powers: dict[int, np.ndarray] = {}
BASE = U64(0x9E3779B97F4A7C15)

#: Bytes of words that white space alone separates, ``[^\x20\x09-\x0D]+``.
BLANK_SEPARATED = np.ones(256, bool)
BLANK_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words made of letters and digits; every byte outside ASCII belongs to a word.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix64 finalizer)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text starts; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back to the machine; else a Python worker keeps what its largest batch took for all later stages."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()  # that of malloc, which numpy takes from


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs of about ``most_bytes`` of text; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)
    release()


def powers(n: int, base: int = int(BASE)) -> np.ndarray:
    """The first ``n`` powers; the longest table asked for is kept, up to a bound."""
    n = max(n, 1)
    known = _powers.get(base)
    if known is None or len(known) < n:
        out = np.full(n, U64(base))
        out[0] = U64(1)
        known = np.multiply.accumulate(out)
        if n <= MOST_POWERS:
            _powers[base] = known
    return known[:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, pow(int(BASE), -1, 1 << 64))


def _words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = letters[data]
    edge = np.empty(len(data), bool)
    edge[0] = inside[0]
    edge[1:] = inside[1:] & ~inside[:-1]
    border = offsets[offsets < len(data)]
    edge[border] = inside[border]
    start = np.flatnonzero(edge)
    kept = np.flatnonzero(inside)
    runs = np.searchsorted(kept, start)
    length = np.diff(np.append(runs, len(kept)))
    place = np.arange(len(kept)) - np.repeat(runs, length)
    value = (data[kept].astype(U64) + U64(1)) * powers(int(length.max(initial=1)))[place]
    total = np.add.reduceat(value, runs) if len(runs) else np.zeros(0, U64)
    return mix(total + length.astype(U64) * BASE), start, start + length


class Words:
    """The words of some texts: ``hash``, byte ``start`` and ``end``, and ``first``, where each text's words begin.

    The bytes are read in chunks that end between words, so that memory follows the number of words.
    """

    CHUNK = 1 << 20

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray):
        parts, at = [], 0
        while at < len(data):
            upto = min(len(data), at + self.CHUNK)
            while upto < len(data) and letters[data[upto - 1]]:
                gap = np.flatnonzero(~letters[data[upto : upto + self.CHUNK]])
                upto = min(len(data), upto + (int(gap[0]) + 1 if len(gap) else self.CHUNK))
            inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, upto)]
            hashes, start, end = _words(data[at:upto], inner - at, letters)
            parts.append((hashes, start + at, end + at))
            at = upto
        none = (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.hash, self.start, self.end = (np.concatenate(x) for x in zip(*(parts or [none]), strict=True))
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.hash)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for each run of ``n`` consecutive numbers; fewer than ``n`` give none."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    total = np.zeros(len(hashes) - n + 1, U64)
    if n <= 16:
        for k in range(n):
            total *= BASE
            total += hashes[k : k + len(total)]
    else:  # running sums of numbers times powers, and the inverse powers
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(hashes.astype(U64) * powers(len(hashes)))])
        total = (sums[n:] - sums[:-n]) * inverse_powers(len(total))
    return mix(total + U64(n))


def least_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of ``n`` consecutive keys."""
    if len(keys) < n:
        return keys[:0]
    size = 1
    while 2 * size <= n:
        keys = np.minimum(keys[: len(keys) - size], keys[size:])
        size *= 2
    rest = n - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def inside_text(first: np.ndarray, n: int) -> np.ndarray:
    """For every start of ``windows(..., n)``: whether the window stays in one text."""
    size = int(first[-1])
    if size < n:
        return np.zeros(0, bool)
    ok = np.ones(size - n + 1, bool)
    for k in range(1, n):  # a window may not run over a border
        border = first[1:-1] - k
        ok[border[(border >= 0) & (border < len(ok))]] = False
    return ok
