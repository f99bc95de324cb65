"""Burrows-Wheeler transform and common prefixes of a collection, one column at a time.

Round r inserts the suffix of length r of every text: the symbol before the last inserted suffix
says into which pile the new one goes, and the count of that symbol before the old place
says where. The transform and the prefix lengths lie in two sequential files that each round reads
and writes from front to end; prefix lengths are kept up to ``MOST``.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Prefix lengths are cut here; the files hold one byte for each.
MOST = 250


class SequentialFile:
    """A growing array of bytes on disk, read and written from front to end; it goes when it is closed."""

    def __init__(self):
        self.file, self.size = tempfile.TemporaryFile(buffering=0), 0

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.fromfile(self.file, np.uint8, self.size)

    def write(self, array: np.ndarray) -> None:
        self.file.seek(0)
        array.tofile(self.file)
        self.size = len(array)

    def __enter__(self) -> SequentialFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def _by_symbol(bwt: np.ndarray) -> np.ndarray:
    """The places of a transform by symbol, in their order under each: Arrow counts where numpy would sort."""
    return pc.array_sort_indices(pa.array(bwt)).to_numpy().view(np.int64)


def _inserted(old: np.ndarray, keep: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = np.empty(len(keep), np.uint8)
    out[keep] = old
    out[at] = value
    return out


def collection_bwt(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(transform, prefix lengths) of the texts ``data[offsets[i]:offsets[i + 1]]``.

    Bytes must be below 255; the transform holds each plus one, and 0 where a text begins. Suffixes
    that are equal to their ends are ordered by the number of their text. Entry i of the prefix
    lengths belongs to the suffixes i - 1 and i.
    """
    n = len(offsets) - 1
    length = np.diff(offsets)
    with SequentialFile() as bwt_file, SequentialFile() as lcp_file:
        last = np.zeros(n, np.uint8)
        some = length > 0
        last[some] = data[offsets[1:][some] - 1] + 1
        bwt_file.write(last)
        lcp_file.write(np.zeros(n, np.uint8))
        place = np.arange(n)  # of the suffix that each text has inserted last
        alive = np.flatnonzero(some)
        counts = np.bincount(last, minlength=256)  # of the symbols in the transform
        for size in range(1, int(length.max(initial=0)) + 1):
            bwt, lcp = bwt_file.read(), lcp_file.read()
            mine = place[alive]
            symbol = bwt[mine]
            order = _by_symbol(bwt)  # the piles
            pile = np.concatenate([[0], np.cumsum(counts)])
            by = np.argsort((symbol.astype(np.int64) << 40) | mine)
            rank = np.empty(len(mine), np.int64)
            edges = np.searchsorted(symbol[by], np.arange(257))
            for s in np.flatnonzero(np.diff(edges)):
                own = by[edges[s] : edges[s + 1]]
                rank[own] = pile[s] + np.searchsorted(order[pile[s] : pile[s + 1]], mine[own])
            # place among all suffixes of up to ``size`` symbols: texts' ends first, then the piles
            new = n + rank - pile[1]
            # common prefix with the neighbour in the pile: one more than the least between the old places
            before = order[np.maximum(rank - 1, 0)]
            starts_pile = rank == pile[symbol]
            left = np.where(starts_pile, 0, np.minimum(_least(lcp, before + 1, mine + 1), MOST - 1) + 1)
            after = order[np.minimum(rank + 1, len(order) - 1)]
            ends_pile = rank + 1 == pile[symbol.astype(np.int64) + 1]
            right = np.where(ends_pile, 0, np.minimum(_least(lcp, mine + 1, after + 1), MOST - 1) + 1)
            keep = np.ones(len(bwt) + len(new), bool)
            keep[new] = False
            following = np.zeros(len(alive), np.uint8)
            more = length[alive] > size
            following[more] = data[offsets[1:][alive[more]] - size - 1] + 1
            lcp = _inserted(lcp, keep, new, left)
            later = new[~ends_pile] + 1
            lcp[later] = right[~ends_pile]
            first_of_next = new[ends_pile] + 1
            lcp[first_of_next[first_of_next < len(lcp)]] = 0
            lcp_file.write(lcp)
            bwt_file.write(_inserted(bwt, keep, new, following))
            counts += np.bincount(following, minlength=256)
            # a text that has ended stays at its place; only the last places of living texts are needed
            place[alive] = new
            alive = alive[more]
        return bwt_file.read(), lcp_file.read()


def _least(lcp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of ``lcp[start:end]`` for each pair; ranges that do not grow give any value."""
    out = np.zeros(len(start), np.int64)
    good = np.flatnonzero(end > start)
    if len(good):
        order = good[np.argsort(start[good], kind="stable")]
        pairs = np.stack([start[order], end[order]], 1).reshape(-1)
        padded = np.append(lcp, np.uint8(0))
        out[order] = np.minimum.reduceat(padded, pairs)[::2]
    return out


def places(bwt: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each suffix length the places of all texts that have one, found by walking the transform."""
    n = len(offsets) - 1
    length = np.diff(offsets)
    order = _by_symbol(bwt)
    step = np.empty(len(bwt), np.int64)
    step[order] = np.arange(len(bwt)) + n - np.count_nonzero(bwt == 0)
    out, at, alive = [np.arange(n)], np.arange(n), np.arange(n)
    for size in range(1, int(length.max(initial=0)) + 1):
        alive = alive[length[alive] >= size]
        at = at.copy()
        at[alive] = step[at[alive]]
        out.append(at[alive])
    return out


def repeated_starts(data: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Whether the ``least`` bytes from each byte of ``data`` also start elsewhere in the collection."""
    if least > MOST:
        raise ValueError(f"common prefixes are kept up to {MOST}")
    bwt, lcp = collection_bwt(data, offsets)
    long = lcp >= least
    shared = long.copy()
    shared[:-1] |= long[1:]
    out = np.zeros(len(data), bool)
    length = np.diff(offsets)
    for size, at in enumerate(places(bwt, offsets)):
        if size >= least:
            texts = np.flatnonzero(length >= size)
            out[offsets[1:][texts] - size] = shared[at]
    return out
