"""Words and their hashes over whole Arrow batches of text, in numpy.

All functions work on the UTF-8 bytes of many documents at once. Hashes are 64 bits wide;
two different ones of the same words can be combined where more are wanted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are hashed at once; bounds the memory of a task.
SLICE_BYTES = 2_000_000

# Separator of the contract's plain words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = b" \t\n\x0b\x0c\r"

_U = np.uint64
_POWER_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


class _Table:
    """Powers of an odd number and of its inverse modulo 2**64, made longer on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 1 << 16)
            self.up, self.down = _powers(self.base, self.n), _powers(self.inverse, self.n)
        return self.up, self.down


_BYTES, _WORDS = _Table(_POWER_BASE), _Table(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values after which all bits depend on all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(_POWER_BASE))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its values; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is a range by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, blanks: bytes = BLANKS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, document) of every word of the documents at ``offsets``.

    Positions count from ``offsets[0]``; a word is a longest run of bytes not in ``blanks``.
    """
    chunk = data[offsets[0] : offsets[-1]]
    is_blank = np.zeros(256, bool)
    is_blank[list(blanks)] = True
    inside = np.empty(len(chunk) + 1, bool)
    np.logical_not(is_blank[chunk], out=inside[:-1])
    inside[-1] = False
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    edges = (offsets[:-1] - offsets[0])[np.diff(offsets) > 0]
    first[edges] = inside[edges]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets - offsets[0], begin, side="right") - 1
    return begin, end, doc


def word_hashes(
    data: np.ndarray,
    offsets: np.ndarray,
    blanks: bytes = BLANKS,
    lower: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word; with ``lower``, A-Z count as a-z."""
    begin, end, doc = word_bounds(data, offsets, blanks)
    return hashes_between(data[offsets[0] : offsets[-1]], begin, end, lower), doc


def hashes_between(chunk: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """The hash of each of the words from ``begin`` to ``end``, which do not overlap."""
    out = np.empty(len(begin), _U)
    at = 0
    while at < len(begin):
        start = begin[at]
        to = max(int(np.searchsorted(begin, start + SLICE_BYTES)), at + 1)
        part = _VALUES[lower][chunk[start : end[to - 1]]]
        up, down = _BYTES.of(len(part) + 1)
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(part * up[: len(part)], dtype=_U, out=sums[1:])
        b, e = begin[at:to] - start, end[at:to] - start
        out[at:to] = (sums[e] - sums[b]) * down[b] + (e - b).astype(_U) * _U(_WORD_BASE)
        at = to
    return mix(out)


def window_hashes(
    words: np.ndarray, doc: np.ndarray, width: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``width`` words of one document."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    values = mix(words ^ _U(seed)) if seed else words
    up, down = _WORDS.of(len(words) + 1)
    sums = np.zeros(len(words) + 1, _U)
    np.cumsum(values * up[: len(words)], dtype=_U, out=sums[1:])
    first = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return mix((sums[first + width] - sums[first]) * down[first]), first


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, ...]:
    """Distinct (document, shingle hash) pairs, sorted, and the number of each document.

    A document of fewer words than ``width``, but not none, has one shingle: all of them.
    """
    hashes, first = window_hashes(words, doc, width)
    owner = doc[first]
    sizes = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        ends = np.cumsum(sizes)
        whole = np.array(
            [window_hashes(words[ends[d] - sizes[d] : ends[d]], np.zeros(sizes[d], int),
                           int(sizes[d]))[0][0] for d in short], _U,
        )
        hashes = np.concatenate([hashes, mix(whole + sizes[short].astype(_U))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return owner, hashes, np.bincount(owner, minlength=n_docs)
