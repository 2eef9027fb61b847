"""Vectorised views of Arrow text columns: words, lines and rolling hashes over UTF-8 bytes.

A *word* is a maximal run of bytes other than space and 0x09-0x0D.  All of
these are ASCII, so working on UTF-8 bytes equals working on code points.
Everything here runs inside tasks, on one slice of a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # text handled at once; one longer text is handled alone, whole

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEED = np.random.default_rng(20240229)
_BYTE_CODES = _SEED.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large_string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return pa.array([""] * len(column), pa.large_string())
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry than texts)."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(offsets) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes of text, or one row."""
    _, offsets = raw(column)
    at, n = 0, len(column)
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    for name, base in (("up", _BASE), ("down", _BASE_INV)):
        if len(_powers.get(name, ())) <= n:
            size = max(n + 1, SLICE_BYTES + 4096)
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    found = _powers["up"][:n + 1], _powers["down"][:n + 1]
    if n > 4 * SLICE_BYTES:
        _powers.clear()  # one huge text does not keep its tables alive
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``h`` with span_hash(h, a, b) a hash of data[a:b]; sums modulo 2**64."""
    h = np.zeros(len(data) + 1, np.uint64)
    own = h[1:]  # in place: eight bytes a byte of text are much
    np.take(_BYTE_CODES, data, out=own, mode="clip")
    own *= powers(len(data))[0][:-1]
    np.cumsum(own, out=own)
    return h


def span_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    down = powers(len(h) - 1)[1]
    return mix((h[ends] - h[starts]) * down[starts])


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (one more entry)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0], edge[-1] = inside[0], inside[-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    both = np.unique(cut[inside[cut] & inside[cut - 1]])  # a text ends in a word, the next begins with one
    marks = np.flatnonzero(edge)
    if len(both):
        marks = np.sort(np.concatenate([marks, both, both]))
    starts, ends = marks[0::2], marks[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), starts, ends)


_GRAM = _SEED.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows that lie within one text, and the first window of each text."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    total = max(len(words) - n + 1, 0)
    if not begin[-1]:
        return np.zeros(0, np.uint64), begin
    sums = np.zeros(total, np.uint64)
    for k in range(n):
        sums += words[k:k + total] * _GRAM[k]
    at = np.repeat(first[:-1] - begin[:-1], counts) + np.arange(begin[-1])
    return mix(sums[at] + np.uint64(n)), begin
