"""Vectorised word hashing over the UTF-8 bytes of Arrow string columns.

A word's hash is a polynomial over its bytes, taken from one running sum over the whole chunk, so the
cost per byte is a few numpy passes and no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one pass of the kernels handles; a single longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True for bytes that end a word: ASCII white space only.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True

#: True for bytes that are neither ASCII letters, digits nor part of a non-ASCII character.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise over unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16), factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null counts as an empty text."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``most`` bytes together, or one row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(rows, max(low + 1, high))
        yield low, high
        low = high


class Words:
    """The words of some texts, in order: ``hash``, ``doc`` (row), and per row ``first`` and ``count``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ends: np.ndarray = WHITE):
        rows = len(offsets) - 1
        inside = ~ends[data]
        start, stop = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        start[cut] = inside[cut]
        stop[cut - 1] = inside[cut - 1]
        self.begin, self.end = np.flatnonzero(start), np.flatnonzero(stop) + 1
        powers, inverses = _table(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=total[1:])
        raw = (total[self.end] - total[self.begin]) * inverses[self.begin]
        self.hash = mix(raw + (self.end - self.begin).astype(np.uint64))
        edges = np.searchsorted(self.begin, offsets)
        self.first, self.count = edges[:-1], np.diff(edges)
        self.doc = np.repeat(np.arange(rows), self.count)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``n`` words; a text of fewer words, but one at least, gives one run of all."""
    size = len(words.hash)
    run = np.zeros(max(size - n + 1, 0), np.uint64)
    for k in range(n):
        run = mix(run + words.hash[k : size - n + 1 + k] * np.uint64(2 * k + 1)) if len(run) else run
    whole = words.doc[: len(run)] == words.doc[n - 1 :] if len(run) else np.zeros(0, bool)
    at, doc = run[whole], words.doc[: len(run)][whole]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = words.count[short] > k
            extra[has] = mix(extra[has] + words.hash[words.first[short[has]] + k] * np.uint64(2 * k + 1))
        at, doc = np.concatenate([at, mix(extra + words.count[short].astype(np.uint64))]), np.concatenate([doc, short])
    return at, doc
