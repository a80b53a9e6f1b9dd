"""A minimal perfect hash over 128-bit keys with compact arrays of fingerprints and counts beside it.

Level by level every key that lands alone on a bit of a table of twice the remaining keys sets that bit; the rest go
one level down. A key's index is the rank of its bit: about 4 bits a key. The arrays by index hold 16 bits of fingerprint
and a count of 8 bits, which stays at 255; keys counted at least ``repeated`` times have a keeper (64 bits) each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .words import mix

_POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_BELOW = np.array([(0xFF00 >> i) & 0xFF for i in range(8)], np.uint8)  # bits before bit i of a byte, as packbits orders them


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h1 ^ mix(h2 + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


def _ranks(bits: np.ndarray) -> np.ndarray:
    """Per byte of packed bits, how many are set before it."""
    ones = _POPULATION[bits].astype(np.int64)
    return np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else np.zeros(0, np.int64)


@dataclass
class Index:
    """One shard: ``sizes`` of the levels, their ``bits`` one after another, the arrays by rank, and the keepers of repeated keys."""

    repeated: int
    sizes: np.ndarray
    bits: np.ndarray
    fingerprint: np.ndarray
    count: np.ndarray
    keeper: np.ndarray

    def __post_init__(self):
        self._rank = _ranks(self.bits)
        self._often = np.packbits(self.count >= self.repeated)
        self._often_rank = _ranks(self._often)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, count: np.ndarray, keeper: np.ndarray, repeated: int = 1) -> Index:
        """Over distinct keys (h1, h2)."""
        if not 1 <= repeated <= 255:
            raise ValueError("a count is told from 1 to 255")
        left, tables, sizes = np.arange(len(h1)), [], []
        while len(left):
            size = max(16, -(-2 * len(left) // 8) * 8)
            at = _place(h1[left], h2[left], len(sizes), size)
            table = np.bincount(at, minlength=size) == 1
            tables.append(table)
            sizes.append(size)
            left = left[~table[at]]
            if len(sizes) > 200:
                raise ValueError("the keys are not distinct")
        bits = np.packbits(np.concatenate(tables)) if tables else np.zeros(0, np.uint8)
        n = len(h1)
        out = cls(repeated, np.array(sizes, np.int64), bits, np.zeros(n, np.uint16), np.zeros(n, np.uint8), np.zeros(0, np.int64))
        rank = out.ranks(h1, h2)
        low = np.minimum(np.asarray(count, np.int64), 255)
        out.fingerprint[rank], out.count[rank] = _fingerprint(h2), low
        order = np.argsort(rank)
        out.keeper = np.asarray(keeper, np.int64)[order][low[order] >= repeated]
        out.__post_init__()
        return out

    def ranks(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The index of each key; -1, or that of some other key, for one that was not built in."""
        out, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = _place(h1[left], h2[left], level, int(size)) + base
            byte, bit = at >> 3, at & 7
            there = (self.bits[byte] >> (7 - bit).astype(np.uint8)) & 1 == 1
            out[left[there]] = self._rank[byte[there]] + _POPULATION[self.bits[byte[there]] & _BELOW[bit[there]]]
            left, base = left[~there], base + int(size)
        return out

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, count, keeper) of each key; the keeper only where the count reaches ``repeated``.

        A key that was built in is always found; another one is, by its fingerprint, once in about 65,536 times.
        """
        if not len(self.fingerprint):
            return np.zeros(len(h1), bool), np.zeros(len(h1), np.uint8), np.zeros(len(h1), np.int64)
        rank = self.ranks(h1, h2)
        safe = np.maximum(rank, 0)
        found = (rank >= 0) & (self.fingerprint[safe] == _fingerprint(h2))
        count = np.where(found, self.count[safe], 0)
        keeper = np.zeros(len(h1), np.int64)
        often = np.flatnonzero(count >= self.repeated)
        at = safe[often]
        keeper[often] = self.keeper[self._often_rank[at >> 3] + _POPULATION[self._often[at >> 3] & _BELOW[at & 7]]]
        return found, count, keeper

    def arrays(self) -> dict[str, bytes]:
        return {k: getattr(self, k).tobytes() for k in _KINDS}

    @classmethod
    def of(cls, row, repeated: int = 1) -> Index:
        return cls(repeated, **{k: np.frombuffer(bytes(row[k]), kind) for k, kind in _KINDS.items()})


_KINDS = {"sizes": np.int64, "bits": np.uint8, "fingerprint": np.uint16, "count": np.uint8, "keeper": np.int64}


def _fingerprint(h2: np.ndarray) -> np.ndarray:
    return (h2 >> np.uint64(48)).astype(np.uint16)
