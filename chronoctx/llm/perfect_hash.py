"""Minimal perfect hashing of 64-bit keys in numpy, and the line index built on it.

Keys are placed level by level: on each level a key hashes to a bit, and keys
that are alone on their bit stay; the others go on to the next, smaller level. A
key's slot is the number of set bits before its own. About three to four bits a
key, whatever the keys are.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class PerfectHash:
    """``slots(keys)`` maps the n keys it was built from onto 0..n-1, and any
    other key onto some slot or -1."""

    def __init__(self, levels: list[np.ndarray], sizes: list[int]):
        self.levels, self.sizes = levels, sizes
        self.before, total = [], 0
        for bits in levels:
            counts = np.cumsum(_POP[bits], dtype=np.int64)
            self.before.append(np.concatenate(([0], counts[:-1])) + total)
            total += int(counts[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct unsigned 64-bit numbers."""
        levels, sizes, rest = [], [], keys.astype(np.uint64)
        while len(rest):
            size = max(64, -(-len(rest) * GAMMA // 64) * 64)
            place = (_mix(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            counts = np.bincount(place, minlength=size)
            levels.append(np.packbits(counts == 1, bitorder="little"))
            sizes.append(size)
            rest = rest[counts[place] != 1]
        return cls(levels, sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        rest, where = keys.astype(np.uint64), np.arange(len(keys))
        for level, (bits, size, before) in enumerate(zip(self.levels, self.sizes, self.before)):
            if not len(rest):
                break
            place = (_mix(rest, level) % np.uint64(size)).astype(np.int64)
            byte, bit = place >> 3, (place & 7).astype(np.uint8)
            own = bits[byte]
            hit = (own >> bit & 1).astype(bool)
            lower = own[hit] & ((1 << bit[hit].astype(np.int64)) - 1).astype(np.uint8)
            out[where[hit]] = before[byte[hit]] + _POP[lower]
            rest, where = rest[~hit], where[~hit]
        return out

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], dtype=np.int64).tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8).tolist()
        levels, at = [], 8 * (n + 1)
        for size in sizes:
            levels.append(np.frombuffer(data, np.uint8, size // 8, at))
            at += size // 8
        return cls(levels, sizes)
