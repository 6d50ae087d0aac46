"""A minimal perfect hash of distinct whole numbers, built and asked as arrays.

Level by level, each key left takes a place in a bit array somewhat larger than the number of keys
left. Keys alone at their place set its bit and are done, the others go on to the next level. A
key's number is the count of set bits before its own, over all levels: the numbers 0 to n - 1, each
once. Keys that were not built in get a number too or none; ``find`` tells them apart by the stored
keys.
"""

from __future__ import annotations

import numpy as np

SPARE = 1.5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash in which no two numbers collide, for each seed another one."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * int(_ODD) + 1) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, sizes: np.ndarray, bits: bytes, keys: np.ndarray):
        self.sizes, self.bits, self.keys = sizes, bits, keys
        self.levels, at, base = [], 0, 0
        for size in sizes.tolist():
            packed = np.frombuffer(bits, np.uint8, count=-(-size // 8), offset=at)
            at += len(packed)
            alone = np.unpackbits(packed, count=size).astype(bool)
            number = np.cumsum(alone, dtype=np.int64) - 1 + base
            base = int(number[-1]) + 1 if size else base
            self.levels.append((alone, number))

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Built over distinct keys; ``keys`` are then stored in the order of their numbers."""
        left, sizes, parts = keys, [], []
        while len(left):
            size = max(8, int(SPARE * len(left)))
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone).tobytes())
            left = left[~alone[at]]
        made = cls(np.array(sizes, np.int64), b"".join(parts), keys)
        made.keys = np.empty_like(keys)
        made.keys[made.number(keys)] = keys
        return made

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for seed, (alone, number) in enumerate(self.levels):
            at = (mixed(keys[left], seed) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[at]
            out[left[hit]] = number[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, verified by the stored keys; -1 for any other."""
        out = self.number(keys)
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.sizes.tobytes(), self.bits, self.keys.tobytes()

    @classmethod
    def unpacked(cls, sizes: bytes, bits: bytes, keys: bytes, kind: np.dtype) -> PerfectHash:
        return cls(np.frombuffer(sizes, np.int64), bits, np.frombuffer(keys, kind))
