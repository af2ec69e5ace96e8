"""A minimal perfect hash of 64-bit keys: n known keys to 0..n-1, in about three bits a key.

Keys are hashed into an array of bits; where just one key falls its bit is set, all others go on to the
next, smaller array. The number of a key is the number of set bits before its own. A key that is not
known may get the number of another one, so whoever asks keeps the keys by number and compares.
"""

from dataclasses import dataclass

import numpy as np

ROOM = 2  # bits in an array for each key that comes to it


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Well spread 64-bit numbers, other ones at each level."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    sizes: list[int]  # bits of each level, whole bytes
    bits: np.ndarray  # bytes of all levels

    def __post_init__(self):
        ones = np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)
        self.before = np.concatenate([np.zeros(1, np.int64), ones])

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        """Of distinct keys."""
        sizes, arrays, left = [], [np.empty(0, np.uint8)], keys
        while len(left):
            size = -(-ROOM * len(left) // 8) * 8
            at = mixed(left, len(sizes)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            arrays.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(sizes, np.concatenate(arrays))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where no level holds it."""
        found = np.full(len(keys), -1, np.int64)
        pending, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(pending):
                break
            at = (mixed(keys[pending], level) % np.uint64(size)).astype(np.int64)
            byte, bit = start + (at >> 3), at & 7
            is_set = (self.bits[byte] >> bit.astype(np.uint8)) & 1 > 0
            below = self.bits[byte] & ((1 << bit) - 1).astype(np.uint8)
            found[pending[is_set]] = (self.before[byte] + np.bitwise_count(below))[is_set]
            pending = pending[~is_set]
            start += size // 8
        return found
