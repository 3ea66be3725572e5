"""Minimal perfect hashing of whole numbers by levels of bits (Limasset et al., 2017).

At each level a key takes a slot by its hash; keys that have a slot to themselves set its bit, the
others go on to the next, smaller level. A key's number is the count of bits before its own, so
n keys get the numbers 0 to n - 1. Keys that were not hashed get any number or -1; the key kept
under the number tells.
"""

import numpy as np

#: Slots per key of a level.
ROOM = 2
#: A level that still had keys after so many would mean equal keys.
MOST_LEVELS = 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 bits that depend on all bits of the keys and the seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        """The slots of each level, and the bits of all levels in turn."""
        self.sizes, self.bits = sizes, bits
        self._ranks = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        """The hash of distinct keys."""
        sizes, levels = [], []
        while len(keys):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("keys repeat")
            size = ROOM * len(keys)
            slots = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slots, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[slots]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            slots = base + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[slots]
            found[left[hit]] = self._ranks[slots[hit]]
            left, base = left[~hit], base + size
        return found
