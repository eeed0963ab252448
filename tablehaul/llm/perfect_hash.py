"""A minimal perfect hash over 64-bit keys, in numpy: levels of bit sets in which no two keys share a bit.

Each level hashes the keys left over by the one before to about ``SPREAD`` places a key; keys that are alone in their
place set its bit, the others go on. A key's number is the count of set bits before its own, over all levels, so n keys
get the numbers 0 to n - 1.
"""

from __future__ import annotations

import numpy as np

SPREAD = 1.5
#: Keys that still collide after so many levels are kept as a sorted list behind the bits.
LEVELS = 48


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers for every seed (finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def build(keys: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Sizes of the levels, their packed bits one after the other, and the keys left over, for distinct keys."""
    sizes, bits, left = [], [], keys.astype(np.uint64)
    while len(left) and len(sizes) < LEVELS:
        size = int(np.ceil(len(left) * SPREAD / 8)) * 8
        place = mix(left, len(sizes)) % np.uint64(size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~alone[place.astype(np.int64)]]
    return np.array(sizes, "<u4"), b"".join(b.tobytes() for b in bits), np.sort(left)


class Reader:
    """Numbers keys by what ``build`` returned; a key that was not built in gets -1 or any number."""

    def __init__(self, sizes: np.ndarray, bits: bytes, left: np.ndarray) -> None:
        self.sizes, self.left = sizes, left
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.before = np.concatenate([[0], np.cumsum(self.bits)])

    def number(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            place = base + (mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[place]
            out[open_[hit]] = self.before[place[hit]]
            open_, base = open_[~hit], base + int(size)
        if len(open_) and len(self.left):
            at = np.minimum(np.searchsorted(self.left, keys[open_]), len(self.left) - 1)
            hit = self.left[at] == keys[open_]
            out[open_[hit]] = self.before[-1] + at[hit]
        return out
