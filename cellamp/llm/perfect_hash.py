"""Minimal perfect hashing of 64-bit keys: many small functions, one per shard of the keys, looked up together.

A shard's keys are hashed into a bitmap with two bits per key; keys alone in their bit stay there, the others go on to the next
level with another hash. A key's index is the number of bits set before its own. So n distinct keys get the indexes 0 to n - 1.
A key that was not among them gets some index too, or none: whoever looks up must compare the key that is stored at the index.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Bits of a level for every key that is still to be placed.
ROOM = 2
LEVELS = 64


def mixed(keys: np.ndarray, level: int | np.ndarray) -> np.ndarray:
    """A hash of the keys for a level (the finalizer of splitmix64)."""
    z = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level + 1, np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Which shard a key belongs to."""
    return (mixed(keys, LEVELS) % np.uint64(shards)).astype(np.int32)


def build(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """(bits per level, all bitmaps packed, keys in the order of their indexes) for distinct keys."""
    left, sizes, maps, ordered = keys, [], [], []
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("keys are not distinct")
        size = ROOM * len(left)
        slots = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        single = np.bincount(slots, minlength=size) == 1
        alone = single[slots]
        sizes.append(size)
        maps.append(single)
        ordered.append(left[alone][np.argsort(slots[alone])])
        left = left[~alone]
    bits = np.concatenate([*maps, np.zeros(0, bool)])
    return sizes, np.packbits(bits).tobytes(), np.concatenate([*ordered, keys[:0]])


class Lookup:
    """The functions of some shards (in ascending order), with the keys stored at the indexes."""

    def __init__(self, shards: int, numbers: Sequence[int], sizes: Sequence[Sequence[int]], maps: Sequence[bytes], keys: np.ndarray):
        self.shards, self.keys = shards, keys
        self.place = np.full(shards, -1, np.int32)
        self.place[np.asarray(numbers, np.int64)] = np.arange(len(numbers), dtype=np.int32)
        self.depth = max((len(s) for s in sizes), default=0)
        self.sizes = np.zeros((len(numbers), max(1, self.depth)), np.int64)
        for row, listed in zip(self.sizes, sizes, strict=True):
            row[: len(listed)] = listed
        self.starts = np.concatenate([[0], np.cumsum(self.sizes.ravel())])[:-1].reshape(self.sizes.shape)
        parts = [np.unpackbits(np.frombuffer(m, np.uint8), count=sum(s)) for m, s in zip(maps, sizes, strict=True)]
        self.bits = np.concatenate([*parts, np.zeros(1, np.uint8)]).astype(bool)
        self.before = np.cumsum(self.bits, dtype=np.int32) - self.bits

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key over all shards held here; -1 for keys that are not among them."""
        found = np.full(len(keys), -1, np.int64)
        place = self.place[shard_of(keys, self.shards)]
        at = np.flatnonzero(place >= 0)
        for level in range(self.depth):
            if not len(at):
                break
            size = self.sizes[place[at], level]
            at, size = at[size > 0], size[size > 0]
            slot = (mixed(keys[at], level) % size.astype(np.uint64)).astype(np.int64) + self.starts[place[at], level]
            hit = self.bits[slot]
            found[at[hit]] = self.before[slot[hit]]
            at = at[~hit]
        held = found >= 0
        found[held] = np.where(self.keys[found[held]] == keys[held], found[held], -1)
        return found
