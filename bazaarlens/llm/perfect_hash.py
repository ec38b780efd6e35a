"""Minimal perfect hashes in shards, with the keys stored.

A shard numbers its keys from 0 without gaps. Each level is a bit array in which
every key left over marks a place; keys alone at theirs keep it, the others go to
the next, smaller level. A key's number is the count of kept places before its
own, over all levels. Shards follow each other in one bit array, so the same count
over all of it numbers the keys of all shards. A hash answers for any key, so the
key stored under the number is compared, byte for byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from .shingles import mix

SPARSE = 2  # places per key of a level
MAX_LEVELS = 64
_SEED = 42  # of Spark's xxhash64, so that Spark can name the shard of a key
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def key_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    n = len(keys)
    return (np.fromiter((xxh64_intdigest(k, _SEED) for k in keys), np.uint64, n),
            np.fromiter((xxh3_64_intdigest(k) for k in keys), np.uint64, n))


def shard_of(first: np.ndarray, shards: int) -> np.ndarray:
    """As ``pmod(xxhash64(key), shards)`` of Spark."""
    return (first.view(np.int64) % np.int64(shards)).astype(np.int64)


def _places(first: np.ndarray, second: np.ndarray, level: int, size) -> np.ndarray:
    return (mix(first + np.uint64(level + 1) * (second | np.uint64(1))) % np.asarray(size, np.uint64)).astype(np.int64)


def build(keys: list[bytes]) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, bits of all levels, and the number of each of the distinct ``keys``."""
    first, second = key_hashes(keys)
    left, sizes, bits = np.arange(len(keys)), [], []
    number, given = np.zeros(len(keys), np.int64), 0
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("two keys have the same 128 hash bits")
        size = max(8, -(-SPARSE * len(left) // 8) * 8)
        place = _places(first[left], second[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        kept = alone[place]
        number[left[kept]] = given + (np.cumsum(alone) - 1)[place[kept]]
        given += int(kept.sum())
        left = left[~kept]
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little").tobytes())
    return sizes, b"".join(bits), number


class ShardedHash:
    """Numbers of keys over several shards, given in order as (level sizes, bits, keys in the order of their numbers)."""

    def __init__(self, shards: list[tuple[list[int], bytes, list[bytes] | pa.Array]]):
        self.shards = len(shards)
        deepest = max(len(s[0]) for s in shards)
        self.sizes = np.array([[*s[0], *[0] * (deepest - len(s[0]))] for s in shards], np.int64)
        begins = np.cumsum([0, *(8 * len(s[1]) for s in shards)])[:-1]
        self.begins = begins[:, None] + np.cumsum(self.sizes, axis=1) - self.sizes
        self.bits = np.frombuffer(b"".join(s[1] for s in shards), np.uint8)
        self.before = np.concatenate([[0], np.cumsum(_ONES[self.bits], dtype=np.int64)[:-1]])
        counts = [len(s[2]) for s in shards]
        # Number of the first key of each shard.
        self.bases = np.cumsum([0, *counts])[:-1]
        parts = [s[2] if isinstance(s[2], pa.Array) else pa.array(s[2], pa.binary()) for s in shards]
        self.keys = pa.concat_arrays([p.cast(pa.large_binary()) for p in parts])

    def __len__(self) -> int:
        return len(self.keys)

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        """The number of each key, -1 for keys that no shard holds."""
        first, second = key_hashes(keys)
        shard = shard_of(first, self.shards)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.begins[shard[left], level] + _places(first[left], second[left], level, size)
            byte, bit = self.bits[at >> 3].astype(np.int64), at & 7
            kept = (byte >> bit) & 1 == 1
            rank = self.before[at >> 3] + _ONES[byte & ((1 << bit) - 1)]
            out[left[kept]] = rank[kept]
            left = left[~kept]
        found = np.flatnonzero(out >= 0)
        asked = pa.array([keys[i] for i in found.tolist()], pa.large_binary())
        same = pc.equal(self.keys.take(pa.array(out[found])), asked).to_numpy(zero_copy_only=False).astype(bool)
        out[found[~same]] = -1
        return out

    def shard_and_slot(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shard = np.searchsorted(self.bases, numbers, "right") - 1
        return shard, numbers - self.bases[shard]
