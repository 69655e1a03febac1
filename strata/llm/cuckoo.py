"""Cuckoo filter (Fan et al., "Cuckoo Filter: Practically Better Than Bloom", 2014) over 64-bit key hashes.

Four 16-bit tags a bucket, two buckets a key, the second found from the first and the tag; so a key can be
deleted. Tags that find no room go to a list beside the table: nothing inserted is ever missed.
"""

from __future__ import annotations

import numpy as np

SLOTS, KICKS = 4, 200
MIX = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    def __init__(self, capacity: int, state: bytes | None = None):
        self.buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / SLOTS / 0.9))))
        self.table = np.zeros((self.buckets, SLOTS), np.uint16)
        self.beside: list[tuple[int, int]] = []
        if state is not None:
            flat = np.frombuffer(state, np.uint16)
            size = 1 << int(flat[0])
            self.buckets, self.table = size, flat[1:1 + size * SLOTS].reshape(size, SLOTS).copy()
            self.beside = [(int(x[0]) | int(x[1]) << 16, int(x[2])) for x in flat[1 + size * SLOTS:].reshape(-1, 3)]

    def to_bytes(self) -> bytes:
        beside = np.array([(i & 0xFFFF, i >> 16, t) for i, t in self.beside], np.uint16).ravel()
        return np.concatenate([np.array([self.buckets.bit_length() - 1], np.uint16), self.table.ravel(), beside]).tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = keys.astype(np.int64).view(np.uint64) * MIX
        tag = ((h >> np.uint64(48)) | np.uint64(1)).astype(np.int64)
        one = ((h >> np.uint64(16)) & np.uint64(self.buckets - 1)).astype(np.int64)
        return tag, one, self._other(one, tag)

    def _other(self, bucket, tag):
        return bucket ^ ((tag * 0x5BD1E995 >> 7) & (self.buckets - 1))

    def insert(self, keys: np.ndarray) -> None:
        for tag, one, two in zip(*(x.tolist() for x in self._places(keys))):
            at = one
            for bucket in (one, two):
                if (free := np.flatnonzero(self.table[bucket] == 0)).size:
                    self.table[bucket, free[0]] = tag
                    break
            else:
                for kick in range(KICKS):
                    slot = kick % SLOTS
                    tag, self.table[at, slot] = int(self.table[at, slot]), tag
                    at = self._other(at, tag)
                    if (free := np.flatnonzero(self.table[at] == 0)).size:
                        self.table[at, free[0]] = tag
                        break
                else:
                    self.beside.append((at, tag))

    def delete(self, keys: np.ndarray) -> None:
        """Only of keys that have been inserted."""
        for tag, one, two in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (one, two):
                if (found := np.flatnonzero(self.table[bucket] == tag)).size:
                    self.table[bucket, found[0]] = 0
                    break
            else:
                self.beside.remove(next(x for x in self.beside if x in ((one, tag), (two, tag))))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        tag, one, two = self._places(keys)
        found = (self.table[one] == tag[:, None]).any(1) | (self.table[two] == tag[:, None]).any(1)
        for bucket, t in self.beside:
            found |= (tag == t) & ((one == bucket) | (two == bucket))
        return found
