"""A cuckoo filter over 64-bit hashes, filled and probed with whole arrays.

Buckets of four 16-bit fingerprints; a key's two buckets are ``i`` and
``i ^ mix(fingerprint)``, so an entry can be moved, and deleted, without its key.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x SLOTS of uint16, 0 is free

    @classmethod
    def of(cls, keys: np.ndarray) -> "CuckooFilter":
        """A filter that holds ``keys`` (uint64, repeats count); doubles until all fit."""
        buckets = 1
        while buckets * SLOTS * 0.9 < len(keys) or buckets < 2:
            buckets *= 2
        while True:
            made = cls(np.zeros((buckets, SLOTS), np.uint16))
            if made.insert(keys):
                return made
            buckets *= 2

    @classmethod
    def from_bytes(cls, raw: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.asarray(keys, np.uint64)
        mask = np.uint64(len(self.table) - 1)
        mark = (_mix(keys) >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = keys & mask
        return mark, first.astype(np.int64), self._other(first.astype(np.int64), mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (_mix(mark) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def insert(self, keys: np.ndarray, rounds: int = 200) -> bool:
        """Add every key; False if some found no place (the filter is then to be rebuilt larger)."""
        mark, at, other = self._places(keys)
        for turn in range(rounds):
            if not len(mark):
                return True
            mark, at = self._place(mark, at)
            if turn % 2 == 0:  # the other bucket before anything is moved
                at = self._other(at, mark)
                continue
            # one key per full bucket takes the place of an entry, which goes on to its other bucket
            at_once, one = np.unique(at, return_index=True)
            slot = (turn // 2) % SLOTS
            moved = self.table[at_once, slot].copy()
            self.table[at_once, slot] = mark[one]
            rest = np.ones(len(mark), bool)
            rest[one] = False
            mark, at = (np.concatenate([mark[rest], moved]),
                        np.concatenate([at[rest], self._other(at_once, moved)]))
        return not len(mark)

    def _place(self, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fill free slots; returns what found none."""
        order = np.argsort(at, kind="stable")
        mark, at = mark[order], at[order]
        start = np.r_[True, at[1:] != at[:-1]]
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
        used = (self.table != 0).sum(axis=1)
        free = nth < SLOTS - used[at]
        # entries of a bucket need not be its first ones: the nth key takes the nth free slot
        slots = np.argsort(self.table[at[free]] != 0, axis=1, kind="stable")
        self.table[at[free], slots[np.arange(free.sum()), nth[free]]] = mark[free]
        return mark[~free], at[~free]

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Per key whether it may be held; never False for one that is."""
        mark, a, b = self._places(keys)
        return ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Take out one entry per key; the keys must be held."""
        for m, *both in zip(*self._places(keys)):
            for at in both:
                hit = np.flatnonzero(self.table[at] == m)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break
