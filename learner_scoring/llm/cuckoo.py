"""A cuckoo filter over 64-bit hashes, filled and emptied in whole numpy batches."""

from __future__ import annotations

import numpy as np

from learner_scoring.llm.common import ship_by_value

SLOTS = 4
#: Share of the slots in use at which the filter grows.
MAX_LOAD = 0.85
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Cuckoo:
    """Approximate multiset of hashes: no false negatives, deletions allowed.

    A hash leaves a 16-bit fingerprint in one of two buckets; either bucket is
    the other xor a hash of the fingerprint, so fingerprints move without the
    keys. ``hashes`` must already be well mixed. The fingerprints carry the high
    bits of the hash and the buckets the low ones.
    """

    def __init__(self, expected: int = 64):
        buckets = 16
        while buckets * SLOTS * MAX_LOAD < expected:
            buckets *= 2
        self.slots = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def of_bytes(cls, raw: bytes) -> "Cuckoo":
        out = cls()
        out.slots = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return out

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.slots))

    def _places(self, hashes: np.ndarray):
        mask = np.uint64(len(self.slots) - 1)
        fp = (hashes >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        b1 = hashes & mask
        return fp, b1.astype(np.int64), self._other(b1.astype(np.int64), fp)

    def _other(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        step = (fp.astype(np.uint64) * _MIX) >> np.uint64(20)
        return ((bucket.astype(np.uint64) ^ step) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        fp, b1, b2 = self._places(hashes)
        return ((self.slots[b1] == fp[:, None]) | (self.slots[b2] == fp[:, None])).any(axis=1)

    def _put(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """Fill free slots; True where an entry found one."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        first = np.searchsorted(b, b, "left")
        rank = np.arange(len(b)) - first  # the n-th entry of its bucket takes its n-th free slot
        free = self.slots[b] == 0
        nth = np.cumsum(free, axis=1)
        hit = free & (nth == (rank + 1)[:, None])
        ok = hit.any(axis=1)
        self.slots[b[ok], hit[ok].argmax(axis=1)] = fp[order][ok]
        done = np.zeros(len(b), bool)
        done[order] = ok
        return done

    def insert(self, hashes: np.ndarray) -> bool:
        """Add one entry per hash; False (and no change) where there is no room."""
        before = self.slots.copy()
        fp, bucket, other = self._places(hashes)
        done = self._put(bucket, fp)
        fp, bucket = fp[~done], other[~done]
        rng = np.random.default_rng(len(hashes))
        for _ in range(400):
            if not len(fp):
                return True
            done = self._put(bucket, fp)
            fp, bucket = fp[~done], bucket[~done]
            if not len(fp):
                return True
            _, one = np.unique(bucket, return_index=True)  # one entry a bucket pushes another out
            rest = np.ones(len(fp), bool)
            rest[one] = False
            slot = rng.integers(0, SLOTS, len(one))
            out = self.slots[bucket[one], slot]
            self.slots[bucket[one], slot] = fp[one]
            fp = np.concatenate([fp[rest], out])
            bucket = np.concatenate([bucket[rest], self._other(bucket[one], out)])
        self.slots = before
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Take one entry out per hash; the hashes must have been inserted."""
        for h in (hashes[i : i + 1] for i in range(len(hashes))):
            fp, b1, b2 = self._places(h)
            for b in (int(b1[0]), int(b2[0])):
                at = np.flatnonzero(self.slots[b] == fp[0])
                if len(at):
                    self.slots[b, at[0]] = 0
                    break


def filled(hashes: np.ndarray, room: int = 0) -> Cuckoo:
    """A filter with the given hashes, grown until they fit."""
    size = max(room, len(hashes), 64)
    while True:
        f = Cuckoo(size)
        if f.insert(hashes):
            return f
        size *= 2


ship_by_value(__name__)
