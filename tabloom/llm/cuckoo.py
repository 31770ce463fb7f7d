"""A cuckoo filter over 64-bit keys: whole arrays of keys are looked up, inserted and removed at a time.

A key has a fingerprint of 16 bits and two buckets of four slots, each found from the other and the
fingerprint. A key that was inserted is always found; one that wasn't is found by chance, so an
exact table must have the last word. Removing a key that was never inserted would take away
another's fingerprint: the exact table must know that, too.
"""

from __future__ import annotations

import numpy as np

from .textbytes import U64, mix

SLOTS = 4
FILL = 0.85  # part of the slots that a filter is made for
KICKS = 200  # rounds in which fingerprints are moved before they go to the next segment


def _firsts(values: np.ndarray) -> np.ndarray:
    """The place of the first of each value."""
    return np.unique(values, return_index=True)[1]


class CuckooFilter:
    """Segments of `buckets` buckets. What finds no room in one goes to the next, which is added when needed."""

    def __init__(self, buckets: int, segments: list[np.ndarray] | None = None):
        self.buckets, self.segments = buckets, segments or [self._empty(buckets)]

    @staticmethod
    def _empty(buckets: int) -> np.ndarray:
        return np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 16
        while buckets * SLOTS * FILL < n:
            buckets *= 2
        return cls(buckets)

    @classmethod
    def from_bytes(cls, content: bytes, buckets: int) -> CuckooFilter:
        whole = np.frombuffer(content, np.uint16).reshape(-1, buckets, SLOTS).copy()
        return cls(buckets, list(whole))

    def to_bytes(self) -> bytes:
        return b"".join(s.tobytes() for s in self.segments)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, one of its buckets) of each key."""
        spread = mix(keys.astype(np.uint64))
        prints = (spread >> U64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (spread & U64(self.buckets - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(np.uint64)) & U64(self.buckets - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """May the key be in the filter? False is certain."""
        prints, bucket = self.places(keys)
        other, found = self._other(prints, bucket), np.zeros(len(keys), bool)
        for s in self.segments:
            found |= (s[bucket] == prints[:, None]).any(1) | (s[other] == prints[:, None]).any(1)
        return found

    def insert(self, keys: np.ndarray) -> None:
        """Insert each key once more."""
        prints, bucket = self.places(keys)
        for s in self.segments:
            prints, bucket = self._fill(s, prints, bucket)
        while len(prints):
            self.segments.append(self._empty(self.buckets))
            prints, bucket = self._fill(self.segments[-1], prints, bucket)

    def _fill(self, table: np.ndarray, prints: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put fingerprints into a segment; the ones that found no room, with a bucket of theirs."""
        prints, bucket, tried = prints.copy(), bucket.copy(), np.zeros(len(prints), np.int64)
        for turn in range(KICKS):
            if not len(prints):
                break
            one = _firsts(bucket)  # one for each bucket at a time
            room = table[bucket[one]] == 0
            fits = room.any(1)
            put = one[fits]
            table[bucket[put], room[fits].argmax(1)] = prints[put]
            full = one[~fits]
            fresh = full[tried[full] == 0]
            moved = full[tried[full] > 0]
            slot = (turn + moved) % SLOTS
            kicked = table[bucket[moved], slot]
            table[bucket[moved], slot] = prints[moved]
            prints[moved] = kicked
            for k in (fresh, moved):
                bucket[k] = self._other(prints[k], bucket[k])
            tried[full] += 1
            stay = np.ones(len(prints), bool)
            stay[put] = False
            prints, bucket, tried = prints[stay], bucket[stay], tried[stay]
        return prints, bucket

    def remove(self, keys: np.ndarray) -> int:
        """Remove each key once; all of them must have been inserted. Returns how many weren't found."""
        prints, bucket = self.places(keys)
        other = self._other(prints, bucket)
        for s in self.segments:
            for _ in range(2 * SLOTS):  # at most so many equal fingerprints share two buckets
                one = _firsts(np.minimum(bucket, other) * (1 << 16) + prints)
                gone = []
                for at in (bucket, other):
                    rest = np.setdiff1d(one, np.concatenate([np.zeros(0, np.int64), *gone]))
                    same = s[at[rest]] == prints[rest][:, None]
                    hit = same.any(1)
                    s[at[rest[hit]], same[hit].argmax(1)] = 0
                    gone.append(rest[hit])
                stay = np.ones(len(prints), bool)
                stay[np.concatenate(gone)] = False
                if stay.all():
                    break
                prints, bucket, other = prints[stay], bucket[stay], other[stay]
        return len(prints)
