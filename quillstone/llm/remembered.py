"""Ids of pieces of text, remembered by a worker in arrays."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

#: Bits of a place, one for each piece; ids in all, about; bytes of the longest piece.
PLACES, REMEMBERED, LONGEST = 21, 1 << 24, 48
#: Bytes of text that are divided together, at most, or one text: the arrays of a byte each take some forty times that.
TOGETHER = 1 << 19
#: What follows each text while several are divided together: a byte that UTF-8 does not have.
STOP = 0xFF


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Remembered:
    """The ids that ``encode`` gives for pieces of text, by a 64-bit hash of their bytes. A piece that has the place of another drives it out; a full memory is emptied."""

    def __init__(self, encode: Callable[[str], list[int] | tuple[int, ...]]) -> None:
        self.encode = encode
        n = 1 << PLACES
        self.key, self.start, self.count = np.zeros(n, np.uint64), np.zeros(n, np.int32), np.zeros(n, np.uint16)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 1
        self.multipliers = np.cumprod(np.full(LONGEST + 2, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

    def _put(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Start and count in the pool of the ids of these."""
        ids = [self.encode(p) for p in pieces]
        count = np.array([len(x) for x in ids], np.int64)
        end = self.used + int(count.sum())
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(end - len(self.pool), len(self.pool)), np.uint32)])
        self.pool[self.used : end] = list(chain.from_iterable(ids))
        start = self.used + np.cumsum(count) - count
        self.used = end
        return start, count

    def ids(self, raw: bytes, at: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that are each followed by STOP, whose pieces begin at ``at``, STOP being one; and where each text ends among them. ``end``, if any, is the id of a STOP."""
        sizes = np.diff(np.r_[at, len(raw)])
        b = np.frombuffer(raw, np.uint8)
        place = np.minimum(np.arange(len(b), dtype=np.int32) - np.repeat(at.astype(np.int32), sizes), LONGEST + 1)
        h = _mixed(np.add.reduceat((b + np.uint64(1)) * self.multipliers[place], at) + sizes.astype(np.uint64)) | np.uint64(1)
        slot = (h >> np.uint64(64 - PLACES)).astype(np.int64)
        short = sizes <= LONGEST
        known = short & (self.key[slot] == h)
        start, count = np.where(known, self.start[slot], 0).astype(np.int64), np.where(known, self.count[slot], 0).astype(np.int64)
        stop = b[at] == STOP
        text = lambda k: raw[at[k] : at[k] + sizes[k]].decode()
        new = np.flatnonzero(~known & ~stop & short)
        if len(new):
            hashes, first, of = np.unique(h[new], return_index=True, return_inverse=True)
            s, n = self._put([text(k) for k in new[first].tolist()])
            where = (hashes >> np.uint64(64 - PLACES)).astype(np.int64)
            self.key[where], self.start[where], self.count[where] = hashes, s, n  # of pieces with one place the last stays, with its own ids
            start[new], count[new] = s[of], n[of]
        for k in np.flatnonzero(~short).tolist():
            s, n = self._put([text(k)])
            start[k], count[k] = s[0], n[0]
        if end is not None:
            self.pool[0] = end
            start[stop], count[stop] = 0, 1
        ends = np.cumsum(count)
        out = self.pool[np.arange(ends[-1]) + np.repeat(start - ends + count, count)]
        if self.used > REMEMBERED:
            self.key[:], self.used = 0, 1
        return out, ends[stop]
