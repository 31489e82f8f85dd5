"""A worker's memory of encoded pieces as flat arrays: bytes to ids, looked up for millions of pieces at once.

Keys are 64-bit hashes in an open-addressed table; the bytes of every hit are compared with the remembered ones, so
a chance collision never gives wrong ids. A piece starts at a blank, a line feed or the mark START (which no UTF-8 text
contains) and reaches up to the next of these, see `pretoken` for why these are independent.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .common import mix64

START = 0xFF
_VALUE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0xD1B54A32D192ED03))
_POWER = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_OPENS = np.zeros(256, bool)
_OPENS[[0x20, 0x0A, START]] = True


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... for each run, one after the other."""
    total = np.cumsum(sizes)
    return np.repeat(starts - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)


class PieceTable:
    """`encode` turns distinct new pieces (bytes, the start mark removed) into lists of ids. Beyond `most` pieces the
    table starts anew; that bounds memory and costs only encoding again."""

    def __init__(self, encode: Callable[[list[bytes]], list], most: int = 1_500_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << 16, -1, np.int32)
        self.keys = np.zeros(0, np.uint64)
        self.body, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.slots) - 1)
        found, left, probe = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        while len(left):
            own = self.slots[((keys[left] >> np.uint64(20)) + np.uint64(probe)) & mask]
            used = own >= 0
            left, own = left[used], own[used]
            if not len(left):
                break
            hit = self.keys[own] == keys[left]
            found[left[hit]] = own[hit]
            left, probe = left[~hit], probe + 1
        return found

    def _insert(self, begin: int) -> None:
        if 2 * len(self.keys) > len(self.slots):
            self.slots, begin = np.full(4 * len(self.slots), -1, np.int32), 0
        mask = np.uint64(len(self.slots) - 1)
        left, probe = np.arange(begin, len(self.keys)), 0
        while len(left):
            slot = ((self.keys[left] >> np.uint64(20)) + np.uint64(probe)) & mask
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            left, probe = left[self.slots[slot] != left], probe + 1

    def look_up(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids of each piece, which pieces open with START) of a buffer that begins with START."""
        if len(self.keys) > self.most:
            self.clear()
        starts = np.nonzero(_OPENS[buffer])[0]
        sizes = np.diff(np.append(starts, len(buffer)))
        place = np.arange(len(buffer)) - np.repeat(starts, sizes)
        key = mix64(np.add.reduceat(_VALUE[buffer] * _POWER[place & 63], starts) + sizes.astype(np.uint64))
        found = self._find(key)
        missing = np.nonzero(found < 0)[0]
        if len(missing):
            new, where = np.unique(key[missing], return_index=True)
            where = missing[where]
            a, n = starts[where], sizes[where]
            data = buffer[spread(a, n)]
            raw, ends = data.tobytes(), np.cumsum(n).tolist()
            got = self.encode([raw[e - s: e] for e, s in zip(ends, n.tolist())])
            counts = np.fromiter(map(len, got), np.int64, len(got))
            before = len(self.keys)
            self.at = np.append(self.at, len(self.body) + np.cumsum(n) - n)
            self.first = np.append(self.first, len(self.ids) + np.cumsum(counts) - counts)
            self.size, self.count = np.append(self.size, n), np.append(self.count, counts)
            self.keys, self.body = np.append(self.keys, new), np.append(self.body, data)
            self.ids = np.append(self.ids, np.fromiter((i for x in got for i in x), np.uint32, int(counts.sum())))
            self._insert(before)
            found[missing] = self._find(key[missing])
        # the remembered bytes must be the piece's own
        same = self.size[found] == sizes
        at = spread(self.at[found], sizes)
        wrong = self.body[np.minimum(at, len(self.body) - 1)] != buffer
        if wrong.any() or not same.all():
            return self._with_collisions(buffer, starts, sizes, found, wrong, same)
        counts = self.count[found]
        return self.ids[spread(self.first[found], counts)], counts, buffer[starts] == START

    def _with_collisions(self, buffer, starts, sizes, found, wrong, same):
        bad = np.logical_or.reduceat(wrong, starts) | ~same
        parts = [self.ids[a: a + c] for a, c in zip(self.first[found].tolist(), self.count[found].tolist())]
        for k in np.nonzero(bad)[0].tolist():
            piece = buffer[starts[k]: starts[k] + sizes[k]].tobytes()
            parts[k] = np.array(self.encode([piece])[0], np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64), buffer[starts] == START
