"""Suffix arrays with common-prefix lengths by induced sorting, for texts larger than memory.

One level of the recursion: suffixes are of type S (smaller than the next suffix) or L; the leftmost S of each run
cuts the text into blocks. Blocks are ranked, the string of ranks is sorted by the same function, and two sweeps induce
the rest: L suffixes from the cuts in ascending order, S suffixes from the L in descending order. A sweep is driven by
a priority queue of tuples (symbol, kind, position, common prefix with the one before it under that symbol); it is a
queue of ranges of symbols whose waiting tuples go to disk beyond a set number. All tuples that cannot induce into what
is popped beside them are popped together, so the work is done on arrays.

Common prefixes travel with the tuples: two suffixes induced under one symbol share one symbol more than the least
common prefix between their inducers, which a range minimum over what was popped gives; where the two kinds meet under
a symbol they share the shorter of the two runs of that symbol; cuts get theirs from the recursion.

The recursion ends where a string of ranks fits into memory (Scratch.direct symbols); that one is sorted by doubling.
Arrays longer than Scratch.most live in files, tuples beyond Scratch.waiting wait in files. The last symbol must be the only smallest one.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

NONE = np.iinfo(np.int64).max
WIDTH = 1.0


class Scratch:
    """Arrays in memory, or in files of one temporary folder of the task when they are long. Files are nameless
    from the start, so nothing stays behind, even if the task is killed."""

    def __init__(self, most: int = 8_000_000, waiting: int = 500_000, direct: int = 500_000):
        self.most, self.waiting, self.direct = most, waiting, max(1, direct)

    def array(self, n: int, kind, fill=None) -> np.ndarray:
        if n <= self.most:
            return np.empty(n, kind) if fill is None else np.full(n, fill, kind)
        with tempfile.TemporaryFile() as f:
            out = np.memmap(f, kind, "w+", shape=(n,))
        if fill:
            out[:] = fill
        return out

    def of(self, values: np.ndarray) -> np.ndarray:
        if len(values) <= self.most:
            return values
        out = self.array(len(values), values.dtype)
        out[:] = values
        return out


class Minima:
    """Appended values and the least of any range of them."""

    B = 16

    def __init__(self, n: int, scratch: Scratch):
        m = n // self.B + 2
        self.values, self.head, self.tail = (scratch.array(m * self.B, np.int32, np.iinfo(np.int32).max) for _ in range(3))
        self.rows = m.bit_length() + 1
        self.blocks, self.m, self.n = scratch.array(self.rows * m, np.int32), m, 0

    def append(self, x: np.ndarray) -> None:
        B, s, m = self.B, self.n, self.m
        self.n = e = s + len(x)
        self.values[s:e] = x
        a, b = s // B, -(-e // B)
        block = self.values[a * B: b * B].reshape(-1, B)
        head = np.minimum.accumulate(block, 1)
        self.head[a * B: b * B] = head.ravel()
        self.tail[a * B: b * B] = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
        self.blocks[a:b] = head[:, -1]
        k = 1
        while 1 << k <= b:  # row k: the least of 2**k blocks that end here
            lo, half, up, here = max(a, (1 << k) - 1), 1 << k - 1, (k - 1) * m, k * m
            if lo < b:
                self.blocks[here + lo: here + b] = np.minimum(self.blocks[up + lo: up + b],
                                                              self.blocks[up + lo - half: up + b - half])
            k += 1

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value of each first..last, both included."""
        B = self.B
        lb, rb = first // B, last // B
        out = np.minimum(self.tail[first], self.head[last])
        far = np.nonzero(rb - lb > 1)[0]
        if len(far):
            l, r = lb[far], rb[far]
            k = np.frexp(r - 1 - l)[1].astype(np.int64) - 1
            row = k * self.m
            mid = np.minimum(self.blocks[row + r - 1], self.blocks[row + l + (np.int64(1) << k)])
            out[far] = np.minimum(out[far], mid)
        near = np.nonzero(lb == rb)[0]
        if len(near):
            at = first[near][:, None] + np.arange(B)
            inside = at <= last[near][:, None]
            out[near] = np.where(inside, self.values[np.where(inside, at, 0)], np.iinfo(np.int32).max).min(axis=1)
        return out


class RangeQueue:
    """Tuples (2 * symbol + kind, position, common prefix) by ranges of symbols, first in first out within a symbol.
    Beyond `waiting` tuples in memory all go to a file, each range as one piece. `kind` is the type of the numbers."""

    def __init__(self, bounds: np.ndarray, waiting: int, kind):
        self.bounds, self.waiting, self.kind = bounds * 2, waiting, np.dtype(kind)
        self.parts: list[list] = [[] for _ in bounds]
        self.stored: list[list] = [[] for _ in bounds]
        self.held, self.file = 0, None

    def push(self, key: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Keys ascend."""
        if not len(key):
            return
        rows = np.stack([key, pos, lcp]).astype(self.kind)
        first, last = np.searchsorted(self.bounds, [key[0], key[-1]], "right") - 1
        cuts = np.searchsorted(key, self.bounds[first: last + 2]) if last + 1 < len(self.bounds) else \
            np.append(np.searchsorted(key, self.bounds[first: last + 1]), len(key))
        cuts = cuts.tolist()
        for r in range(first, last + 1):
            a, b = cuts[r - first], cuts[r - first + 1]
            if a < b:
                self.parts[r].append(rows[:, a:b])
        self.held += len(key)
        if self.held > self.waiting:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, os.SEEK_END)
        for r, parts in enumerate(self.parts):
            if parts:
                rows = np.concatenate(parts, axis=1)
                self.stored[r].append((self.file.tell(), rows.shape[1]))
                self.file.write(np.ascontiguousarray(rows).tobytes())
                self.parts[r] = []
        self.held = 0

    def pop(self, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = []
        for at, n in self.stored[r]:
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(3 * n * self.kind.itemsize), self.kind).reshape(3, n))
        parts += self.parts[r]
        self.held -= sum(p.shape[1] for p in self.parts[r])
        self.parts[r] = self.stored[r] = []
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        key, pos, lcp = np.concatenate(parts, axis=1).astype(np.int64)
        order = np.argsort(key, kind="stable")
        return key[order], pos[order], lcp[order]

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def induce(key: np.ndarray, symbols: int, wanted: np.ndarray, run: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray,
           scratch: Scratch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sweep: (positions in ascending order of key, whether each was a seed, common prefix with the one before).

    `seeds` stand in order; every `wanted` position follows from the position after it. Under one symbol the
    induced come before the seeds.
    """
    total = int(np.count_nonzero(wanted)) + len(seeds)
    counts = np.bincount(key[seeds], minlength=symbols)
    for a in range(0, len(key), 1 << 22):
        counts += np.bincount(key[a: a + (1 << 22)][wanted[a: a + (1 << 22)]], minlength=symbols)
    before = np.cumsum(counts) - counts
    # small ranges make many pops, large ones tuples that induce into their own range: both are least at the root
    bounds = np.unique(before // max(64, int(total ** 0.5 * WIDTH)), return_index=True)[1]
    queue = RangeQueue(bounds, scratch.waiting, np.int32 if max(2 * symbols, len(key)) < 2 ** 31 else np.int64)
    for a in range(0, len(seeds), 1 << 20):
        part = seeds[a: a + (1 << 20)]
        order = np.argsort(key[part], kind="stable")
        queue.push(key[part][order].astype(np.int64) * 2 + 1, part[order], seed_lcp[a: a + (1 << 20)][order])
    history = Minima(total, scratch)
    out, seeded = scratch.array(total, np.int64), scratch.array(total, bool)
    latest = scratch.array(symbols, np.int64, -1)  # when something was last induced under a symbol
    before_key, before_pos = -2, 0

    def settle(k2, pos, lcp, ind, high):
        """These come next. What they induce waits in the queue, or is returned if it lies in the open range."""
        nonlocal before_key, before_pos
        base = history.n
        pk, pp = np.empty_like(k2), np.empty_like(pos)
        pk[0], pp[0], pk[1:], pp[1:] = before_key, before_pos, k2[:-1], pos[:-1]
        value = np.where(pk == k2, lcp, 0)
        meet = np.nonzero((pk ^ k2) == 1)[0]
        if len(meet):
            value[meet] = np.minimum(run[pp[meet]], run[pos[meet]])
        history.append(value)
        out[base: history.n], seeded[base: history.n] = pos, k2 & 1
        before_key, before_pos = int(k2[-1]), int(pos[-1])
        at = np.nonzero(ind != NONE)[0]
        if not len(at):
            return None
        sym = ind[at]
        order = np.argsort(sym, kind="stable")
        at, sym = at[order], sym[order]
        when, p = at + base, pos[at] - 1
        fresh = np.ones(len(sym), bool)
        np.not_equal(sym[1:], sym[:-1], out=fresh[1:])
        earlier = np.empty_like(when)
        earlier[1:] = when[:-1]
        earlier[fresh] = latest[sym[fresh]]
        final = np.append(fresh[1:], True)
        latest[sym[final]] = when[final]
        shared = np.zeros(len(sym), np.int64)
        known = np.nonzero(earlier >= 0)[0]
        if len(known):
            shared[known] = 1 + history.least(earlier[known] + 1, when[known]).astype(np.int64)
        cut = int(np.searchsorted(sym, high, "right"))
        queue.push(sym[cut:] * 2, p[cut:], shared[cut:])
        return (sym[:cut] * 2, p[:cut], shared[:cut]) if cut else None

    def inducing(pos):
        prev = pos - 1
        ok = (pos > 0) & wanted[prev]
        ind = np.full(len(pos), NONE, np.int64)
        ind[ok] = key[prev[ok]]
        return ind

    for r in range(len(bounds)):
        k2, pos, lcp = queue.pop(r)
        high = int(bounds[r + 1]) - 1 if r + 1 < len(bounds) else symbols - 1
        ind = inducing(pos)
        while len(k2):
            inside = int(ind.min())
            cut = len(k2)
            if inside <= high:
                cut = int(np.searchsorted(k2, 2 * inside)) or int(np.searchsorted(k2, 2 * inside + 1))
            new = settle(k2[:cut], pos[:cut], lcp[:cut], ind[:cut], high)
            k2, pos, lcp, ind = k2[cut:], pos[cut:], lcp[cut:], ind[cut:]
            if new is not None:
                k2, pos, lcp, ind = (np.concatenate(x) for x in zip((k2, pos, lcp, ind), (*new, inducing(new[1]))))
                order = np.argsort(k2, kind="stable")
                k2, pos, lcp, ind = k2[order], pos[order], lcp[order], ind[order]
    queue.close()
    return out, seeded, history.values[:total]


def rank_blocks(text, small, starts, ends, scratch) -> tuple[np.ndarray, int, np.ndarray]:
    """Rank of each block text[start..end] (types count), number of ranks, symbols a rank shares with the one before."""
    m = len(starts)
    rank, shared = np.zeros(m, np.int64), np.zeros(m, np.int64)
    opens = np.zeros(m, bool)
    opens[0] = True
    live, depth, span = np.arange(m), 0, 2 * int(text.max()) + 2
    while len(live):
        at = starts[live] + depth
        sym = text[at].astype(np.int64) * 2 + small[at]
        base = rank[live]
        order = np.argsort(base * span + sym if depth else sym)
        live, sym, base = live[order], sym[order], base[order]
        old = np.ones(len(live), bool)
        np.not_equal(base[1:], base[:-1], out=old[1:])
        new = old.copy()
        new[1:] |= sym[1:] != sym[:-1]
        idx = np.arange(len(live))
        place = base + idx - np.maximum.accumulate(np.where(old, idx, 0))
        head = np.maximum.accumulate(np.where(new, idx, 0))
        rank[live] = place[head]
        split = place[new & ~old]
        opens[split] = True
        shared[split] = depth
        size = np.diff(np.append(np.nonzero(new)[0], len(live)))
        depth += 1
        stay = (np.repeat(size, size) > 1) & (ends[live] - starts[live] >= depth)
        live = live[stay]
    name = np.cumsum(opens) - 1
    return name[rank], int(name[-1]) + 1, shared[opens]


def sorted_in_memory(text: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a string that fits: ranks of prefixes of 1, 2, 4 ... symbols until all differ."""
    n = len(text)
    count = np.bincount(text, minlength=symbols)
    rank = (np.cumsum(count) - count)[text].astype(np.int32)
    live = np.nonzero(count[text] > 1)[0]
    ranks, length = [rank], 1
    while len(live):
        base, second = rank[live], rank[live + length]
        order = np.argsort(base.astype(np.int64) * n + second)
        live, base, second = live[order], base[order], second[order]
        old = np.ones(len(live), bool)
        np.not_equal(base[1:], base[:-1], out=old[1:])
        new = old.copy()
        new[1:] |= second[1:] != second[:-1]
        idx = np.arange(len(live))
        place = base + idx - np.maximum.accumulate(np.where(old, idx, 0))
        rank = rank.copy()
        rank[live] = place[np.maximum.accumulate(np.where(new, idx, 0))]
        size = np.diff(np.append(np.nonzero(new)[0], len(live)))
        live = live[np.repeat(size, size) > 1]
        ranks.append(rank)
        length *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int32)
    for known in reversed(ranks[:-1]):  # in the last all differ
        length //= 2
        same = np.nonzero(known[a] == known[b])[0]
        a[same] += length
        b[same] += length
        lcp[1 + same] += length
    return order, lcp


def suffix_array(text: np.ndarray, symbols: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(positions of all suffixes in order, common prefix of each with the one before)."""
    n = len(text)
    if n <= scratch.direct:
        return sorted_in_memory(text, symbols)
    last = np.append(np.nonzero(text[1:] != text[:-1])[0], n - 1)
    size = np.diff(last, prepend=-1)
    small = scratch.of(np.repeat(np.append(text[last[:-1]] < text[last[:-1] + 1], True), size))
    run = scratch.of((np.repeat(last, size) - np.arange(n) + 1).astype(np.int32))
    del last, size
    cuts = np.nonzero(small[1:] & ~small[:-1])[0] + 1
    ends = np.append(cuts[1:], n - 1)
    name, names, shared = rank_blocks(text, small, cuts, ends, scratch)
    if names == len(cuts):
        order, same = np.empty(len(cuts), np.int64), np.zeros(len(cuts), np.int64)
        order[name] = np.arange(len(cuts))
    else:
        order, same = suffix_array(scratch.of(name.astype(np.int32)), names, scratch)
    seed_lcp = np.zeros(len(cuts), np.int64)
    if len(cuts) > 1:
        least = Minima(names, scratch)
        least.append(shared)
        a, b = order[:-1] + same[1:], order[1:] + same[1:]
        e = least.least(name[a] + 1, name[b]).astype(np.int64)
        x, y = cuts[a] + e, cuts[b] + e
        seed_lcp[1:] = cuts[a] - cuts[order[:-1]] + e + np.where(text[x] == text[y], np.minimum(run[x], run[y]), 0)
    del name, shared
    larger = ~small
    pos, seed, lcp = induce(text, symbols, larger, run, cuts[order], seed_lcp, scratch)
    keep = np.nonzero(~seed)[0][::-1]
    lcp_l = np.append(0, lcp[keep[:-1]]) if len(keep) else lcp[:0]
    small[n - 1] = False  # the last symbol has nothing after it; it is put first below
    pos, _, lcp = induce(symbols - 1 - text, symbols, small, run, pos[keep], lcp_l, scratch)
    return np.concatenate([[n - 1], pos[::-1]]), np.concatenate([[0, 0], lcp[:0:-1]]).astype(np.int32)


def joined(texts: list[bytes]) -> tuple[np.ndarray, int, np.ndarray]:
    """All texts as one array of symbols, each closed by a symbol of its own below all bytes; how many symbols; starts."""
    m = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, m)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int32) + m
    text[starts + sizes] = np.arange(m - 1, -1, -1)
    return text, m + 256, starts


def repeated(texts: list[bytes], length: int, scratch: Scratch | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, last) of all runs of starts in a text whose `length` bytes also start elsewhere among the texts."""
    empty = np.zeros(0, np.int64)
    if not texts:
        return empty, empty, empty
    scratch = scratch or Scratch()
    text, symbols, starts = joined(texts)
    pos, lcp = suffix_array(scratch.of(text), symbols, scratch)
    long = lcp >= length
    twice = long.copy()
    twice[:-1] |= long[1:]
    hit = np.zeros(len(text) + 1, np.int8)
    hit[pos[twice]] = 1
    edge = np.diff(hit, prepend=0)
    first, last = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0] - 1
    owner = np.searchsorted(starts, first, "right") - 1
    return owner, first - starts[owner], last - starts[owner]
