"""Suffix order with common-prefix values by external induced sorting.

Suffixes are taken in order, character bucket by character bucket, and each induces the place of the suffix one
character before it.  Inside a bucket the induced suffixes come in their final order, so the priority queue of the
scan is one first-in first-out run per character; the runs hold (position, common prefix with the run's last entry)
and spill to a temporary file beyond ``memory`` bytes, so that only the bucket at hand has to be in memory.  A bucket
is handled as whole arrays: what it induces into other buckets is one stable grouping, and what it induces into itself
comes in rounds, one for each further repetition of its character.

The order of the left-most S-type suffixes, which seeds the scan, comes from the same scan run on their unsorted
list, which sorts the stretches between them, and then from doubling over the names of these stretches.

Common prefixes are counted up to ``cap`` characters; the order of suffixes that agree in ``cap`` characters is
left open.
"""

from __future__ import annotations

import tempfile

import numpy as np


class Runs:
    """One append-only run of (position, common prefix) arrays per character, on disk beyond ``memory`` bytes."""

    def __init__(self, memory: int):
        self.parts: list[list] = [[] for _ in range(256)]
        self.held, self.memory, self.file, self.end = 0, memory, None, 0

    def append(self, c: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[c].append((at, lcp))
        self.held += at.nbytes + lcp.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for i, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    start = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    parts[i] = (start, len(part[0]))
        self.held = 0

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for part in self.parts[c]:
            if isinstance(part[0], np.ndarray):
                self.held -= part[0].nbytes + part[1].nbytes
            else:
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(4 * part[1]), np.int32), np.frombuffer(self.file.read(part[1]), np.uint8)
            out.append(part)
        self.parts[c] = []
        if not out:
            return np.empty(0, np.int32), np.empty(0, np.uint8)
        return np.concatenate([p[0] for p in out]), np.concatenate([p[1] for p in out])


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Characters that the suffixes at ``a`` and ``b`` share, up to ``cap``; ``text`` has ``cap`` zeros behind its end."""
    out = np.zeros(len(a), np.uint8)
    live = np.arange(len(a))
    for depth in range(cap):
        if not len(live):
            break
        # eight characters at once while all of them agree
        if depth % 8 == 0 and depth + 8 <= cap:
            same = np.ones(len(live), bool)
            for k in range(8):
                same &= text[a[live] + depth + k] == text[b[live] + depth + k]
            out[live[same]] = depth + 8
            stop = live[~same]
            for k in range(8):
                stop = stop[text[a[stop] + depth + k] == text[b[stop] + depth + k]]
                out[stop] = depth + k + 1
            live = live[same]
    return out


def _least(lcp: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of ``lcp`` over stretches ``first``..``last``, both included, by doubling stretches."""
    out = np.empty(len(first), np.uint8)
    level = np.log2(last - first + 1).astype(np.int64)
    table, k = lcp, 0
    while True:
        own = np.flatnonzero(level == k)
        if len(own):
            out[own] = np.minimum(table[first[own]], table[last[own] - (1 << k) + 1])
        if k >= level.max(initial=0):
            return out
        table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
        k += 1


def _more(value: np.ndarray, cap: int) -> np.ndarray:
    return np.minimum(value, cap - 1) + np.uint8(1)


class _Scan:
    def __init__(self, text: np.ndarray, n: int, small: np.ndarray, cap: int, memory: int):
        self.text, self.n, self.small, self.cap, self.memory = text, n, small, cap, memory

    def push(self, runs: Runs, at: np.ndarray, lcp: np.ndarray, choose: np.ndarray) -> None:
        """What the chosen suffixes of a bucket induce into other buckets."""
        index = np.flatnonzero(choose)
        if not len(index):
            return
        before = at[index] - 1
        letter = self.text[before]
        order = np.argsort(letter, kind="stable")
        index, before, letter = index[order], before[order], letter[order]
        new = np.append(True, letter[1:] != letter[:-1])
        shared = np.ones(len(index), np.uint8)
        follow = np.flatnonzero(~new)
        if len(follow):
            shared[follow] = _more(_least(lcp, index[follow - 1] + 1, index[follow]), self.cap)
        starts = np.append(np.flatnonzero(new), len(index))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            runs.append(int(letter[a]), before[a:b], shared[a:b])

    def rounds(self, c: int, at: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A bucket's run with what it induces into itself: suffixes with one more repetition of ``c`` each time."""
        all_at, all_lcp, depth = [at], [lcp], 1
        while len(at):
            index = np.flatnonzero((at > 0) & (self.text[np.maximum(at - 1, 0)] == c))
            if not len(index):
                break
            shared = np.full(len(index), min(depth, self.cap), np.uint8)
            if len(index) > 1:
                shared[1:] = _more(_least(lcp, index[:-1] + 1, index[1:]), self.cap)
            at, lcp, depth = at[index] - 1, shared, depth + 1
            all_at.append(at)
            all_lcp.append(lcp)
        return np.concatenate(all_at), np.concatenate(all_lcp)

    def join(self, a_at, a_lcp, b_at, b_lcp):
        """Two neighbouring runs; the common prefix where they meet is counted in the text."""
        if len(a_at) and len(b_at):
            b_lcp = b_lcp.copy()
            b_lcp[0] = common_prefix(self.text, a_at[-1:], b_at[:1], self.cap)[0]
        return np.concatenate([a_at, b_at]), np.concatenate([a_lcp, b_lcp])

    def run(self, seeds: np.ndarray, seed_lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes in order from the ordered seeds, with common prefixes."""
        text, small = self.text, self.small
        bound = np.searchsorted(text[seeds], np.arange(257))
        runs = Runs(self.memory)
        last = np.array([self.n - 1], np.int32)
        runs.append(int(text[last[0]]), last, np.zeros(1, np.uint8))
        large = Runs(self.memory)
        for c in range(256):
            at, lcp = runs.take(c)
            if len(at):
                lcp = lcp.copy()
                lcp[0] = 0
            at, lcp = self.rounds(c, at, lcp)
            lo, hi = bound[c], bound[c + 1]
            both, both_lcp = self.join(at, lcp, seeds[lo:hi], seed_lcp[lo:hi])
            if len(both):
                self.push(runs, both, both_lcp, (both > 0) & (text[np.maximum(both - 1, 0)] > c))
            if len(at):
                large.append(c, at, lcp)
        out_at, out_lcp, runs = [], [], Runs(self.memory)
        for c in range(255, -1, -1):
            at, lcp = runs.take(c)
            if len(at):
                lcp = lcp.copy()
                lcp[0] = 0
            at, lcp = self.rounds(c, at, lcp)
            l_at, l_lcp = large.take(c)
            # downwards: the value of an entry is what it shares with the larger neighbour
            down = np.append(np.zeros(1, np.uint8), l_lcp[:0:-1]) if len(l_at) else l_lcp
            both, both_lcp = self.join(at, lcp, l_at[::-1], down)
            if len(both):
                self.push(runs, both, both_lcp, (both > 0) & (text[np.maximum(both - 1, 0)] < c))
                up = np.append(np.zeros(1, np.uint8), both_lcp[:0:-1])
                out_at.append(both[::-1])
                out_lcp.append(up)
        return np.concatenate(out_at[::-1]), np.concatenate(out_lcp[::-1])


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of a string of names by their first ``depth`` ones."""
    rank, reach = names.astype(np.int64), 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - reach)] = rank[reach:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(key), np.int64)
        rank[order] = np.append(0, np.cumsum(np.diff(key[order]) != 0))
        reach *= 2
        if reach >= depth or rank[order[-1]] == len(rank) - 1:
            return order


def suffix_order(data: bytes, cap: int = 200, memory: int = 256_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all suffixes in order, and what each shares with the one before, up to ``cap`` (at most 255)."""
    n = len(data)
    text = np.frombuffer(data + bytes(cap + 8), np.uint8)
    if n < 2:
        return np.arange(n, dtype=np.int32), np.zeros(n, np.uint8)
    step = np.sign(np.diff(text[:n].astype(np.int16)))
    # a suffix is small (S) when the next different character is larger; the last one is large
    change = np.where(step != 0, np.arange(n - 1), n - 1)
    change = np.minimum.accumulate(change[::-1])[::-1]
    small = np.append(np.append(step, -1)[change] > 0, False)
    seeds = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    scan = _Scan(text, n, small, cap, memory)
    if len(seeds) > 1:
        by_letter = seeds[np.argsort(text[seeds], kind="stable")]
        at, _ = scan.run(by_letter, np.zeros(len(seeds), np.uint8))
        is_seed = np.zeros(n, bool)
        is_seed[seeds] = True
        stretch = at[is_seed[at]]
        # names: a stretch runs to the next seed, itself included; equal stretches follow each other
        number = np.full(n, -1, np.int64)
        number[seeds] = np.arange(len(seeds))
        size = np.append(np.diff(seeds) + 1, n - seeds[-1])[number[stretch]]
        same = np.zeros(len(stretch), bool)
        same[1:] = (size[1:] == size[:-1]) & (number[stretch[1:]] != len(seeds) - 1) & (number[stretch[:-1]] != len(seeds) - 1)
        candidate = np.flatnonzero(same)
        same[candidate] = _equal(text, stretch[candidate - 1], stretch[candidate], size[candidate])
        names = np.empty(len(seeds), np.int64)
        names[number[stretch]] = np.cumsum(~same) - 1
        seeds = seeds[_doubled(names, cap // 2 + 2)]
    lcp = np.zeros(len(seeds), np.uint8)
    if len(seeds) > 1:
        lcp[1:] = common_prefix(text, seeds[:-1], seeds[1:], cap)
    return scan.run(seeds, lcp)


def _equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.ones(len(a), bool)
    live, depth = np.arange(len(a)), 0
    while len(live):
        same = text[a[live] + depth] == text[b[live] + depth]
        out[live[~same]] = False
        live = live[same]
        depth += 1
        live = live[size[live] > depth]
    return out
