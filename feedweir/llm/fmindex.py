"""A compressed index over sequences of numbers: suffix array, Burrows-Wheeler transform in a wavelet matrix, and
matching statistics by backward search. Plain numpy; it works on one shard inside a task."""

from __future__ import annotations

import numpy as np

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the length of the common prefix of each with the one before it (prefix doubling)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    levels, k = [rank], 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = new
        levels.append(rank)
        k *= 2
        if rank[order[-1]] == n - 1 or k >= n:
            break
    common = np.zeros(n, np.int32)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        size = 1 << level
        inside = np.flatnonzero((a < n) & (b < n))
        # a rank counts as equal only if the prefix lies within the text
        inside = inside[(a[inside] + size <= n) & (b[inside] + size <= n)]
        same = inside[levels[level][a[inside]] == levels[level][b[inside]]]
        common[1:][same] += size
        a[same] += size
        b[same] += size
    return order, common


class Bits:
    """A bit vector with ranks: 64 bits a word, and the ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)])
        self.words = packed.view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before position ``i``."""
        word = i >> 6
        mask = ~(_ALL << (i & 63).astype(np.uint64))
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)


class Index:
    """Backward search over numbers 0 .. symbols-1; 0 separates sequences and is never searched for.

    ``weights`` give every text position's sequence a weight; an interval weighs what its occurrences weigh.
    """

    def __init__(self, text: np.ndarray, weights: np.ndarray) -> None:
        symbols = int(text.max()) + 1
        order, common = suffix_array(text)
        self.n = len(text)
        self.weight = np.concatenate([[0], np.cumsum(weights[order])])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])[:-1]
        self.levels, self.width = [], max(1, (symbols - 1).bit_length())
        row = text[order - 1]
        start = np.zeros(symbols, np.int64)
        codes = np.arange(symbols)
        for level in range(self.width - 1, -1, -1):
            bit = (row >> level) & 1
            vector = Bits(bit)
            self.levels.append(vector)
            ones = vector.ones(start)
            start = np.where((codes >> level) & 1 == 1, vector.zeros + ones, start - ones)
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.start = start
        # least common prefix over 2^k positions, to widen intervals
        self.least = [np.concatenate([common, [-1]]).astype(np.int32)]
        self.least[0][0] = -1
        while 1 << len(self.least) <= self.n + 1:
            half = 1 << (len(self.least) - 1)
            row = self.least[-1]
            self.least.append(np.minimum(row[:-half], row[half:]))

    def rank(self, code: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``code`` before position ``i`` of the transform."""
        for level, vector in zip(range(self.width - 1, -1, -1), self.levels, strict=True):
            ones = vector.ones(i)
            i = np.where((code >> level) & 1 == 1, vector.zeros + ones, i - ones)
        return i - self.start[code]

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with ``code`` put in front."""
        both = self.rank(np.concatenate([code, code]), np.concatenate([lo, hi]))
        return self.first[code] + both[: len(code)], self.first[code] + both[len(code) :]

    def shorten(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next larger interval of each, and its shorter match length."""
        length = np.maximum(self.least[0][lo], self.least[0][hi])
        for k in range(len(self.least) - 1, -1, -1):
            size, row = 1 << k, self.least[k]
            at = lo - size + 1
            go = at >= 0
            go[go] = row[at[go]] >= length[go]
            lo = np.where(go, lo - size, lo)
            at = hi + size
            go = at <= self.n + 1
            go[go] = row[hi[go]] >= length[go]
            hi = np.where(go, hi + size, hi)
        return lo, hi, np.maximum(length, 0)

    def matching(self, text: np.ndarray, ends: np.ndarray, lengths: np.ndarray, least_weight: int) -> np.ndarray:
        """Per position of ``text``: the longest match from there, within its sequence, that weighs enough.

        Sequences end before ``ends`` and are read backwards, all side by side.
        """
        out = np.zeros(len(text), np.int32)
        count = len(ends)
        lo, hi = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        long = np.zeros(count, np.int64)
        for step in range(1, int(lengths.max(initial=0)) + 1):
            todo = np.flatnonzero(lengths >= step)
            at = ends - step
            while len(todo):
                code = text[at[todo]]
                new_lo, new_hi = self.extend(code, lo[todo], hi[todo])
                fits = self.weight[new_hi] - self.weight[new_lo] >= least_weight
                ok = todo[fits]
                lo[ok], hi[ok] = new_lo[fits], new_hi[fits]
                long[ok] += 1
                todo = todo[~fits]
                if not len(todo):
                    break
                # a single symbol that does not weigh enough matches nothing
                over = todo[long[todo] == 0]
                lo[over], hi[over] = 0, self.n
                todo = todo[long[todo] > 0]
                lo[todo], hi[todo], long[todo] = self.shorten(lo[todo], hi[todo])
            here = np.flatnonzero(lengths >= step)
            out[at[here]] = long[here]
        return out
