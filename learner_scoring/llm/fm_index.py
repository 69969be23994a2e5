"""A compressed full-text index over word codes, queried in numpy batches.

The Burrows-Wheeler transform of the codes, sorted by their first ``depth``
words, is kept in a wavelet matrix of packed bits with rank counts. Backward
search is exact for patterns up to ``depth`` words.
"""

from __future__ import annotations

import numpy as np

from learner_scoring.llm.common import ship_by_value


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ranks of the pairs (high, low), equal for equal pairs."""
    pair = high * (int(low.max()) + 1) + low
    order = np.argsort(pair, kind="stable")
    new = np.ones(len(pair), np.int64)
    new[1:] = pair[order][1:] != pair[order][:-1]
    out = np.empty(len(pair), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _ahead(rank: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(rank)
    if by < len(rank):
        out[:-by] = rank[by:] + 1
    return out


class Bits:
    """Packed bits with the count of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        pad = np.zeros(-len(bits) % 64 + 64, bool)
        self.words = np.packbits(np.concatenate([bits, pad]), bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        low = self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low)


class FMIndex:
    """Codes are dense non-negative integers; 0 separates texts and is never asked for."""

    def __init__(self, codes: np.ndarray, depth: int):
        n = len(codes)
        rank, width = codes.astype(np.int64), 1
        while 2 * width < depth:
            rank, width = _dense(rank, _ahead(rank, width)), 2 * width
        # `rank` orders by the first `width` words; two that overlap cover the depth, and one word less
        shorter = _dense(rank, _ahead(rank, depth - 1 - width)) if depth - 1 > width else rank
        full = _dense(rank, _ahead(rank, depth - width)) if depth > width else rank
        order = np.argsort(full, kind="stable")
        edge = np.flatnonzero(np.diff(shorter[order])) + 1
        starts = np.concatenate([[0], edge, [n]])
        group = np.zeros(n + 1, np.int64)
        group[edge] = 1
        group = np.cumsum(group)
        self.low, self.high = starts[group[:n]].astype(np.int32), starts[group[:n] + 1].astype(np.int32)
        bwt = codes[order - 1]
        self.n, self.levels = n, max(1, int(codes.max()).bit_length())
        self.less = np.concatenate([[0], np.cumsum(np.bincount(codes))]).astype(np.int64)
        self.bits: list[Bits] = []
        self.zeros: list[int] = []
        for level in range(self.levels - 1, -1, -1):
            one = (bwt >> level) & 1 == 1
            self.bits.append(Bits(one))
            self.zeros.append(int(n - one.sum()))
            bwt = np.concatenate([bwt[~one], bwt[one]])
        symbols = np.arange(len(self.less) - 1)
        self.first = self._path(symbols, np.zeros(len(symbols), np.int64))

    def _path(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i entries lead to among the entries equal to c."""
        for k, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            ones = bits.rank(i)
            i = np.where((c >> (self.levels - 1 - k)) & 1 == 1, zeros + ones, i - ones)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the range of c followed by the pattern of [lo, hi)."""
        base = self.less[c] - self.first[c]
        return base + self._path(c, lo), base + self._path(c, hi)

    def shorten(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of a found pattern of ``depth`` words without its last word."""
        return self.low[lo].astype(np.int64), self.high[lo].astype(np.int64)


def match_counts(index: FMIndex, codes: np.ndarray, ends: np.ndarray, n_windows: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each streamed text, how often each of its windows of ``depth`` words is in the index.

    The texts, given by their ends in ``codes``, are read backwards side by side:
    each step adds the word before the match and drops the one at its end, so the
    match stays ``depth`` words long as long as the index holds it.
    """
    order = np.argsort(-n_windows, kind="stable")
    ends, todo = ends[order], n_windows[order]
    lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), index.n, np.int64)
    at = ends.copy()
    for _ in range(depth - 1):
        at -= 1
        lo, hi = index.extend(codes[at], lo, hi)
    out = [np.zeros(k, np.int64) for k in todo]
    flat = np.zeros(int(todo.sum()), np.int64)
    offset = np.concatenate([[0], np.cumsum(todo)])
    for step in range(int(todo[0]) if len(todo) else 0):
        live = int(np.searchsorted(-todo, -step, "left"))  # texts with more than `step` windows come first
        lo, hi, at = lo[:live], hi[:live], at[:live] - 1
        lo, hi = index.extend(codes[at], lo, hi)
        flat[offset[:live] + todo[:live] - 1 - step] = hi - lo
        lo, hi = index.shorten(lo)
    for i in range(len(out)):
        out[i] = flat[offset[i] : offset[i + 1]]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return [out[i] for i in back]


ship_by_value(__name__)
