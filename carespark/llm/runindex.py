"""A run-length index of a byte string: run-compressed BWT with sampled run ends.

Built from the suffix array (prefix doubling, only unresolved suffixes are
sorted again).  Kept are the runs of the Burrows-Wheeler transform and, for
each boundary between two runs, the suffixes on either side and their longest
common prefix.  That is enough to stream the matching statistics of the string
against itself: inside a run the match of suffix j is that of suffix j-1
less one byte, so from left to right the match that reaches furthest among the
samples passed so far is the longest (:meth:`RunIndex.matches`).
"""

from __future__ import annotations

import numpy as np

#: Suffixes are sorted by so many bytes unless asked for more: matches are told apart up to there.
DEPTH = 1024


def _words(data: np.ndarray, extra: int) -> np.ndarray:
    """The 8 bytes from each place as a number (zeros beyond the end), for ``extra`` places more than data has."""
    n = len(data) + extra
    padded = np.concatenate([data, np.zeros(extra + 8, np.uint8)])
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k:k + n]
    return out


def suffix_array(data: np.ndarray, words: np.ndarray, limit: int = DEPTH) -> np.ndarray:
    """Places in order of the ``limit`` bytes from there (a power of two)."""
    n = len(data)
    order = np.argsort(words[:n], kind="stable").astype(np.int32)
    key = words[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    del key
    rank = np.zeros(n + limit, np.int32)  # 0: beyond the end
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0)) + 1
    # Slots of the order whose suffix shares its rank with a neighbour.
    tied = np.flatnonzero(~new | ~np.append(new[1:], True))
    depth = 8
    while len(tied) and depth < limit:
        at = order[tied]
        pair = (rank[at].astype(np.int64) << 32) | rank[at + depth]
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[tied] = at  # slots of a rank are consecutive, so sorting by rank first keeps them apart
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        tied = tied[~new | ~np.append(new[1:], True)]
        depth *= 2
    return order


def common_prefixes(words: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int = DEPTH) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b, up to ``limit``."""
    out = np.full(len(a), limit, np.int64)
    live = np.arange(len(a))
    for off in range(0, limit, 8):
        x = words[a[live] + off] ^ words[b[live] + off]
        differ = x != 0
        done, x = live[differ], x[differ]
        out[done] = off + sum(((x >> np.uint64(8 * k)) == 0).astype(np.int64) for k in range(7, 0, -1))
        live = live[~differ]
        if not len(live):
            break
    return out


class RunIndex:
    """Of a non-empty byte string; the empty suffix comes first, and the place before the first byte counts as a byte of its own."""

    def __init__(self, data: np.ndarray, longest: int = 0):
        """``longest``: the length up to which matches have to be told apart (DEPTH at least)."""
        self.n = len(data)
        limit = max(DEPTH, 1 << max(0, longest - 1).bit_length())
        words = _words(data, limit + 1)
        order = np.append(np.int32(self.n), suffix_array(data, words, limit))
        bwt = np.where(order > 0, data[order - 1].astype(np.int16), -1)
        first = np.concatenate([[True], bwt[1:] != bwt[:-1]])
        #: Start and byte of each run; its first and last suffix.
        self.starts = np.flatnonzero(first)
        self.bytes = bwt[self.starts]
        self.heads = order[self.starts]
        self.tails = order[np.append(self.starts[1:], self.n + 1) - 1]
        #: How far the last suffix of a run agrees with the first of the next.
        a, b = self.tails[:-1], self.heads[1:]
        self.agree = np.minimum(common_prefixes(words, a, b, limit), self.n - np.maximum(a, b))
        self.before = 1 + np.concatenate([[0], np.cumsum(np.bincount(data, minlength=256))])

    def matches(self) -> np.ndarray:
        """For each place the longest prefix from there (up to the index's depth) that also starts elsewhere."""
        reach = np.zeros(self.n + 1, np.int64)
        for suffixes in (self.heads[1:], self.tails[:-1]):  # no suffix is twice the head or the tail of a run
            reach[suffixes] = np.maximum(reach[suffixes], suffixes + self.agree)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n + 1), 0)[:-1]

    def _rank(self, byte: int, i: int) -> int:
        """Occurrences of byte among the first i of the transform."""
        ends = np.minimum(np.append(self.starts[1:], self.n + 1), i)
        return int(np.maximum(ends - self.starts, 0)[self.bytes == byte].sum())

    def count(self, pattern: bytes) -> int:
        """Occurrences of pattern, by backward search over the runs."""
        low, high = 0, self.n + 1
        for byte in reversed(pattern):
            low, high = (int(self.before[byte]) + self._rank(byte, x) for x in (low, high))
            if low >= high:
                return 0
        return high - low
