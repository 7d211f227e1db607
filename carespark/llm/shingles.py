"""Word shingles of whole texts as sets of 64-bit hashes, in numpy over batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C55
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, np.uint64)[_LOWER]
#: Bytes of texts that are hashed at once (a longer text goes by itself).
BATCH = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """base^i and base^-i modulo 2^64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, BATCH + 1)
            grow = lambda b: np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, b % (1 << 64), _U)]), dtype=_U)
            self.up, self.down = grow(_BASE), grow(_BASE_INVERSE)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def prefix_hashes(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(s, down): the bytes a..b-1 have the hash (s[b] - s[a]) * down[a]."""
    up, down = _POWERS.upto(len(data) + 1)
    s = np.zeros(len(data) + 1, _U)
    np.cumsum(table[data] * up[:-1], out=s[1:], dtype=_U)
    return s, down


def _of_batch(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    starts, ends = edge[0::2], edge[1::2]
    s, down = prefix_hashes(data, _TABLE)
    words = mix((s[ends] - s[starts]) * down[starts] + (ends - starts).astype(_U))
    cuts = np.append(np.searchsorted(starts, begins), len(starts))

    def fold(parts: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(parts[0]), len(parts), _U)
        for p in parts:
            h = mix(h * _U(0xD1B54A32D192ED03) + p)
        return h

    full = fold([words[j:len(words) - width + 1 + j] for j in range(width)]) if len(words) >= width else words[:0]
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= width:
            yield np.unique(full[a:b - width + 1])
        elif b > a:
            yield fold([words[i:i + 1] for i in range(a, b)])
        else:
            yield words[:0]


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    Words are runs of anything but ASCII white space, A-Z in lower case.  With
    fewer words the whole sequence is one shingle; without words (or text) the
    set is empty.
    """
    batch: list[bytes] = []
    size = 0
    for t in texts:
        data = (t or "").encode()
        if batch and size + len(data) > BATCH:
            yield from _of_batch(batch, width)
            batch, size = [], 0
        batch.append(data)
        size += len(data) + 1
    if batch:
        yield from _of_batch(batch, width)
