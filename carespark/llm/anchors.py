"""Content-chosen anchors of long substrings, in numpy over whole texts.

Every window of ``window`` bytes has one anchor: of its ``gram``-byte grams the
one with the smallest hash, the leftmost of equals.  Equal windows have their
anchor at the same offset, so they meet under the same gram wherever they are.
The windows of one anchor start at consecutive bytes; the bytes that they cover
are its fragment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .shingles import mix, prefix_hashes

_U = np.uint64
_TABLE = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, np.uint64)
#: Bytes of texts that are handled at once (a longer text goes by itself).
BATCH = 1 << 20
#: An anchor's place takes the low bits of its key, its hash the rest.
_PLACE = 34


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(texts: list[bytes], window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Batches of (text number, first start, last start, gram hash, fragment hash)."""
    batch: list[bytes] = []
    first = size = 0
    for i, t in enumerate(texts):
        if batch and size + len(t) > BATCH:
            yield _of_batch(batch, first, window, gram)
            batch, first, size = [], i, 0
        batch.append(t)
        size += len(t)
    if batch:
        yield _of_batch(batch, first, window, gram)


def _of_batch(texts: list[bytes], number: int, window: int, gram: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    if len(data) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    s, down = prefix_hashes(data, _TABLE)
    grams = mix((s[gram:] - s[:-gram]) * down[:len(data) - gram + 1])
    places = np.arange(len(grams), dtype=_U)
    low = sliding_min((grams >> _U(_PLACE) << _U(_PLACE)) | places, window - gram + 1)
    text = np.searchsorted(ends, np.arange(len(low)), side="right")
    inside = np.arange(len(low)) + window <= ends[np.minimum(text, len(ends) - 1)]
    starts = np.flatnonzero(inside)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    at = (low[starts] & _U((1 << _PLACE) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(starts) != 1)]))
    a, b = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    stop = b + window
    whole = mix((s[stop] - s[a]) * down[a] + (stop - a).astype(_U))
    of = text[a]
    begin = np.concatenate([[0], ends[:-1]])[of]
    return of + number, a - begin, b - begin, grams[at[new]].view(np.int64), whole.view(np.int64)
