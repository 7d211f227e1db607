"""SHA-256 over many inputs at once, with states that can be kept and resumed.

A state is eight 32-bit words.  A digest in hex is 64 bytes, just one block of
the function, so the state after any number of digests is what can be stored
and continued.  Only what a tree of hex digests needs is here; whole messages
are hashed with hashlib or Spark.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))]


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


#: The start state and the rounds' constants: fractions of the primes' square and cube roots.
START = np.array([isqrt(p << 64) % (1 << 32) for p in _PRIMES[:8]], np.uint32)
_ROUND = np.array([_cube_root(p << 96) % (1 << 32) for p in _PRIMES], np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one block (n, 16) each."""
    w = list(np.broadcast_to(blocks, (len(states), 16)).T)
    a, b, c, d, e, f, g, h = states.T
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
            large = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
            w.append(w[i - 16] + small + w[i - 7] + large)
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + _ROUND[i] + w[i]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """The block (n, 16) that each digest (n, 8) makes as hex text."""
    raw = np.ascontiguousarray(digests.astype(">u4")).view(np.uint8).reshape(len(digests), 32)
    text = _HEX[np.stack([raw >> 4, raw & 15], axis=2)].reshape(len(digests), 64)
    return np.ascontiguousarray(text).view(">u4").astype(np.uint32)


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of inputs that ended after ``blocks`` (n,) whole blocks."""
    pad = np.zeros((len(states), 16), np.uint32)
    pad[:, 0], pad[:, 15] = 0x80000000, blocks * 512
    return absorb(states, pad)


def packed(words: np.ndarray) -> bytes:
    return words.astype(">u4").tobytes()


def unpacked(data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data, ">u4").astype(np.uint32).reshape(*shape, 8)
