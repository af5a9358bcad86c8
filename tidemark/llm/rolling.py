"""Polynomial hashes of byte strings modulo 2^64, for whole arrays."""

from __future__ import annotations

from functools import cache

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


#: A random number per byte.
LETTERS = mix(np.arange(256, dtype=np.uint64) * np.uint64(BASE) + np.uint64(BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i up to n at least; kept for few sizes."""
    return _powers(1 << (max(n, 1) - 1).bit_length())


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(BASE))]))
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(pow(BASE, -1, 1 << 64)))]))
    return up, down
