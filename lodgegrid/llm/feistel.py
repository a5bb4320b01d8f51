"""Keyed pseudorandom permutations of ``0 .. n-1``, for whole arrays inside tasks.

A balanced Feistel network permutes the smallest even-bit domain that holds ``n``; an image outside is
sent through again until it lies inside (cycle-walking), which keeps it a permutation. The domain is
under ``4 * n``, so four passes are enough on average.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 6
_MULTIPLY = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


def round_keys(*key: int) -> np.ndarray:
    """One 64-bit key per round, from whole numbers."""
    return np.random.SeedSequence([int(k) & 0xFFFFFFFF for k in key]).generate_state(ROUNDS, np.uint64)


def _pass(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ (_mix(right ^ key) & mask)
    return (left << shift) | right


def _pass_back(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys[::-1]:
        left, right = right ^ (_mix(left ^ key) & mask), left
    return (left << shift) | right


def _walk(step, x: np.ndarray, n: int, key: tuple[int, ...]) -> np.ndarray:
    half, keys = max(1, ((n - 1).bit_length() + 1) // 2), round_keys(*key)
    out = step(np.asarray(x, dtype=np.uint64), half, keys)
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = step(out[outside], half, keys)
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def permute(index: np.ndarray, n: int, *key: int) -> np.ndarray:
    """The images of ``index`` (each in ``0 .. n-1``) under the permutation of ``key``."""
    return _walk(_pass, index, n, key)


def unpermute(image: np.ndarray, n: int, *key: int) -> np.ndarray:
    """The indexes whose images under the permutation of ``key`` are given."""
    return _walk(_pass_back, image, n, key)
