"""Hashes of whole numbers, for draws that don't depend on how rows are spread."""

from __future__ import annotations

import numpy as np


def _finish(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """One unsigned 64-bit hash of several whole numbers, which may be arrays that broadcast."""
    state = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            number = np.uint64(part % 2**64) if isinstance(part, int) else np.asarray(part).astype(np.uint64)
            state = _finish(_finish(state + np.uint64(0x9E3779B97F4A7C15)) ^ (number + np.uint64(0x9E3779B97F4A7C15)))
    return state
