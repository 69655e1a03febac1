"""Hilbert keys of integer points in any number of dimensions (J. Skilling, "Programming the Hilbert curve",
AIP Conf. Proc. 707, 2004), for whole arrays of points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """``points``: n rows of coordinates below 2**bits; dimensions x bits must stay below 64."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(flip, low, swap) if i else np.where(flip, x[0] ^ low, x[0])
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(points), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key
