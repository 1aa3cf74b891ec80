"""The E8 lattice: nearest points, neighbours and keys of its cells, on whole arrays with numpy.

E8 is the union of D8 (whole coordinates with an even sum) and D8 shifted by one half. Its cells are the nearest to
round ones that eight dimensions have, so that near points share a cell more often than in a grid of cells as large.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np

from tabledocs.llm.textscan import mixed


def _shortest() -> np.ndarray:
    """The 240 shortest vectors: those to the neighbours of a cell."""
    found = []
    for (i, j), signs in product(combinations(range(8), 2), product((1.0, -1.0), repeat=2)):
        vector = np.zeros(8)
        vector[[i, j]] = signs
        found.append(vector)
    found += [np.array(x) for x in product((0.5, -0.5), repeat=8) if sum(v < 0 for v in x) % 2 == 0]
    return np.array(found)


NEIGHBOURS = _shortest()


def _even(points: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum: where the sum is odd, the coordinate that was rounded most goes the other way."""
    near = np.rint(points)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    error = points[odd] - near[odd]
    worst = np.abs(error).argmax(axis=1)
    near[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest(points: np.ndarray) -> np.ndarray:
    """The lattice point nearest to each row of `points` (n x 8)."""
    whole, half = _even(points), _even(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def probed(points: np.ndarray, probes: int) -> np.ndarray:
    """The nearest lattice point of each row and the `probes` neighbours of that one which are nearest to the row (n x (1 + probes) x 8)."""
    home = nearest(points)
    # all neighbours are equally far from home, so the nearest ones to the point lie most in its direction
    toward = (points - home) @ NEIGHBOURS.T
    chosen = np.argsort(-toward, axis=1, kind="stable")[:, :probes]
    return np.concatenate([home[:, None], home[:, None] + NEIGHBOURS[chosen]], axis=1)


def keys(points: np.ndarray, salt: int) -> np.ndarray:
    """64 bits for each lattice point in the last axis."""
    doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
    key = np.full(points.shape[:-1], salt, np.uint64)
    for k in range(points.shape[-1]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + doubled[..., k])
    return key
