"""Keypoints, binary descriptors and their matching, in numpy."""

from __future__ import annotations

import numpy as np

from .kernels import assign

#: Half-width of the patch that a descriptor looks at, and its number of comparisons.
PATCH, BITS = 7, 128


def _smooth(image: np.ndarray) -> np.ndarray:
    p = np.pad(image.astype(float), 1, mode="edge")
    rows = p[:-2] + 2 * p[1:-1] + p[2:]
    return (rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:]) / 16


def _tests() -> np.ndarray:
    """Pairs of places in the patch, the same in every process."""
    return np.random.default_rng(20).integers(-PATCH, PATCH + 1, (BITS, 4))


def keypoints(image: np.ndarray, most: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the strongest corners, and their descriptors (booleans)."""
    s = _smooth(image)
    gy, gx = np.gradient(s)
    a, b, c = _smooth(gy * gy), _smooth(gy * gx), _smooth(gx * gx)
    strength = a * c - b * b - 0.05 * (a + c) ** 2
    p = np.pad(strength, 1, constant_values=-np.inf)
    around = np.max([p[1 + y : p.shape[0] - 1 + y, 1 + x : p.shape[1] - 1 + x] for y in (-1, 0, 1) for x in (-1, 0, 1)], axis=0)
    found = np.argwhere((strength == around) & (strength > 1e-6 * max(strength.max(), 1e-12)) & (strength > 0))
    found = found[np.argsort(-strength[tuple(found.T)], kind="stable")[:most]]
    if not len(found):
        return np.zeros((0, 2)), np.zeros((0, BITS), bool)
    padded, t = np.pad(s, PATCH, mode="edge"), _tests()
    y, x = found[:, :1] + PATCH, found[:, 1:] + PATCH
    return found.astype(float), padded[y + t[:, 0], x + t[:, 1]] < padded[y + t[:, 2], x + t[:, 3]]


def match(a: np.ndarray, b: np.ndarray, quantile: float = 1.0) -> list[tuple[int, int]]:
    """The one-to-one pairs of the least total distance (Hamming for booleans, else Euclidean), of which the nearest `quantile` stay."""
    if not len(a) or not len(b):
        return []
    if a.dtype == bool:
        d = (a[:, None] != b[None]).sum(2).astype(float)
    else:
        d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    pairs = assign(-d)
    pairs.sort(key=lambda p: (d[p], p))
    return sorted(pairs[: max(1, int(np.ceil(quantile * len(pairs))))])


def _rigid(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and shift that bring p nearest to q."""
    cp, cq = p.mean(0), q.mean(0)
    u, _, vt = np.linalg.svd((p - cp).T @ (q - cq))
    d = np.diag([1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
    r = (u @ d @ vt).T
    return r, cq - r @ cp


def inlier_share(p: np.ndarray, q: np.ndarray, limit: float = 2.0, trials: int = 100, seed: int = 0) -> float:
    """The largest share of pairs that one rotation and shift brings within the limit; 0 for fewer than two."""
    if len(p) < 2:
        return 0.0
    rng, best = np.random.default_rng(seed), 0.0
    for _ in range(trials):
        k = rng.choice(len(p), 2, replace=False)
        r, t = _rigid(p[k], q[k])
        best = max(best, float((np.sqrt((((p @ r.T + t) - q) ** 2).sum(1)) < limit).mean()))
        if best == 1.0:
            break
    return best


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], quantile: float = 0.75) -> float:
    """How well two (keypoints, descriptors) agree, in 0..1."""
    pairs = match(one[1], two[1], quantile)
    if len(pairs) < 2:
        return 0.0
    i, j = map(list, zip(*pairs, strict=True))
    return inlier_share(one[0][i], two[0][j])
