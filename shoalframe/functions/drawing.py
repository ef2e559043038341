"""Overlays for looking at results."""

from __future__ import annotations

import numpy as np


def colour(n: int) -> np.ndarray:
    """A colour for label n: hues a golden angle apart."""
    h = n * 0.61803398875 % 1.0 * 6
    x = 1 - abs(h % 2 - 1)
    return np.array([(1, x, 0), (x, 1, 0), (0, 1, x), (0, x, 1), (x, 0, 1), (1, 0, x)][int(h) % 6]) * 255


def overlay(image: np.ndarray, labels: np.ndarray, alpha: float = 0.3) -> np.ndarray:
    """A grey image in colour, with each label tinted."""
    out = np.repeat(image[..., None].astype(float), 3, 2)
    for n in np.unique(labels):
        if n:
            out[labels == n] = (1 - alpha) * out[labels == n] + alpha * colour(int(n))
    return np.rint(out).astype(np.uint8)


def line(image: np.ndarray, a: tuple[float, float], b: tuple[float, float], value: np.ndarray | float = 255) -> np.ndarray:
    """The image with an anti-aliased line between two (row, column) points: each pixel by its distance to the line."""
    y, x = np.mgrid[0 : image.shape[0], 0 : image.shape[1]]
    d = np.array(b, float) - a
    n = float(d @ d)
    t = np.clip(((y - a[0]) * d[0] + (x - a[1]) * d[1]) / n, 0, 1) if n else np.zeros(y.shape)
    cover = np.clip(1.0 - np.hypot(y - a[0] - t * d[0], x - a[1] - t * d[1]), 0, 1)
    cover = cover[..., None] if image.ndim == 3 else cover
    return np.rint(image * (1 - cover) + np.asarray(value) * cover).astype(image.dtype)


def axis(region: dict, mask: np.ndarray) -> tuple[tuple[float, float], tuple[float, float]]:
    """The ends of a region's major axis."""
    ys, xs = np.nonzero(mask)
    cy, cx = region["centroid_row"], region["centroid_col"]
    angle = 0.5 * np.arctan2(2 * ((ys - cy) * (xs - cx)).mean(), ((ys - cy) ** 2).mean() - ((xs - cx) ** 2).mean())
    half = region["major_axis"] / 2
    dy, dx = half * np.cos(angle), half * np.sin(angle)
    return (cy - dy, cx - dx), (cy + dy, cx + dx)
