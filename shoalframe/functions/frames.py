"""Whole frames in numpy: pasting cut-outs, model input, tiles and their blending."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Side of the window that a model sees of an image that isn't tiled.
WINDOW = 1024


def paste(parts: list[tuple[int, int, np.ndarray]]) -> tuple[int, int, np.ndarray]:
    """One image of grey cut-outs (top, left, image), and where it begins; later ones lie over earlier ones, what none covers is 0."""
    top, left = min(p[0] for p in parts), min(p[1] for p in parts)
    out = np.zeros((max(y + i.shape[0] for y, _, i in parts) - top, max(x + i.shape[1] for _, x, i in parts) - left), np.uint8)
    for y, x, image in parts:
        out[y - top : y - top + image.shape[0], x - left : x - left + image.shape[1]] = image
    return top, left, out


def model_input(image: np.ndarray, dtype: str) -> np.ndarray:
    """Three equal channels first, 0..255 scaled to 0..1. Only floating types can take that."""
    kind = np.dtype(dtype)
    if kind.kind != "f":
        raise ValueError(f"can't convert images to {dtype}")
    return np.repeat((image.astype(kind) / kind.type(255))[None], 3, 0)


def centre(image: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """The window of size x size around the middle; where the image ends before, 0."""
    out = np.zeros((size, size), image.dtype)
    h, w = image.shape
    cut = image[max(0, (h - size) // 2) :, max(0, (w - size) // 2) :][:size, :size]
    y, x = (size - cut.shape[0]) // 2, (size - cut.shape[1]) // 2
    out[y : y + cut.shape[0], x : x + cut.shape[1]] = cut
    return out


def corners(length: int, size: int, stride: int) -> list[int]:
    """Where tiles begin; the last one ends with the image."""
    return sorted({*range(0, max(length - size, 0) + 1, stride), max(length - size, 0)})


def run_model(net: Callable[[np.ndarray], np.ndarray], inputs: list[np.ndarray], batch_size: int = 0) -> list[np.ndarray]:
    """The output for each input, in batches of one shape. Of several outputs, the first counts."""
    out: list[np.ndarray] = [np.zeros(0)] * len(inputs)
    shapes: dict[tuple, list[int]] = {}
    for i, x in enumerate(inputs):
        shapes.setdefault(x.shape, []).append(i)
    for which in shapes.values():
        step = batch_size or len(which)
        for at in range(0, len(which), step):
            found = net(np.stack([inputs[i] for i in which[at : at + step]]))
            found = found[0] if isinstance(found, (tuple, list)) else found
            for i, y in zip(which[at : at + step], np.asarray(found), strict=True):
                out[i] = y
    return out


def tiled(net: Callable[[np.ndarray], np.ndarray], image: np.ndarray, dtype: str, size: int, stride: int, linear: bool, batch_size: int = 0, skip_empty: bool = False) -> np.ndarray:
    """The model's scores (channel, row, column) for the whole image from overlapping tiles.

    Tiles are averaged, with weights that fall linearly to a tile's edge if linear. skip_empty: tiles without any light
    aren't scored; where there is no other, the score is 0.
    """
    h, w = image.shape
    places = [(y, x) for y in corners(h, size, stride) for x in corners(w, size, stride)]
    places = [(y, x) for y, x in places if not skip_empty or image[y : y + size, x : x + size].any()]
    scores = run_model(net, [model_input(image[y : y + size, x : x + size], dtype) for y, x in places], batch_size)
    scores = [s if s.ndim == 3 else s[None] for s in scores]
    total, weight = np.zeros((scores[0].shape[0] if scores else 1, h, w)), np.zeros((h, w))
    for (y, x), s in zip(places, scores, strict=True):
        th, tw = s.shape[1:]
        each = np.ones((th, tw))
        if linear:
            ramp = lambda n: np.minimum(np.arange(n) + 1, n - np.arange(n))
            each = np.outer(ramp(th), ramp(tw)).astype(float)
        total[:, y : y + th, x : x + tw] += s * each
        weight[y : y + th, x : x + tw] += each
    return total / np.where(weight > 0, weight, 1)
