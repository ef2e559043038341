"""Segments of images held as arrays: post-processing, measurements, tiles, inference."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels


@dataclass(frozen=True)
class PostProcess:
    """Steps in their order; 0 or False turns one off."""

    opening_radius: int = 0
    closing_radius: int = 0
    clear_border: bool = False
    min_area: int = 0
    merge_segments_distance: float = 0
    isotropic: bool = False

    def __call__(self, mask: np.ndarray) -> np.ndarray:
        open_, close = (kernels.isotropic_opening, kernels.isotropic_closing) if self.isotropic else (kernels.opening, kernels.closing)
        if self.opening_radius:
            mask = open_(mask, self.opening_radius)
        if self.closing_radius:
            mask = close(mask, self.closing_radius)
        labels = kernels.components(mask)
        if self.clear_border:
            labels = kernels.clear_border(labels)
        if self.min_area:
            labels = kernels.remove_small(labels, self.min_area)
        if self.merge_segments_distance:
            labels = kernels.merge_labels(labels, self.merge_segments_distance)
        return labels


def _grids(column: pd.Series, width: int) -> list[np.ndarray]:
    return [np.asarray(v).reshape(-1, width) for v in column]


REGION = "label int, area long, min_row int, min_col int, max_row int, max_col int, centroid_row double, centroid_col double, major_axis double, minor_axis double, area_convex long, mean double, std double, min double, max double"


def segment(images: DataFrame, key: str, pixels: str, width: int, threshold: float, post: PostProcess = PostProcess(), mask: str | None = None) -> DataFrame:
    """One row for each region of each image, with its features. The mask column, or pixels over the threshold, is segmented."""
    names = [c.split()[0] for c in REGION.split(", ")]
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            masks = _grids(batch[mask], width) if mask else None
            for n, (k, image) in enumerate(zip(batch[key], _grids(batch[pixels], width), strict=True)):
                found = masks[n].astype(bool) if masks else image > threshold
                rows += [(k, *[r[c] for c in names]) for r in kernels.regions(post(found), image)]
            yield pd.DataFrame(rows, columns=[key, *names])

    return images.select(key, pixels, *([mask] if mask else [])).mapInPandas(run, f"{key} {kind}, {REGION}")


def cut_regions(images: DataFrame, key: str, pixels: str, width: int, threshold: float, padding: int = 75, min_intensity: float | None = None, apply_mask: bool = False, background: int = 0, post: PostProcess = PostProcess()) -> DataFrame:
    """One row for each region: its features and the image cut out around it with the padding.

    min_intensity: regions without a brighter pixel are left out; apply_mask: pixels of no region become `background`.
    """
    names = [c.split()[0] for c in REGION.split(", ")]
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, image in zip(batch[key], _grids(batch[pixels], width), strict=True):
                labels = post(image > threshold)
                for r in kernels.regions(labels, image):
                    if min_intensity is not None and r["max"] < min_intensity:
                        continue
                    y, x = max(0, r["min_row"] - padding), max(0, r["min_col"] - padding)
                    box = np.s_[y : r["max_row"] + padding, x : r["max_col"] + padding]
                    cut, own = image[box], labels[box] == r["label"]
                    cut = np.where(own, cut, background) if apply_mask else cut
                    rows.append((k, *[r[c] for c in names], y, x, cut.shape[1], cut.ravel().astype(int).tolist(), own.ravel().tolist()))
            yield pd.DataFrame(rows, columns=[key, *names, "row", "col", "width", "roi", "roi_mask"])

    return images.select(key, pixels).mapInPandas(run, f"{key} {kind}, {REGION}, row int, col int, width int, roi array<int>, roi_mask array<boolean>")


def map_masks(images: DataFrame, key: str, pixels: str, width: int, threshold: float, step: Callable[[np.ndarray], np.ndarray], value: str = "mask", kind: str = "boolean") -> DataFrame:
    """key, value: what the step makes of the mask of pixels over the threshold, in reading order; infinite numbers become null."""
    of = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [step(image > threshold).ravel() for image in _grids(batch[pixels], width)]
            yield pd.DataFrame({key: batch[key], value: [[v if np.isfinite(v) else None for v in f.tolist()] for f in found]})

    return images.select(key, pixels).mapInPandas(run, f"{key} {of}, {value} array<{kind}>")


def component_sizes(images: DataFrame, key: str, pixels: str, width: int, threshold: float, post: PostProcess = PostProcess()) -> DataFrame:
    """key, component (its first pixel), size."""
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, image in zip(batch[key], _grids(batch[pixels], width), strict=True):
                flat = post(image > threshold).ravel()
                labels, first, n = np.unique(flat, return_index=True, return_counts=True)
                rows += [(k, int(f), int(c)) for label, f, c in zip(labels, first, n, strict=True) if label]
            yield pd.DataFrame(rows, columns=[key, "component", "size"])

    return images.select(key, pixels).mapInPandas(run, f"{key} {kind}, component long, size long")


def measure(images: DataFrame, key: str, channels: dict[str, str], width: int, fill: bool | list[str] = False) -> DataFrame:
    """Per channel (name: column of scores): raw area, then, on the largest component, with holes filled if asked, area, major
    axis, convex area and their ratio; zeros for an empty channel."""
    kind = images.schema[key].dataType.simpleString()
    props = ("area_raw", "area", "major_axis_length", "area_convex", "area_convex_ratio")
    columns = [f"object_{c}_{p}" for c in channels for p in props]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            grids = {c: _grids(batch[col], width) for c, col in channels.items()}
            for n, k in enumerate(batch[key]):
                row = [k]
                for c in channels:
                    mask = grids[c][n] > 0.5
                    raw = int(mask.sum())
                    if fill is True or fill and c in fill:
                        mask = kernels.fill_holes(mask)
                    one = kernels.largest(kernels.components(mask))
                    r = kernels.regions(one.astype(int))
                    a, m, h = (r[0]["area"], r[0]["major_axis"], r[0]["area_convex"]) if r else (0, 0.0, 0)
                    row += [float(raw), float(a), m, float(h), a / h if h else 0.0]
                rows.append(row)
            yield pd.DataFrame(rows, columns=[key, *columns])

    return images.select(key, *channels.values()).mapInPandas(run, f"{key} {kind}, " + ", ".join(f"{c} double" for c in columns))


def tiles(images: DataFrame, key: str, pixels: str, height: int, width: int, size: int, stride: int) -> DataFrame:
    """Overlapping tiles of each image: key, top, left, tile. The last tile of a row or column ends with the image."""
    tops = sorted({*range(0, max(height - size, 0) + 1, stride), max(height - size, 0)})
    lefts = sorted({*range(0, max(width - size, 0) + 1, stride), max(width - size, 0)})
    corners = F.explode(F.array(*[F.struct(F.lit(y).alias("top"), F.lit(x).alias("left")) for y in tops for x in lefts]))
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(min(size, height) * min(size, width) - 1)),
        lambda i: F.col(pixels)[((F.col("at.top") + F.floor(i / min(size, width))) * width + F.col("at.left") + i % min(size, width)).cast("int")],
    )
    return images.withColumn("at", corners).select(key, F.col("at.top").alias("top"), F.col("at.left").alias("left"), cut.alias("tile"))


def blend(tiled: DataFrame, key: str, tile: str, size: int, linear: bool = True) -> DataFrame:
    """key, row, col, value: overlapping tiles averaged, with weights that fall linearly to the tile's edge if linear."""
    cells = tiled.select(key, "top", "left", F.posexplode(tile).alias("i", "v"))
    y, x = F.floor(F.col("i") / size), F.col("i") % size
    weight: Column = F.lit(1.0)
    if linear:
        weight = (F.least(y + 1, size - y) * F.least(x + 1, size - x)).cast("double")
    cells = cells.select(key, (F.col("top") + y).cast("long").alias("row"), (F.col("left") + x).cast("long").alias("col"), F.col("v").cast("double").alias("v"), weight.alias("w"))
    return cells.groupBy(key, "row", "col").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("value"))


def infer(table: DataFrame, column: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]], output: str = "predictions", dtype: str = "float32", batch_size: int = 0) -> DataFrame:
    """table with the model's output for each array of `column`. `load` is called once per Python worker and returns
    the model: a function of a stack of inputs. Arrays of a batch must be of one length."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            step = batch_size or len(s) or 1
            out = [np.asarray(model(np.stack(s.iloc[i : i + step].tolist()).astype(dtype)), float).reshape(min(step, len(s) - i), -1).tolist() for i in range(0, len(s), step)]
            yield pd.Series([x for part in out for x in part], index=s.index, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return table.withColumn(output, F.pandas_udf(run, "array<double>")(F.col(column)))
