"""Images, masks and scores as arrays, in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(mask: Column, threshold: float = 0.5) -> Column:
    """Elements above the threshold."""
    return F.size(F.filter(mask, lambda x: x > threshold)).cast("long")


def rescale_max(pixels: Column, full: int = 255) -> Column:
    """[0, max] mapped to [0, full]; an all-zero image stays as it is."""
    top = F.array_max(pixels)
    return F.when(top > 0, F.transform(pixels, lambda x: F.floor(x * full / top).cast("int"))).otherwise(pixels)


def has_signal(pixels: Column) -> Column:
    return F.exists(pixels, lambda x: x > 0)


def brighter_than(pixels: Column, threshold: float) -> Column:
    return F.coalesce(F.array_max(pixels) > threshold, F.lit(False))


def threshold_mask(pixels: Column, threshold: float) -> Column:
    return F.transform(pixels, lambda x: x > threshold)


def any_nonzero(scores: Column) -> Column:
    """Every non-zero score is foreground."""
    return F.transform(scores, lambda x: x != 0)


def fraction_invalid(pixels: Column, mask: Column) -> Column:
    """The share of zero pixels inside the mask; null for an empty mask."""
    inside = F.filter(F.arrays_zip(pixels.alias("p"), mask.alias("m")), lambda x: x["m"])
    return F.try_divide(F.size(F.filter(inside, lambda x: x["p"] == 0)), F.size(inside))


def to_float(pixels: Column, full: int = 255) -> Column:
    return F.transform(pixels, lambda x: x / float(full))


def grey_to_rgb(pixels: Column) -> Column:
    """Three equal channels, channel first."""
    return F.array_repeat(pixels, 3)


def centre_fit(pixels: Column, height: int, width: int, size: int, fill: int = 0) -> Column:
    """A row-major image cropped or padded about its centre to size x size."""
    top, left = (height - size) // 2, (width - size) // 2
    return F.transform(
        F.sequence(F.lit(0), F.lit(size * size - 1)),
        lambda i: F.when(
            (F.floor(i / size) + top >= 0) & (F.floor(i / size) + top < height) & (i % size + left >= 0) & (i % size + left < width),
            pixels[((F.floor(i / size) + top) * width + i % size + left).cast("int")],
        ).otherwise(F.lit(fill)),
    )


def same_shape(pixels: Column, labels: Column) -> Column:
    """Null if both have as many elements; otherwise the query fails."""
    return F.assert_true(F.size(pixels) == F.size(labels), F.lit("image and labels differ in shape"))
