"""Box overlap and box geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _extent(a0: Column, a1: Column, b0: Column, b1: Column) -> tuple[Column, Column]:
    """Common and joint length of two intervals."""
    common = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))
    return common, F.greatest(a1, b1) - F.least(a0, b0)


def overlap(x: str | Column, y: str | Column) -> dict[str, Column]:
    """overlap_x, overlap_y and overlap_xy (intersection over union) of two boxes.

    x and y name structs or aliases with posx, posy, width, height. Joint lengths count as 1 at least; boxes without
    area have a null overlap_xy.
    """

    def at(box: str | Column, name: str) -> Column:
        return F.col(f"{box}.{name}") if isinstance(box, str) else box[name]

    ax, ay, aw, ah = (at(x, n) for n in ("posx", "posy", "width", "height"))
    bx, by, bw, bh = (at(y, n) for n in ("posx", "posy", "width", "height"))
    cx, jx = _extent(ax, ax + aw, bx, bx + bw)
    cy, jy = _extent(ay, ay + ah, by, by + bh)
    both = cx * cy
    return {
        "overlap_x": cx / F.greatest(F.lit(1), jx),
        "overlap_y": cy / F.greatest(F.lit(1), jy),
        "overlap_xy": F.try_divide(both, aw * ah + bw * bh - both),
    }


def box(prefix: str = "object_", alias: str | None = None) -> Column:
    """A struct of posx, posy, width, height from prefixed columns."""
    lead = f"{alias}." if alias else ""
    return F.struct(*[F.col(f"{lead}{prefix}{n}").alias(n) for n in ("posx", "posy", "width", "height")])


def region_geometry(posx: Column, posy: Column, bbox: Column) -> dict[str, Column]:
    """Place and size of a region (min_row, min_col, max_row, max_col) found in an image placed at posx, posy."""
    return {
        "object_posx": posx + bbox["min_col"],
        "object_posy": posy + bbox["min_row"],
        "object_width": bbox["max_col"] - bbox["min_col"],
        "object_height": bbox["max_row"] - bbox["min_row"],
    }


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0 or either is missing."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))
