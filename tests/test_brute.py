"""What SQL says in part or not at all, held against plain Python."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoalframe import catalogue
from shoalframe.catalogue import ctes, view
from shoalframe.operators import duplicates
from tests.conftest import SF
from tests.oracle import connect, same

def _single(sf: str = "") -> str:
    return ", s AS (SELECT *, row_number() OVER (PARTITION BY object_frame_id ORDER BY object_id) AS k FROM objects), a AS (SELECT * FROM s WHERE k = 1)"


SINGLE = (
    ctes("objects")
    + _single()
    + """, l AS (SELECT *, lag(object_posx) OVER w AS px, lag(object_posy) OVER w AS py, lag(object_width) OVER w AS pw, lag(object_height) OVER w AS ph FROM a WINDOW w AS (PARTITION BY sample_id ORDER BY object_frame_id)),
i AS (SELECT *, greatest(0, least(px + pw, object_posx + object_width) - greatest(px, object_posx)) * greatest(0, least(py + ph, object_posy + object_height) - greatest(py, object_posy)) AS c FROM l),
g AS (SELECT *, sum(CASE WHEN px IS NOT NULL AND CAST(c AS DOUBLE) / (pw * ph + object_width * object_height - c) >= 0.5 THEN 0 ELSE 1 END) OVER (PARTITION BY sample_id ORDER BY object_frame_id) AS island FROM i)
SELECT object_id, first_value(object_id) OVER (PARTITION BY sample_id, island ORDER BY object_frame_id) AS dupset_id FROM g"""
)


def test_duplicates_of_single_objects_against_sql(spark):
    """The first object of each frame alone, which gaps and islands can express."""

    def single(session, sf_dir):
        w = Window.partitionBy("object_frame_id").orderBy("object_id")
        one = view(session, sf_dir, "objects").withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")
        return duplicates.detect(one, "sample_id", "object_frame_id", min_similarity=0.5, max_age=0).select("object_id", "dupset_id")

    same(spark, connect(SF), SF, single, SINGLE)


# ---------------------------------------------------------------- plain kernels
def plain_components(cells):
    """Sets of 8-connected cells, in reading order of their first ones."""
    left, out = set(cells), []
    for start in sorted(cells):
        if start not in left:
            continue
        todo, found = [start], set()
        left.discard(start)
        while todo:
            y, x = todo.pop()
            found.add((y, x))
            near = {(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo += near
        out.append(found)
    return out


def plain_hull_area(cells):
    """Cells whose middles lie in the convex hull of all cells' edge middles."""
    points = sorted({(y + dy, x + dx) for y, x in cells for dy, dx in ((0.5, 0), (-0.5, 0), (0, 0.5), (0, -0.5))})

    def turn(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    def chain(ps):
        out = []
        for p in ps:
            while len(out) > 1 and turn(out[-2], out[-1], p) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    hull = chain(points) + chain(points[::-1])
    ys, xs = [c[0] for c in cells], [c[1] for c in cells]
    inside = lambda p: all(turn(a, b, p) >= -1e-9 for a, b in zip(hull, hull[1:] + hull[:1], strict=True))
    return sum(inside((y, x)) for y in range(min(ys), max(ys) + 1) for x in range(min(xs), max(xs) + 1))


def plain_axes(cells):
    """Axes of the ellipse with the cells' second moments; each cell is a unit square."""
    points = np.array(sorted(cells), float)
    cov = np.cov(points.T, bias=True).reshape(2, 2) + np.eye(2) / 12
    small, large = np.linalg.eigvalsh(cov)
    return 4 * np.sqrt(large), 4 * np.sqrt(max(small, 0))


def plain_region(label, cells, image):
    values = np.array([image[c] for c in sorted(cells)], float)
    ys, xs = [c[0] for c in cells], [c[1] for c in cells]
    major, minor = plain_axes(cells)
    return {
        "label": label, "area": len(cells), "min_row": min(ys), "min_col": min(xs), "max_row": max(ys) + 1, "max_col": max(xs) + 1, "centroid_row": np.mean(ys), "centroid_col": np.mean(xs),
        "major_axis": major, "minor_axis": minor, "area_convex": plain_hull_area(cells), "mean": values.mean(), "std": values.std(), "min": values.min(), "max": values.max(),
    }


def images(spark):
    return {r["object_id"]: np.array(r["pixels"]).reshape(-1, 8) for r in view(spark, SF, "images").select("object_id", "pixels").limit(150).collect()}


def bright(image, limit):
    return {(int(y), int(x)) for y, x in zip(*np.nonzero(image > limit), strict=True)}


def test_region_cutouts_against_plain_regions(spark):
    seen = 0
    found = {}
    for r in catalogue.region_cutouts(spark, SF).collect():
        found.setdefault(r["object_id"], []).append(r)
    for key, image in images(spark).items():
        want = [plain_region(n, c, image) | {"cells": c} for n, c in enumerate(plain_components(bright(image, 150)), 1)]
        want = [w for w in want if w["max"] >= 170]
        got = sorted(found.get(key, []), key=lambda r: r["label"])
        assert [r["label"] for r in got] == [w["label"] for w in want]
        for r, w in zip(got, want, strict=True):
            for name in set(w) - {"cells"}:
                assert r[name] == pytest.approx(w[name], abs=1e-9), name
            top, left = max(0, w["min_row"] - 1), max(0, w["min_col"] - 1)
            low, right = min(image.shape[0], w["max_row"] + 1), min(8, w["max_col"] + 1)
            box = [(y, x) for y in range(top, low) for x in range(left, right)]
            assert (r["row"], r["col"], r["width"]) == (top, left, right - left)
            assert r["roi"] == [int(image[c]) if c in w["cells"] else 0 for c in box] and r["roi_mask"] == [c in w["cells"] for c in box]
            seen += 1
    assert seen > 50


def test_measurements_against_plain_regions(spark):
    got = {r["object_id"]: r for r in catalogue.measure_segments(spark, SF).collect()}
    for key, image in images(spark).items():
        for channel, scores, fill in (("body", image / 255.0, True), ("gut", (image - 30) / 255.0, False)):
            cells = bright(scores, 0.5)
            r = got[key]
            assert r[f"object_{channel}_area_raw"] == len(cells)
            if fill:  # what can't reach the frame around the image by steps to the four sides
                h, w = image.shape
                free, todo = set(), [(-1, -1)]
                while todo:
                    y, x = todo.pop()
                    if (y, x) in free or (y, x) in cells or not (-1 <= y <= h and -1 <= x <= w):
                        continue
                    free.add((y, x))
                    todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
                cells = {(y, x) for y in range(h) for x in range(w)} - free
            parts = plain_components(cells)
            sizes = sorted((len(p) for p in parts), reverse=True)
            if not parts:
                assert r[f"object_{channel}_area"] == r[f"object_{channel}_area_convex"] == 0
                continue
            assert r[f"object_{channel}_area"] == sizes[0]
            best = [p for p in parts if len(p) == sizes[0]]
            assert any(r[f"object_{channel}_area_convex"] == plain_hull_area(p) and r[f"object_{channel}_major_axis_length"] == pytest.approx(plain_axes(p)[0], abs=1e-9) for p in best)


def test_duplicate_sets_group_the_duplicates(spark):
    members = {}
    for r in catalogue.dup_full(spark, SF).collect():
        members.setdefault(r["dupset_id"], set()).add(r["object_id"])
    assert all(k in v for k, v in members.items())
    assert catalogue.duplicate_sets(spark, SF).count() > 0
