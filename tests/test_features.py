import itertools

import numpy as np
import pytest

from shoalframe import config
from shoalframe.functions import drawing, features, kernels
from shoalframe.operators import duplicates
from shoalframe.sources import files


def scene(seed, size=40):
    rng = np.random.default_rng(seed)
    out = np.zeros((size, size))
    for _ in range(12):
        y, x, h, w = *rng.integers(4, size - 12, 2), *rng.integers(3, 8, 2)
        out[y : y + h, x : x + w] = rng.integers(60, 255)
    return out


def test_the_same_scene_agrees_after_a_shift():
    a, b = scene(1), scene(2)
    moved = np.roll(a, (2, -1), (0, 1))
    same, other = (features.similarity(features.keypoints(a), features.keypoints(x)) for x in (moved, b))
    assert same > 0.8 > 0.5 > other


def test_quantile_keeps_the_nearest_pairs():
    a = np.array([[0.0], [10.0], [20.0], [30.0]])
    b = a + np.array([[0.5], [0.1], [0.9], [0.2]])
    assert features.match(a, b, 0.5) == [(1, 1), (3, 3)]
    assert features.match(a[:0], b) == []


def test_matching_against_brute_force():
    rng = np.random.default_rng(3)
    a, b = rng.random((4, 16)) < 0.5, rng.random((5, 16)) < 0.5
    d = (a[:, None] != b[None]).sum(2)
    best = min(sum(d[i, p[i]] for i in range(4)) for p in itertools.permutations(range(5), 4))
    assert sum(d[p] for p in features.match(a, b)) == best


def test_transforms():
    rng = np.random.default_rng(4)
    p = rng.random((20, 2)) * 50
    t = 0.3
    q = p @ np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]]).T + [3, -2]
    q[:5] += 40
    assert features.inlier_share(p, q) == pytest.approx(0.75)
    assert features.inlier_share(p[:1], q[:1]) == 0


def test_confirmation(spark):
    rows = [("a", scene(1)), ("b", np.roll(scene(1), 1, 0)), ("c", scene(2))]
    images = spark.createDataFrame([(k, v.astype(int).ravel().tolist()) for k, v in rows], "object_id string, pixels array<int>")
    found = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a")], "object_id string, dupset_id string")
    out = {r["object_id"]: r["dupset_id"] for r in duplicates.confirm(found, images, "pixels", 40).collect()}
    assert out == {"a": "a", "b": "a", "c": "c"}
    dump = duplicates.set_images(found.filter("object_id <> 'c'"), images).collect()
    assert {(r["object_id"], r["leads"], r["members"]) for r in dump} == {("a", True, 2), ("b", False, 2)}


def test_drawing(spark):
    image = np.full((9, 9), 100, np.uint8)
    labels = np.zeros((9, 9), int)
    labels[3:6, 1:8] = 1
    tinted = drawing.overlay(image, labels)
    assert (tinted[0, 0] == 100).all() and (tinted[4, 4] != 100).any()
    ends = drawing.axis(kernels.regions(labels)[0], labels == 1)
    assert ends[0][0] == pytest.approx(4) and abs(ends[0][1] - ends[1][1]) > 6
    assert (drawing.line(image, (4, 1), (4, 7))[4, 1:8] == 255).all()
    t = spark.createDataFrame([("f", image.ravel().tolist(), labels.ravel().tolist(), [0.5] * 81)], "k string, p array<int>, l array<int>, s array<double>")
    made = {r["name"]: bytes(r["content"]) for r in files.debug_images(t, "k", "p", 9, "l", "s").collect()}
    assert set(made) == {"f.png", "f_overlay.png", "f_score.png"} and (files.decode(made["f_score.png"]) == 128).all()


def test_one_of():
    assert config.one_of({"a": 1, "b": None}, "a", "b") == "a"
    with pytest.raises(ValueError, match="exactly one"):
        config.one_of({"a": 1, "b": 2}, "a", "b")
