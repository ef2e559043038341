import itertools
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from shoalframe.functions import expressions, geometry, kernels, names
from shoalframe.operators import duplicates, joins, metadata, segments, taxonomy


def ts(*seconds):
    return [(pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime() for s in seconds]


# ---------------------------------------------------------------- as-of
@pytest.mark.parametrize(("tolerance", "want"), [(None, 10.0), ("5s", 10.0), ("4s", None)])
def test_asof_tie_and_tolerance(spark, tolerance, want):
    left = spark.createDataFrame([(1, "s", *ts(5))], "object_id int, k string, ts timestamp_ntz")
    right = spark.createDataFrame([("s", *ts(0), 0.0), ("s", *ts(10), 10.0), ("t", *ts(5), 5.0)], "k string, ts timestamp_ntz, v double")
    assert joins.asof_nearest(left, right, ["k"], "ts", ["v"], tolerance).first()["v"] == want


def test_asof_against_pandas(spark):
    rng = random.Random(1)
    times = sorted(rng.sample(range(5000), 80))
    right = spark.createDataFrame([("s", *ts(t), float(t)) for t in times], "k string, ts timestamp_ntz, v double")
    asked = [rng.randrange(5000) for _ in range(300)]
    left = spark.createDataFrame([(i, "s", *ts(t), -1.0) for i, t in enumerate(asked)] + [(999, "s", None, -1.0)], "object_id int, k string, ts timestamp_ntz, v double")
    for limit in (None, 20):
        got = {r["object_id"]: r["v"] for r in joins.asof_nearest(left, right, ["k"], "ts", ["v"], limit and f"{limit}s").collect()}
        index = pd.Index(times)
        at = index.get_indexer(asked, method="nearest", tolerance=limit)
        assert got == {i: float(times[a]) if a >= 0 else -1.0 for i, a in enumerate(at)} | {999: -1.0}
    assert joins.asof_nearest(left, right.limit(0), ["k"], "ts", ["v"]).filter("v = -1").count() == 301


# ---------------------------------------------------------------- annotations
def merged(spark, boxes, status="validated", **options):
    objects = spark.createDataFrame([("o", "f", 0, 0, 10, 10), ("alone", "g", 0, 0, 10, 10)], "object_id string, object_frame_id string, object_posx int, object_posy int, object_width int, object_height int")
    a = spark.createDataFrame([(f"a{i}", "f", *b, "cat", status) for i, b in enumerate(boxes)], "object_id string, object_frame_id string, object_posx int, object_posy int, object_width int, object_height int, object_annotation_category string, object_annotation_status string")
    return {r["object_id"]: r for r in joins.merge_annotations(objects, a, **options).collect()}


def test_overlap_rules(spark):
    out = merged(spark, [(0, 0, 10, 5)])  # exactly 0.5
    assert out["o"]["object_annotation_category"] == "" and out["o"]["object_annotation_merge_overlap"] == 0.5
    assert out["alone"]["object_annotation_category"] is None and out["alone"]["object_annotation_merge_overlap"] is None
    assert merged(spark, [(0, 0, 10, 7)])["o"]["object_annotation_status"] == "predicted"
    assert merged(spark, [(0, 0, 10, 8)])["o"]["object_annotation_status"] == "validated"
    assert merged(spark, [(0, 0, 10, 9), (0, 0, 10, 9)])["o"]["object_annotation_merge_src"] == "a0"
    with pytest.raises(ValueError, match="lack"):
        joins.merge_annotations(spark.range(1), spark.range(1))


def test_boxes_without_area(spark):
    t = spark.createDataFrame([((0, 0, 0, 0), (0, 0, 0, 0))], "a struct<posx:int,posy:int,width:int,height:int>, b struct<posx:int,posy:int,width:int,height:int>")
    r = t.select(*[c.alias(n) for n, c in geometry.overlap("a", "b").items()]).first()
    assert (r["overlap_x"], r["overlap_xy"]) == (0, None)


boxes = st.tuples(*[st.integers(0, 30)] * 2, *[st.integers(1, 20)] * 2)


@given(st.lists(boxes, min_size=1, max_size=6))
def test_iou_is_symmetric_and_bounded(bs):
    m = duplicates.iou(np.array(bs, float), np.array(bs, float))
    assert np.allclose(m, m.T) and (m >= 0).all() and (m <= 1).all() and np.allclose(np.diag(m), 1)


# ---------------------------------------------------------------- assignment and duplicates
@settings(max_examples=60)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10**6))
def test_assignment_against_brute_force(n, m, seed):
    w = np.random.default_rng(seed).random((n, m)).round(1)
    pairs = kernels.assign(w)
    short, long = sorted((n, m))
    best = max(sum((w if n <= m else w.T)[i, p[i]] for i in range(short)) for p in itertools.permutations(range(long), short))
    assert len(pairs) == short and len({a for a, _ in pairs}) == short and len({b for _, b in pairs}) == short
    assert sum(w[a, b] for a, b in pairs) == pytest.approx(best)


def test_assignment_beats_greedy():
    assert kernels.assign(np.array([[0.98, 0.90], [0.90, 0.0]])) == [(0, 1), (1, 0)]


@pytest.mark.parametrize(("gap", "age"), list(itertools.product(range(4), range(3))))
def test_ageing(gap, age):
    m = duplicates.Matcher(0.9, age)
    box = np.array([[0, 0, 10, 10]])
    assert m.frame(["a"], box) == ["a"]
    for _ in range(gap):
        m.frame(["z"], np.array([[100, 100, 5, 5]]))
    assert m.frame(["b"], box) == (["a"] if gap <= age else ["b"])


def test_threshold_is_inclusive_and_boxes_chain():
    m = duplicates.Matcher(0.5, 0)
    m.frame(["a"], np.array([[0, 0, 10, 10]]))
    assert m.frame(["b"], np.array([[0, 0, 10, 5]])) == ["a"]
    assert m.frame(["c"], np.array([[0, 0, 10, 3]])) == ["a"]


def objects(spark, n=400, samples=7):
    rng = random.Random(3)
    rows = [(f"o{i:04d}", i % samples, i // (samples * 3), rng.randrange(4), rng.randrange(4), 10, 10) for i in range(n)]
    return rows, spark.createDataFrame(rows, "object_id string, sample int, frame int, object_posx int, object_posy int, object_width int, object_height int")


def plain(rows, by_sample=True):
    out = {}
    rows = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    matcher, last = None, None
    for (s, _), part in itertools.groupby(rows, key=lambda r: (r[1], r[2])):
        part = list(part)
        if matcher is None or by_sample and s != last:
            matcher, last = duplicates.Matcher(0.6, 1), s
        out |= dict(zip([r[0] for r in part], matcher.frame([r[0] for r in part], np.array([r[3:] for r in part])), strict=True))
    return out


@pytest.mark.parametrize("batch", ["3", "10000"])
@pytest.mark.parametrize("parts", [1, 5])
def test_detection_does_not_depend_on_partitions_or_batches(spark, batch, parts):
    rows, table = objects(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r["object_id"]: r["dupset_id"] for r in duplicates.detect(table.repartition(parts), "sample", "frame", min_similarity=0.6).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain(rows) and len(set(got.values())) < len(got)


def test_state_over_samples(spark):
    rows = [(f"o{i}", i, 0, 0, 0, 10, 10) for i in range(3)]
    table = spark.createDataFrame(rows, "object_id string, sample int, frame int, object_posx int, object_posy int, object_width int, object_height int")
    assert duplicates.keep_first(duplicates.detect(table, "sample", "frame")).count() == 3
    apart = table.withColumn("frame", F.col("sample"))
    assert duplicates.remove(apart, None, "frame", True).count() == 1
    assert duplicates.remove(apart, None, "frame", False).count() == 3


def test_streaming_detection_equals_the_batch(spark, tmp_path):
    from shoalframe.streaming import duplicates as streaming

    rows, table = objects(spark, 120, 3)
    src = str(tmp_path / "in")
    cut = sorted({r[2] for r in rows})[len({r[2] for r in rows}) // 2]
    table.filter(F.col("frame") < cut).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = streaming.detect(stream, "sample", "frame", min_similarity=0.6).writeStream.format("memory").queryName("dups").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        q.processAllAvailable()
        table.filter(F.col("frame") >= cut).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        got = {r["object_id"]: r["dupset_id"] for r in spark.table("dups").collect()}
    finally:
        q.stop()
    assert got == plain(rows)


# ---------------------------------------------------------------- metadata
def test_missing_fields_are_reported_together(spark):
    t = spark.createDataFrame([("a", ["x"]), ("b", ["x", "y"]), ("c", [])], "k string, present_keys array<string>")
    with pytest.raises(metadata.MissingMetaError, match="2 samples lack fields: a: y; c: x, y"):
        metadata.require_fields(t, "k", required=["x", "y"])
    assert metadata.require_fields(t.filter("k = 'b'"), "k", required=["x", "y"]).count() == 1


def test_settings_merge():
    base, new = {"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 5}}
    assert metadata.merge_settings(base, new) == {"a": {"b": 5, "c": 2}, "d": 3}
    assert metadata.merge_settings(base, new, keep_left=False) == {"a": {"b": 5}}


def test_maps_overlay_nulls_too(spark):
    t = spark.sql("SELECT map('a', '1', 'b', '2') AS x, map('b', CAST(NULL AS STRING), 'c', '3') AS y")
    assert t.select(metadata.overlay_maps(F.col("x"), F.col("y")).alias("m")).first()["m"] == {"a": "1", "b": None, "c": "3"}


def test_rate():
    r = metadata.Rate(0.5)
    assert r.update(0, 0) is None and r.update(10, 0) is None
    assert r.update(20, 1) == 10 and r.update(50, 2) == 20 and r.left(40) == 2


def test_telemetry_and_runs(spark):
    t = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, None), (6, None)], "t int, k string").withColumn("g", F.lit(0))
    assert [r["run"] for r in metadata.run_groups(t, ["g"], "k", ["t"]).orderBy("t").collect()] == [1, 1, 2, 3, 4, 4]
    last = spark.createDataFrame([(1, "p/2", 5), (1, "p/1", 6)], "k int, path string, v int")
    assert metadata.last_by_path(last, ["k"], "path").first()["v"] == 5


def test_observed_rows(spark):
    table, watch = metadata.observed(spark.range(5), "seen")
    table.collect()
    assert watch.get["rows"] == 5


# ---------------------------------------------------------------- expressions and names
ROWS = [(i, float(i) / 3, ["x", "yy", None][i % 3]) for i in range(12)]


@pytest.mark.parametrize(
    "text",
    ["a > 3", "1 < a <= 5", "a % 2 == 0 and not b > 2", "a in (1, 2, 3) or b * 2 >= 5", "a // 2 == 2", "abs(a - 6) < 2", "(a if a > 4 else 0) > 5", "a", "not a", "meta['a'] ** 2 < 20", "min(a, 4) == 4", "round(b) == 2"],
)
def test_expressions_mean_what_python_does(spark, text):
    t = spark.createDataFrame(ROWS, "a int, b double, s string")
    got = {r["a"] for r in metadata.where(t, text).collect()}
    assert got == {r[0] for r in ROWS if eval(text, {}, {"a": r[0], "b": r[1], "meta": {"a": r[0]}})}


def test_string_expressions(spark):
    t = spark.createDataFrame(ROWS, "a int, b double, s string")
    assert metadata.where(t, "s is None").count() == 4
    assert metadata.where(t, "s is not None and s.startswith('y')").count() == 4
    assert metadata.where(t, "'y' in s and len(s) == 2").count() == 4


@pytest.mark.parametrize("text", ["__import__('os')", "a.b", "[x for x in a]", "lambda: 1", "a = 1", "open('x')", "s.format(1)"])
def test_nothing_else_is_accepted(text):
    with pytest.raises(expressions.ExpressionError):
        expressions.compile_expression(text)


def test_unknown_names(spark):
    with pytest.raises(KeyError):
        metadata.where(spark.range(1), "nokey > 1")
    with pytest.raises(AnalysisException):
        spark.range(1).filter(expressions.compile_expression("nokey > 1")).schema


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 999999), st.integers(0, 9999), st.integers(0, 9999)), min_size=1, max_size=20))
def test_ids_come_back(spark, ids):
    t = spark.createDataFrame([("20240101", "120000", "123", *i) for i in ids], "date string, time string, ms string, seq long, posx long, posy long")
    made = t.select("*", names.format_object_id(*[F.col(c) for c in t.columns]).alias("id")).withColumn("p", names.parse_object_id(F.col("id")))
    assert made.select("p.*").collect() == t.collect()


def test_frame_ids(spark):
    t = spark.createDataFrame([("20240101 120000  123  000001 0002 0003",), ("odd",)], "object_id string")
    assert [r["object_frame_id"] for r in names.with_frame_id(t).collect()] == ["20240101 120000  123", None]
    with pytest.raises(PySparkException):
        names.with_frame_id(t, strict=True).collect()
    with pytest.raises(ValueError, match="neither"):
        names.with_frame_id(spark.range(1))


def test_formats(spark):
    r = spark.range(1).select(
        names.si(F.lit(1536.0)).alias("a"), names.si(F.lit(1536.0), 1024).alias("b"), names.interval(F.lit(3725.9)).alias("c"), names.interval(F.lit(59.9)).alias("d"),
        names.output_name(F.lit("a/b.c/x.tar.zip"), ".h5").alias("e"), names.file_suffix(F.lit("a/x.jpg"), "_mask").alias("f"), names.file_suffix(F.lit("a.b/x"), "_mask").alias("g"),
    ).first()
    assert tuple(r) == ("1.54k", "1.50Ki", "1:02:05", "00:59", "x.tar.h5", "a/x_mask.jpg", "a.b/x_mask")
    with pytest.raises(KeyError):
        names.template("{nothing}", ["a"])


def test_natural_order(spark):
    from shoalframe.sources.files import natural_order

    want = ["a/2", "a/10", "A/11", "a1/1", "a2", "a10", "b"]
    t = spark.createDataFrame([(w,) for w in reversed(want)], "path string")
    assert [r["path"] for r in natural_order(t, "path").orderBy("ordinal").collect()] == want


# ---------------------------------------------------------------- taxonomy
def test_depth_ties_and_wildcards(spark):
    t = spark.createDataFrame([(2, "a>b", "d", "two", ["x"]), (1, "a>c", "d", "one", ["x"]), (3, "a", "d", "star", ["x*"]), (4, "a>b>c", "e", "deep", [])], "ordinal int, lineage string, description string, display_name string, aliases array<string>")
    forward, backward = taxonomy.translation(t)
    assert forward.count() == 4
    assert {r["description"]: r["display_name"] for r in backward.collect()} == {"d": "one", "e": "deep"}


def test_lookup_is_strict(spark):
    t, m = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", "1")], "k string, v string")
    with pytest.raises(PySparkException, match="unknown or ambiguous"):
        joins.lookup(t, m, "k", "v").collect()
    assert joins.lookup(t.filter("k = 'a'"), m, "k", "v").first()["v"] == "1"


def test_whole_label_update(spark):
    objects = spark.createDataFrame(
        [("o1", "old", "validated", [0.95, 0.01, 0.5]), ("o2", None, None, [0.95, 0.01, 0.02]), ("o3", "fish", "predicted", [0.95, 0.05, 0.05]), ("o4", "old", "validated", [0.1, 0.95, 0.05])],
        "object_id string, object_annotation_category string, object_annotation_status string, p array<double>",
    )
    forward = spark.createDataFrame([("old", "animal"), ("fish", "animal big"), ("worm", "animal long")], "display_name string, description string")
    backward = spark.createDataFrame([("animal", "old"), ("animal big", "fish"), ("animal long", "worm")], "description string, display_name string")
    out = taxonomy.label_objects(objects, "p", ["big", "long", "odd"], forward, backward, threshold=0.9, constraints=taxonomy.parse_rules({"big": "animal", "long": "animal"}))
    got = {r["object_id"]: (r["object_annotation_category"], r["object_annotation_status"]) for r in out.collect()}
    assert got == {"o1": ("fish", "predicted"), "o2": ("fish", "predicted"), "o4": ("worm", "predicted")}


# ---------------------------------------------------------------- kernels
@settings(max_examples=40)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 12), st.floats(0.1, 0.9))
def test_components_against_flood_fill(seed, h, w, p):
    mask = np.random.default_rng(seed).random((h, w)) < p
    labels = kernels.components(mask)
    seen, number = np.zeros((h, w), int), 0
    for y, x in np.argwhere(mask):
        if not seen[y, x]:
            number += 1
            todo = [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < h and 0 <= b < w and mask[a, b] and not seen[a, b]:
                    seen[a, b] = number
                    todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    assert (labels == seen).all()


@settings(max_examples=30)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 9))
def test_distance_and_morphology_against_brute_force(seed, h, w):
    mask = np.random.default_rng(seed).random((h, w)) < 0.6
    off = np.argwhere(~mask)
    want = np.array([[min((np.hypot(y - a, x - b) for a, b in off), default=np.inf) for x in range(w)] for y in range(h)])
    assert np.allclose(kernels.distance(mask), want)
    assert (kernels.isotropic_erode(mask, 1.5) == (want > 1.5)).all()
    for r in (1, 2):
        grown = np.array([[any(mask[a, b] for a in range(h) for b in range(w) if (a - y) ** 2 + (b - x) ** 2 <= r * r) for x in range(w)] for y in range(h)])
        assert (kernels.dilate(mask, r) == grown).all()
        assert (kernels.erode(mask, r) == ~kernels.dilate(~mask, r)).all()


def test_labels_merge_into_the_lowest_only():
    labels = np.zeros((5, 40), int)
    labels[2, 0:2], labels[2, 30:32], labels[2, 34:36] = 1, 2, 3
    assert (kernels.merge_labels(labels, 4) == labels).all()
    labels[2, 4:6] = 4
    out = kernels.merge_labels(labels, 4)
    assert (out[2, 0:6] == 1).all() and out[2, 30] == 2 and out[2, 34] == 3


def test_holes_border_small_largest():
    ring = np.zeros((7, 7), bool)
    ring[1:6, 1:6], ring[2:5, 2:5] = True, False
    assert kernels.fill_holes(ring).sum() == 25 and not kernels.fill_holes(np.zeros((3, 3), bool)).any()
    labels = np.array([[1, 0, 0, 0], [0, 0, 2, 0], [0, 0, 0, 0], [0, 3, 3, 0]])
    assert set(np.unique(kernels.clear_border(labels))) == {0, 2}
    assert set(np.unique(kernels.remove_small(labels, 2))) == {0, 3}
    assert kernels.largest(labels).sum() == 2 and not kernels.largest(np.zeros((2, 2), int)).any()


def test_region_of_a_rectangle():
    labels = np.zeros((10, 10), int)
    labels[2:5, 1:9] = 1
    r = kernels.regions(labels, np.full((10, 10), 7))[0]
    assert (r["area"], r["area_convex"], r["min_row"], r["max_col"], r["mean"], r["std"]) == (24, 24, 2, 9, 7, 0)
    assert r["major_axis"] > r["minor_axis"] > 0


def test_empty_channels_measure_zero(spark):
    t = spark.createDataFrame([(1, [0.0] * 9)], "k int, c array<double>")
    assert set(segments.measure(t, "k", {"c": "c"}, 3).drop("k").first()) == {0.0}


def test_tiles_blend_back(spark):
    t = spark.createDataFrame([(1, list(range(35)))], "k int, p array<int>")
    tiled = segments.tiles(t, "k", "p", 5, 7, 3, 2)
    for linear in (True, False):
        got = {(r["row"], r["col"]): r["value"] for r in segments.blend(tiled, "k", "tile", 3, linear).collect()}
        assert got == {(i // 7, i % 7): pytest.approx(i) for i in range(35)}
