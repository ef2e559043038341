import io
import zipfile

import numpy as np
import pandas as pd
import pytest
import yaml
from pydantic import ValidationError
from pyspark.sql import functions as F

from shoalframe import config
from shoalframe.__main__ import main
from shoalframe.plans import tasks
from shoalframe.sources import files

META = {f: "1" for f in ["sample_bottomdepth", "sample_region", "sample_detail_location", "sample_vessel", "sample_latitude", "sample_longitude", "sample_station", "sample_haul"]}


def image(seed, size=12):
    im = np.random.default_rng(seed).integers(0, 40, (size, size)).astype(np.uint8)
    im[3:7, 3:8] = 200
    return im


@pytest.fixture
def samples(tmp_path):
    for s, haul in (("s2", 2), ("s10", 10)):
        root = tmp_path / "raw" / s
        for d in ("Pictures/00", "Telemetrie", "Log"):
            (root / d).mkdir(parents=True)
        (root / "Log/LOKI1.log").write_text("DEVICE: x\nsample_haul: 0\n")
        (root / "meta.yaml").write_text(yaml.safe_dump(META | {"sample_haul": haul}))
        (root / "Telemetrie/20240101 120000.tmd").write_text("TEMP: 4.5\nPRESS;10\n")
        (root / "Telemetrie/20240101 120000.dat").write_text("TEMP 9\n")
        (root / "Telemetrie/20240101 130000.dat").write_text("TEMP 6\n")
        for i in range(3):
            (root / f"Pictures/00/20240101 12{i}000  123  {i:06d} 0010 0020.png").write_bytes(files.encode_png(image(i)))
        (root / "Pictures/00/20240101 120000  123  000009 0010 0020.png").write_bytes(b"broken")
        (root / "Pictures/00/note.txt").write_text("x")
    (tmp_path / "raw/other").mkdir()
    return tmp_path


def test_pictures_are_decoded():
    grey = image(1)
    assert (files.decode(files.encode_png(grey)) == grey).all()
    rgb = np.repeat(grey[..., None], 3, 2)
    assert (files.decode(files.encode_png(rgb)) == grey).all()
    with pytest.raises(ValueError, match="unknown"):
        files.decode(b"GIF89a")


def jpeg(spark, image, path, grey=False):
    """Written by the JVM's own encoder."""
    h, w = image.shape[:2]
    kind = spark._jvm.java.awt.image.BufferedImage
    out = kind(w, h, kind.TYPE_BYTE_GRAY if grey else kind.TYPE_INT_RGB)
    for y in range(h):
        for x in range(w):
            r, g, b = (int(v) for v in np.broadcast_to(image[y, x], 3))
            out.setRGB(x, y, r << 16 | g << 8 | b) if not grey else out.getRaster().setSample(x, y, 0, r)
    assert spark._jvm.javax.imageio.ImageIO.write(out, "jpg", spark._jvm.java.io.File(str(path)))
    return path.read_bytes()


@pytest.mark.parametrize("grey", [True, False])
def test_jpeg_pictures(spark, tmp_path, grey):
    """Against the JVM's own decoder, through Spark's picture source; sizes that no block or group of blocks divides."""
    rng = np.random.default_rng(3)
    y, x = np.mgrid[0:37, 0:53]
    smooth = 128 + 90 * np.sin(y / 7) * np.cos(x / 9)
    image = np.clip(smooth[..., None] + [0, 20, -20] + rng.normal(0, 6, (37, 53, 1)), 0, 255).astype(np.uint8)
    data = jpeg(spark, image[..., 0] if grey else image, tmp_path / "a.jpg", grey)
    found = spark.read.format("image").load(f"file://{tmp_path}").first()["image"]
    want = np.frombuffer(found["data"], np.uint8).reshape(found["height"], found["width"], -1)
    want = want[..., 0] if grey else want[..., ::-1].astype(int) @ np.array([19595, 38470, 7471]) + 0x8000 >> 16
    got = files.decode(data)
    assert got.shape == (37, 53) and np.abs(got.astype(int) - want).mean() < (1 if grey else 2.5)
    for bad in (data[:200], data[:-40] + b"\0" * 40, data[:3]):
        try:
            files.decode(bad)
        except Exception as e:  # noqa: BLE001
            assert not isinstance(e, files.Unsupported)


def test_kinds_that_are_not_read_fail_the_query(spark, tmp_path):
    progressive = jpeg(spark, image(1), tmp_path / "a.jpg", True).replace(b"\xff\xc0", b"\xff\xc2")
    with pytest.raises(Exception, match="baseline"):
        files.read_images(spark.createDataFrame([(bytearray(progressive),)], "content binary")).collect()
    assert files.read_images(spark.createDataFrame([(bytearray(b"broken"),)], "content binary")).first()["pixels"] is None


def test_frames_are_pasted_and_tiled():
    from shoalframe.functions import frames

    a, b = np.full((2, 3), 7, np.uint8), np.full((1, 1), 9, np.uint8)
    top, left, image_ = frames.paste([(5, 4, a), (8, 2, b)])
    assert (top, left) == (5, 2) and image_.tolist() == [[0, 0, 7, 7, 7], [0, 0, 7, 7, 7], [0, 0, 0, 0, 0], [9, 0, 0, 0, 0]]
    rng = np.random.default_rng(1)
    whole = rng.integers(1, 255, (23, 17)).astype(np.uint8)
    for linear in (True, False):
        seen = []

        def net(x):
            seen.append(x.shape)
            return x[:, :2] * 2

        got = frames.tiled(net, whole, "float32", 8, 6, linear, batch_size=2)
        assert np.allclose(got, np.stack([whole, whole]) / 255 * 2, atol=1e-6) and all(s[1:] == (3, 8, 8) and s[0] <= 2 for s in seen)
    # by hand: two tiles of 3 with a stride of 2, which say 1 and 3
    say = iter([1.0, 3.0])
    row = frames.tiled(lambda x: np.full((1, 1, 1, 3), next(say)), np.ones((1, 5), np.uint8), "float32", 3, 2, True, 1)
    assert np.allclose(row[0, 0], [1, 1, 2, 3, 3])
    dark = np.zeros((4, 12), np.uint8)
    dark[0, 0] = 1
    assert frames.tiled(lambda x: np.ones((len(x), 1, 4, 4)), dark, "float32", 4, 4, False, skip_empty=True).sum() == 16
    assert frames.centre(np.ones((3, 1030), np.uint8)).sum() == 3 * 1024
    with pytest.raises(ValueError, match="can't convert"):
        frames.model_input(whole, "int32")


def test_samples_are_found_and_read(spark, samples):
    listing = files.files(spark, str(samples / "raw"), ["*.txt"])
    assert [r["root"].rsplit("/", 1)[1] for r in files.sample_roots(listing).orderBy("ordinal").collect()] == ["s2", "s10"]
    assert files.pictures(listing).count() == 8
    t = files.telemetry(listing).orderBy("root", "ts").collect()
    assert [(r["object_temperature"], r["object_pressure"]) for r in t] == [(4.5, 10.0), (6.0, None)] * 2
    assert {r["meta"]["sample_haul"] for r in files.sample_metadata(listing).collect()} == {"2", "10"}


def test_segment_task(spark, samples):
    task = config.SegmentTask.model_validate(
        {
            "input": {"path": str(samples / "raw"), "filter_expr": "object_width > 5", "merge_telemetry": True, "save_meta": True},
            "segmentation": {"threshold": 100},
            "postprocess": {"rescale_max_intensity": True, "filter_expr": "object_area == 20"},
            "output": {"target_dir": f"file://{samples}/out", "image_fn": "{object_id}.png", "store_mask": True, "skip_existing": True},
        }
    )
    tasks.run_segment(spark, task, "2024")
    with zipfile.ZipFile(samples / "out/LOKI_1_2.zip") as z:
        rows = pd.read_csv(z.open("ecotaxa_export.tsv"), sep="\t", dtype=str)
        names = z.namelist()
    assert list(rows["object_area"]) == ["[f]", "20", "20", "20"] and list(rows["object_temperature"][1:]) == ["4.5"] * 3
    assert set(rows["process_id"][1:]) == {"LOKI_1_2_2024"} and sum(n.endswith("_mask.png") for n in names) == 3
    assert (samples / "out/input_LOKI_1_10.zip").exists()
    assert tasks.read_samples(spark, task, "2024").count() == 0  # both are there already


def test_missing_metadata_stops_before_anything_runs(spark, samples):
    (samples / "raw/s2/meta.yaml").write_text("sample_station: 1\n")
    task = config.SegmentTask.model_validate({"input": {"path": str(samples / "raw")}, "segmentation": {"threshold": 1}, "output": {"target_dir": "x"}})
    with pytest.raises(ValueError, match="1 samples lack fields.*sample_vessel"):
        tasks.read_samples(spark, task, "2024")


def test_model_segmentation(spark, samples):
    task = config.SegmentTask.model_validate(
        {"input": {"path": str(samples / "raw")}, "segmentation": {"model": {"model_fn": "unused:x", "postprocess": {"min_area": 5}, "padding": 1}}, "output": {"target_dir": "x"}}
    )
    objects = tasks.read_objects(spark, task, tasks.read_samples(spark, task, "2024"))
    bright = lambda: lambda x: (x[:, 0] > 100 / 255).astype(float)
    out = tasks.segment_objects(task, objects, bright).collect()
    assert len(out) == 6
    assert {(r["object_posx"], r["object_posy"], r["object_width"], r["object_height"], r["height"], r["width"]) for r in out} == {(13, 23, 5, 4, 6, 7)}
    assert {(r["object_sequence"], r["object_frac_invalid"]) for r in out} == {(1, 0.0)}
    one = objects.limit(1)
    both = one.withColumn("object_id", F.concat("object_id", F.lit("b"))).withColumn("object_posx", F.col("object_posx") + 30).union(one)
    out = tasks.segment_objects(task, both, bright).orderBy("object_label").collect()
    assert [(r["object_posx"], r["object_posy"], r["object_sequence"]) for r in out] == [(13, 23, 1), (43, 23, 2)]
    alone = config.SegmentTask.model_validate(task.model_dump() | {"segmentation": {"model": {"model_fn": "unused:x", "stitch": {"skip_single": True}}}})
    assert tasks.segment_objects(alone, objects, bright).count() == 0
    apart = config.SegmentTask.model_validate(task.model_dump() | {"segmentation": {"model": {"model_fn": "unused:x", "stitch": False}}})
    assert tasks.segment_objects(apart, both, bright).count() == 2
    whole = config.SegmentTask.model_validate(task.model_dump() | {"segmentation": {"model": {"model_fn": "unused:x", "full_frame_archive_fn": "frames_{sample_id}.zip"}}})
    made = tasks.debug_frames(whole, both, bright).collect()
    with zipfile.ZipFile(io.BytesIO(made[0]["content"])) as z:
        inside = sorted(n for n in z.namelist() if n.endswith(".png"))
        assert [n.partition("/")[0] for n in inside] == ["img", "overlay", "score"] and files.decode(z.read(inside[0])).shape == (12, 42)


def test_predict_task(spark, tmp_path):
    """Everything that prediction gives, for one archive of two objects."""
    rows = pd.DataFrame({"object_id": ["a", "b"], "object_annotation_category": ["old", ""], "object_annotation_status": ["predicted", ""], "junk": ["1", "2"], "img_file_name": ["a.png", "b.png"]})
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("t.tsv", rows.to_csv(sep="\t", index=False))
        z.writestr("a.png", files.encode_png(image(1)))
        z.writestr("b.png", files.encode_png(image(2)))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.zip").write_bytes(out.getvalue())
    task = config.PredictTask.model_validate(
        {"input": {"path": str(tmp_path / "in")}, "model": {"model_fn": "unused:x", "meta": {"outputs": {"y": {"channel_names": ["body"]}}}}, "segmentation": True, "save_raw_h5": True, "target_dir": f"file://{tmp_path}/out"}
    )
    model = lambda: lambda x: (x[:, :1] > 100 / 255).astype("float32")
    plan = tasks.predict(spark, task, model)
    assert {len(r["predictions"]) for r in plan.predictions.collect()} == {1024 * 1024}
    assert {(r["archive"], r["object_body_area"]) for r in plan.measurements.collect()} == {("x.segmentation.zip", 20.0)}
    small = task.model_dump() | {"model": {"model_fn": "unused:x", "batch_size": 2, "tiling": {"size": 8, "stride": 6}}, "segmentation": {"draw": True}}
    model.meta = {"outputs": {"y": {"channel_names": ["body"]}}}
    plan = tasks.predict(spark, config.PredictTask.model_validate(small), model)
    assert {len(r["predictions"]) for r in plan.predictions.collect()} == {144}
    drawn = plan.measurements.collect()
    assert {r["file"] for r in drawn} == {"a.png", "b.png"} and all(files.decode(bytes(r["image"])).shape == (12, 12) for r in drawn)
    assert {(r["archive"], r["object_body_area"], r["object_body_area_convex_ratio"]) for r in plan.measurements.collect()} == {("x.segmentation.zip", 20.0, 1.0)}
    (tmp_path / "tree.yaml").write_text("animal: {children: {fish: {}, odd: {predict: false}}}\n")
    (tmp_path / "lineages.csv").write_text("lineage,display_name\nanimal,old\nanimal>fish,fish\n")
    labels = {"taxonomy_fn": str(tmp_path / "tree.yaml"), "lineages_fn": str(tmp_path / "lineages.csv"), "prediction_constraint_rules": {"fish": "animal"}}
    task = config.PredictTask.model_validate(task.model_dump() | {"labels": labels, "model": {"model_fn": "u:x", "meta": {"outputs": {"y": {"channel_names": ["fish", "odd"]}}}}, "segmentation": False})
    sure = lambda: lambda x: np.tile([0.95, 0.97], (len(x), 1))
    plan = tasks.predict(spark, task, sure)
    got = plan.labels.collect()
    assert {(r["object_id"], r["object_annotation_category"], r["object_annotation_status"]) for r in got} == {("a", "fish", "predicted"), ("b", "fish", "predicted")}
    assert plan.missing.count() == 0 and "object_junk" not in plan.labels.columns
    (tmp_path / "lineages.csv").write_text("lineage,display_name\nanimal,old\n")
    labels |= {"skip_unchanged_objects": False}
    wide = config.PredictTask.model_validate(task.model_dump() | {"labels": labels | {"strip_metadata": False}})
    plan = tasks.predict(spark, wide, sure)
    assert [tuple(r) for r in plan.missing.collect()] == [("animal fish", 2)] and "img_file_name" in plan.labels.columns


def test_progress_is_logged(spark, caplog):
    import time

    with caplog.at_level("INFO"), tasks.progress(spark, "100ms"):
        time.sleep(0.5)
    assert any("tasks a second" in r.message for r in caplog.records)


def test_files_are_written_by_the_tasks(spark, tmp_path):
    built = spark.createDataFrame([("a.zip", bytearray(b"1")), ("sub/b.zip", bytearray(b"22"))], "name string, content binary").repartition(2)
    for _ in range(2):  # once more over the first ones
        assert sorted(files.save_files(built, f"file://{tmp_path}/out")) == ["a.zip", "sub/b.zip"]
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a.zip", "sub/b.zip"]
    assert (tmp_path / "out/sub/b.zip").read_bytes() == b"22"


def test_settings(tmp_path, capsys):
    base = {"input": {"path": "x", "detect_duplicates": True, "merge_telemetry": False}, "segmentation": {"threshold": 5}, "output": {"target_dir": "y"}, "postprocess": {"merge_annotations": "a.tsv"}}
    t = config.SegmentTask.model_validate(base)
    assert t.input.detect_duplicates.max_age == 1 and t.input.merge_telemetry is False and t.postprocess.merge_annotations.annotations_fn == "a.tsv"
    not_honoured = [{"segmentation": {"model": {"model_fn": "m", **x}}} for x in ({"device": "cuda"}, {"autocast": True}, {"n_threads": 4})] + [{"output": {"target_dir": "y", "image_fn": "{object_id}.jpg"}}]
    for bad in ({"segmentation": {}}, {"segmentation": {"threshold": 1, "model": "m"}}, {"extra": 1}, *not_honoured):
        with pytest.raises(ValidationError):
            config.SegmentTask.model_validate(base | bad)
    for kind in config.TASKS:
        assert main(["config", kind]) == 0
        shown = yaml.safe_load(capsys.readouterr().out)
        assert "slice" not in shown["input"] and "max_n_objects" not in shown["input"]
    with pytest.raises(ValueError, match="unknown task"):
        config.example("x")
    (tmp_path / "t.yaml").write_text("input: {}\n")
    with pytest.raises(ValidationError):
        config.load(str(tmp_path / "t.yaml"), "segment")
