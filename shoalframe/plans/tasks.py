"""The two tasks as plans: raw samples to segmented objects, and archives to predictions. Nothing runs before the sinks."""

from __future__ import annotations

import importlib.util
import logging
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ModelMeta, PredictTask, SegmentTask
from ..functions import arrays, frames, names
from ..operators import duplicates, joins, metadata, segments, taxonomy
from ..sources import files

Model = Callable[[np.ndarray], np.ndarray]
#: Side and distance of the tiles that segmentation cuts frames into.
TILES = (1024, 896)

log = logging.getLogger(__name__)


def load_model(reference: str) -> Callable[[], Model]:
    """`module:factory`; the factory is called once per worker and returns a function of a stack of inputs."""
    module, _, factory = reference.partition(":")

    def load() -> Model:
        return getattr(importlib.import_module(module), factory)()

    load.meta = getattr(getattr(importlib.import_module(module), factory, None), "meta", None) if importlib.util.find_spec(module) else None
    return load


# ---------------------------------------------------------------- segmentation
def read_samples(spark: SparkSession, task: SegmentTask, now: str) -> DataFrame:
    """root and metadata of each sample, checked before anything else runs."""
    listing = files.files(spark, task.input.path, task.input.ignore_patterns)
    roots = files.sample_roots(listing, task.input.discover)
    meta = roots.join(files.sample_metadata(listing), "root", "left")
    defaults = {"acq_instrument": names.INSTRUMENT} | {k: None if v is None else str(v) for k, v in task.input.default_meta.items()}
    base = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.lit(v).cast("string"))])
    meta = meta.withColumn("meta", metadata.overlay_maps(base, F.coalesce("meta", F.create_map().cast("map<string,string>"))))
    present = meta.withColumn("present_keys", F.map_keys(F.map_filter("meta", lambda _, v: v.isNotNull())))
    meta = metadata.require_fields(present, "root").drop("present_keys")
    made = names.generated_ids(F.col("meta")["sample_station"], F.col("meta")["sample_haul"], F.col("meta")["acq_instrument"], F.lit(now))
    meta = meta.withColumns(made).withColumn("archive", names.archive_name(F.col("meta")["sample_station"], F.col("meta")["sample_haul"]))
    if task.output.skip_existing:
        meta = joins.skip_existing(meta, files.existing_names(spark, task.output.target_dir).withColumnRenamed("name", "archive"), "archive")
    return meta


def read_objects(spark: SparkSession, task: SegmentTask, samples: DataFrame) -> DataFrame:
    """The pictures of the samples, selected and decoded, with places, sizes and telemetry."""
    listing = files.files(spark, task.input.path, task.input.ignore_patterns)
    t = files.pictures(listing).join(samples.drop("meta", "ordinal"), "root")
    parsed = names.parse_object_id(F.col("object_id"))
    t = t.withColumn("_p", parsed).withColumns({"object_sequence": F.col("_p.seq"), "object_posx": F.col("_p.posx"), "object_posy": F.col("_p.posy")}).drop("_p")
    t = names.with_frame_id(t)
    if task.input.valid_frames_fn:
        t = joins.in_frames(t, names.with_frame_id(files.read_tsv(spark, task.input.valid_frames_fn)))
    t = metadata.first_rows(t, task.input.slice, ["root", "path"])
    t = files.read_images(t).filter("pixels is not null")
    t = t.withColumns({"object_height": F.col("height"), "object_width": F.col("width"), "object_bounding_box_area": F.col("height") * F.col("width")})
    if task.input.filter_expr:
        t = metadata.where(t, task.input.filter_expr)
    t = duplicates.remove(t, "sample_id", "object_frame_id", task.input.detect_duplicates and task.input.detect_duplicates.model_dump())
    if task.input.merge_telemetry:
        sensors = files.telemetry(listing)
        values = [c for c in sensors.columns if c not in ("root", "ts")]
        if values:
            t = t.withColumn("ts", names.file_time(F.col("object_id")))
            t = joins.asof_nearest(t, sensors, ["root"], "ts", values, task.input.merge_telemetry.tolerance).drop("ts")
    return t


def segment_objects(task: SegmentTask, objects: DataFrame, model: Callable[[], Model] | None = None) -> DataFrame:
    """Objects with mask and features. A threshold keeps an object whole; a model's scores are cut into regions."""
    s = task.segmentation
    if s.threshold:
        limit = s.threshold.threshold_brighter
        t = objects.filter(arrays.brighter_than(F.col("pixels"), limit)).withColumn("mask", arrays.threshold_mask(F.col("pixels"), limit))
        t = t.withColumn("object_area", arrays.area(F.transform("mask", lambda m: m.cast("int"))))
        inside = F.filter(F.arrays_zip("pixels", "mask"), lambda x: x["mask"])
        t = t.withColumn("object_mean", F.try_divide(F.aggregate(inside, F.lit(0).cast("long"), lambda a, x: a + x["pixels"]), F.size(inside)))
    else:
        t = _by_model(task, objects, model or load_model(s.model.model_fn))
    return metadata.where(t, s.filter_expr) if s.filter_expr else t


def stitched(objects: DataFrame, skip_single: bool = False) -> DataFrame:
    """One row for each frame: its objects pasted at their places, with the other columns of its first object."""
    import pandas as pd

    key = ["sample_id", "object_frame_id"]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("object_id")
        parts = [(int(r.object_posy), int(r.object_posx), np.asarray(r.pixels, np.uint8).reshape(int(r.height), int(r.width))) for r in group.itertuples()]
        if skip_single and len(parts) < 2:
            return group.iloc[:0]
        top, left, image = frames.paste(parts)
        out = group.iloc[:1].copy()
        out["pixels"] = [image.ravel().astype(int).tolist()]
        return out.assign(object_posy=top, object_posx=left, height=image.shape[0], width=image.shape[1])

    return objects.groupBy(*key).applyInPandas(run, objects.schema)


def _scores(s, net: Model, r: dict) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
    """A frame's image and its foreground scores, from tiles of the fixed size."""
    image = np.asarray(r["pixels"], np.uint8).reshape(int(r["height"]), int(r["width"]))
    return image, frames.tiled(net, image, s.dtype, *TILES, linear=False, batch_size=s.batch_size, skip_empty=True)[0]


def _post(s) -> segments.PostProcess:  # noqa: ANN001
    return segments.PostProcess(**s.postprocess.model_dump(exclude={"n_threads"})) if s.postprocess else segments.PostProcess()


def debug_frames(task: SegmentTask, objects: DataFrame, model: Callable[[], Model]) -> DataFrame:
    """name, content of the archives of whole frames: each frame, with its segments over it, and its scores."""
    import pandas as pd

    s, post = task.segmentation.model, _post(task.segmentation.model)
    images = stitched(objects, s.stitch.skip_single) if s.stitch else objects
    name = names.template(s.full_frame_archive_fn, images.columns)
    images = images.select(name.alias("archive"), "object_frame_id", "pixels", "height", "width")

    def run(batches):  # noqa: ANN001, ANN202
        net = model()
        from ..functions.drawing import overlay

        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                image, scores = _scores(s, net, r)
                shown = {"img": image, "overlay": overlay(image, post(scores.astype(bool))), "score": np.rint(255 * np.clip(scores, 0, 1)).astype(np.uint8)}
                rows += [(r["archive"], f"{k}/{r['object_frame_id']}.png", files.encode_png(v)) for k, v in shown.items()]
            yield pd.DataFrame(rows, columns=["archive", "file", "image"])

    return files.build_archives(images.mapInPandas(run, "archive string, file string, image binary"), "archive", "image", "file")


def _by_model(task: SegmentTask, objects: DataFrame, model: Callable[[], Model]) -> DataFrame:
    """Regions of the frames, stitched of their objects unless turned off. The model sees tiles as (n, 3, height, width) of 0..1 and gives
    scores (n, height, width), or of several channels, of which the first counts; non-zero ones are foreground."""
    import pandas as pd

    s, post = task.segmentation.model, _post(task.segmentation.model)
    objects = objects.filter(arrays.has_signal(F.col("pixels")))
    if s.stitch:
        objects = stitched(objects, s.stitch.skip_single)
    keep = [f for f in objects.schema if f.name not in ("pixels", "mask", "height", "width", "object_posx", "object_posy", "object_width", "object_height")]
    feature = [c.split()[0] for c in segments.REGION.split(", ")]

    def run(batches):  # noqa: ANN001, ANN202
        net = model()
        from ..functions import kernels

        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                image, scores = _scores(s, net, r)
                labels = post(scores.astype(bool))
                for region in kernels.regions(labels, image):
                    if s.min_intensity is not None and region["max"] < s.min_intensity:
                        continue
                    y, x = max(0, region["min_row"] - s.padding), max(0, region["min_col"] - s.padding)
                    box = np.s_[y : region["max_row"] + s.padding, x : region["max_col"] + s.padding]
                    own = labels[box] == region["label"]
                    cut = np.where(own, image[box], s.background_color) if s.apply_mask or not s.keep_background else image[box]
                    place = (int(r["object_posx"]) + region["min_col"], int(r["object_posy"]) + region["min_row"], region["max_col"] - region["min_col"], region["max_row"] - region["min_row"])
                    rows.append((*[r[f.name] for f in keep], *place, *cut.shape, cut.ravel().astype(int).tolist(), own.ravel().tolist(), float((cut[own] == 0).mean()), *[region[c] for c in feature]))
            yield pd.DataFrame(rows, columns=[*[f.name for f in keep], "object_posx", "object_posy", "object_width", "object_height", "height", "width", "pixels", "mask", "object_frac_invalid", *[f"object_{c}" for c in feature]])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    regions = ", ".join(f"object_{c}" for c in segments.REGION.split(", "))
    out = objects.mapInPandas(run, f"{own}, object_posx long, object_posy long, object_width long, object_height long, height long, width long, pixels array<int>, mask array<boolean>, object_frac_invalid double, {regions}")
    part = lambda i: F.regexp_extract("object_id", names.OBJECT_ID, i)
    # a frame's regions are numbered; unstitched, an object's regions within the object's own number
    number = F.col("object_label").cast("long") if s.stitch else F.col("object_sequence") * 1000 + F.col("object_label")
    out = out.withColumn("object_sequence", number)
    fresh = names.format_object_id(part(1), part(2), part(3), F.col("object_sequence"), F.col("object_posx"), F.col("object_posy"))
    return out.withColumn("object_id", F.when(F.col("object_id").rlike(names.OBJECT_ID), fresh).otherwise(F.concat_ws("_", "object_id", "object_label")))


def postprocess_objects(spark: SparkSession, task: SegmentTask, objects: DataFrame) -> DataFrame:
    p = task.postprocess
    t = duplicates.remove(objects, "sample_id", "object_frame_id", p.detect_duplicates and p.detect_duplicates.model_dump())
    if p.rescale_max_intensity:
        t = t.withColumn("pixels", arrays.rescale_max(F.col("pixels")))
    if p.scalebar:
        t = t.withColumn("pixels", _with_scalebar(p.scalebar.px_per_mm)).withColumn("height", F.col("height") + 3)
    if p.merge_annotations:
        a = names.with_frame_id(files.read_tsv(spark, p.merge_annotations.annotations_fn))
        a = a.withColumns({c: F.col(c).try_cast("double") for c in ("object_posx", "object_posy", "object_width", "object_height")})
        t = joins.merge_annotations(t, a, p.merge_annotations.min_overlap, p.merge_annotations.min_validated_overlap)
    t = metadata.first_rows(t, p.slice, ["object_id"])
    return metadata.where(t, p.filter_expr) if p.filter_expr else t


def _with_scalebar(px_per_mm: float) -> F.Column:
    """Three rows below the image with a bar of 1 mm, cut at the image's width."""
    bar = F.transform(F.sequence(F.lit(0), F.col("width").cast("int") - 1), lambda x: F.when(x < int(round(px_per_mm)), 255).otherwise(0))
    blank = F.transform(bar, lambda x: F.lit(0))
    return F.concat("pixels", blank, bar, blank)


@dataclass
class SegmentPlan:
    samples: DataFrame
    objects: DataFrame
    archives: DataFrame
    inputs: DataFrame | None
    frames: DataFrame | None = None


def segment(spark: SparkSession, task: SegmentTask, now: str, model: Callable[[], Model] | None = None) -> SegmentPlan:
    """All tables of the task; `archives` has the files to write."""
    import pandas as pd

    samples = read_samples(spark, task, now)
    objects = read_objects(spark, task, samples)
    done = postprocess_objects(spark, task, segment_objects(task, objects, model))
    extra = samples.select("root", "meta")
    done = done.join(extra, "root")
    keys = sorted({*metadata.REQUIRED_FIELDS, "acq_instrument", *map(str, task.input.default_meta)})
    done = done.withColumns({k: F.col("meta")[k] for k in keys if k not in done.columns})

    def png(pixels: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([files.encode_png(np.asarray(p).reshape(-1, int(w))) for p, w in zip(pixels, width, strict=True)])

    png.__annotations__ = {"pixels": pd.Series, "width": pd.Series, "return": pd.Series}
    encode = F.pandas_udf(png, "binary")
    file = names.template(task.output.image_fn, done.columns)
    out = done.withColumn("file", file).withColumn("image", encode("pixels", "width"))
    if task.output.store_mask:
        out = out.withColumn("mask_image", encode(F.transform("mask", lambda m: m.cast("int") * 255), "width"))
    out = out.drop("pixels", "mask", "meta", "path", "root", "height", "width")
    archives = files.build_archives(out, "archive", "image", "file", task.output.type_header, "mask_image" if task.output.store_mask else None)
    inputs = files.build_archives(objects.drop("pixels", "path", "root"), "archive") if task.input.save_meta else None
    m = task.segmentation.model
    whole = debug_frames(task, objects.filter(arrays.has_signal(F.col("pixels"))), model or load_model(m.model_fn)) if m and m.full_frame_archive_fn else None
    return SegmentPlan(samples, done, archives, inputs, whole)


# ---------------------------------------------------------------- prediction
@dataclass
class PredictPlan:
    predictions: DataFrame
    measurements: DataFrame | None
    labels: DataFrame | None
    missing: DataFrame | None = None


def channels_of(task: PredictTask, model: Callable[[], Model]) -> list[str] | None:
    """Names of the model's channels: what the factory says of itself in `meta`, under what the task's settings say."""
    both = metadata.merge_settings(getattr(model, "meta", None) or {}, task.model.meta.model_dump(exclude_none=True))
    output = next(iter(ModelMeta.model_validate(both).outputs.values()), None)
    return output.channel_names if output else None


def predict(spark: SparkSession, task: PredictTask, model: Callable[[], Model] | None = None) -> PredictPlan:
    """Scores of the archives' objects, measurements of channel masks, and updated labels; each is a table of its own.

    The model gets (n, 3, height, width) of 0..1: an image's middle of 1024 x 1024, or, with tiling, overlapping tiles, whose scores
    are blended linearly. It gives a vector for each, or channels (n, channel, height, width). Predictions hold the channels last.
    """
    t = files.read_archives(spark, task.input.path, task.input.ignore_patterns)
    t = metadata.first_rows(t, task.input.max_n_objects, ["archive", "object_id"])
    t = t.withColumn("meta", metadata.valid_prefix_keys(F.col("meta")))
    t = files.read_images(t, "image").filter("pixels is not null")
    net = model or load_model(task.model.model_fn)
    p = _predicted(task, t, net)
    channels = channels_of(task, net)
    measured = labels = missing = None
    if task.segmentation:
        if not channels:
            raise ValueError("segmentation needs the names of the model's channels")
        measured = _measure(p, channels, task.segmentation.fill_holes, task.segmentation.draw).withColumn("archive", names.output_name(F.col("archive"), ".segmentation.zip"))
    if task.labels:
        labels, missing = _labels(spark, task, p, channels or [])
    return PredictPlan(p.select("archive", "object_id", "predictions"), measured, labels, missing)


def _predicted(task: PredictTask, t: DataFrame, model: Callable[[], Model]) -> DataFrame:
    """t with predictions, channels last, and the size of the grid they stand for; one without grid has null sizes."""
    import pandas as pd

    m = task.model

    def run(batches):  # noqa: ANN001, ANN202
        net = model()
        for batch in batches:
            images = [np.asarray(p, np.uint8).reshape(int(h), int(w)) for p, h, w in zip(batch["pixels"], batch["height"], batch["width"], strict=True)]
            if m.tiling:
                found = [frames.tiled(net, i, m.dtype, m.tiling.size, m.tiling.stride, True, m.batch_size) for i in images]
            else:
                step = m.batch_size or 16  # an input takes 12 MB
                found = []
                for at in range(0, len(images), step):
                    found += frames.run_model(net, [frames.model_input(frames.centre(i), m.dtype) for i in images[at : at + step]], m.batch_size)
            grids = [f.shape[-2:] if f.ndim > 1 else (None, None) for f in found]
            out = [(np.moveaxis(f, 0, -1) if f.ndim == 3 else f).astype(float).ravel().tolist() for f in found]
            sizes = {"grid_height": [g[0] for g in grids], "grid_width": [g[1] for g in grids]}
            yield batch.assign(predictions=out, **{k: pd.array(v, "Int64") for k, v in sizes.items()})

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.schema)
    return t.mapInPandas(run, f"{kind}, predictions array<double>, grid_height long, grid_width long")


def _measure(p: DataFrame, channels: list[str], fill: bool | list[str], draw: bool = False) -> DataFrame:
    """Sizes differ between objects, so each one is measured on its own grid. draw: also `file` and `image`, the object's picture with its
    segments and their major axes."""
    import pandas as pd

    from ..functions import drawing, kernels

    props = ("area_raw", "area", "major_axis_length", "area_convex", "area_convex_ratio")
    columns = [f"object_{c}_{q}" for c in channels for q in props]

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                row = [r["archive"], r["object_id"]]
                shape = int(r["grid_height"]), int(r["grid_width"])
                masks = np.asarray(r["predictions"]).reshape(*shape, len(channels)) > 0.5
                shown, lines = np.zeros(shape, int), []
                for k, c in enumerate(channels):
                    mask = masks[..., k]
                    shown[mask] = k + 1
                    raw = int(mask.sum())
                    if fill is True or fill and c in fill:
                        mask = kernels.fill_holes(mask)
                    one = kernels.largest(kernels.components(mask))
                    found = kernels.regions(one.astype(int))
                    lines += [(k + 1, drawing.axis(found[0], one))] if draw and found else []
                    a, m, h = (found[0]["area"], found[0]["major_axis"], found[0]["area_convex"]) if found else (0, 0.0, 0)
                    row += [float(raw), float(a), m, float(h), a / h if h else 0.0]
                if draw:
                    image = np.asarray(r["pixels"], np.uint8).reshape(int(r["height"]), int(r["width"]))
                    image = drawing.overlay(image if image.shape == shape else frames.centre(image), shown)
                    for k, (a, b) in lines:
                        image = drawing.line(image, a, b, drawing.colour(k))
                    row += [f"{r['object_id']}.png", files.encode_png(image)]
                rows.append(row)
            yield pd.DataFrame(rows, columns=["archive", "object_id", *columns, *(["file", "image"] if draw else [])])

    kind = "archive string, object_id string, " + ", ".join(f"`{c}` double" for c in columns) + (", file string, image binary" if draw else "")
    return p.select("archive", "object_id", "height", "width", "pixels", "predictions", "grid_height", "grid_width").mapInPandas(run, kind)


def _labels(spark: SparkSession, task: PredictTask, p: DataFrame, channels: list[str]) -> tuple[DataFrame, DataFrame]:
    """The labels, and the descriptions that no category has, with their number of objects: candidates for new ones."""
    import yaml

    s = task.labels
    with open(s.taxonomy_fn) as f:
        tree = yaml.safe_load(f) or {}
    parents: dict[str, str | None] = {}

    def walk(nodes: dict, parent: str | None) -> None:
        for name, node in (nodes or {}).items():
            if node and node.get("predict", True) is False:
                parents[name] = parent
            walk((node or {}).get("children") or {}, name)

    walk(tree, None)
    lineages = files.read_taxonomy(spark, s.lineages_fn)
    lineages = lineages.withColumn("ordinal", F.monotonically_increasing_id())
    lineages = lineages.withColumn("description", F.array_join(F.array_sort(F.array_distinct(F.split("lineage", ">"))), " "))
    forward, backward = taxonomy.translation(lineages)
    objects = p.select("object_id", F.col("meta")["object_annotation_category"].alias("object_annotation_category"), F.col("meta")["object_annotation_status"].alias("object_annotation_status"), "archive", "predictions")
    rules = (taxonomy.parse_rules(s.taxonomy_augmentation_rules), taxonomy.parse_rules(s.prediction_constraint_rules), (s.filter_validated or "").split(), s.compatible_predictions_only)
    every = taxonomy.label_objects(objects, "predictions", channels, forward, backward, s.threshold, s.threshold_relative, parents, *rules, skip_unchanged=False)
    listed = backward.select(F.array_join(F.array_sort(F.split("description", " ")), " ").alias("description"))
    missing = joins.misses(every.select("description"), listed, "description")
    out = taxonomy.label_objects(objects, "predictions", channels, forward, backward, s.threshold, s.threshold_relative, parents, *rules, skip_unchanged=s.skip_unchanged_objects)
    out = out if s.save_raw_descriptions else out.drop("description")
    if not s.strip_metadata:
        known = p.select("archive", "object_id", "meta")
        fields = [r[0] for r in known.select(F.explode(F.map_keys("meta"))).distinct().collect()]  # column names of the tables
        fields = sorted(f for f in fields if f not in out.columns)
        out = out.join(known.select("archive", "object_id", *[F.col("meta")[f].alias(f) for f in fields]), ["archive", "object_id"], "left")
    return out, missing


@contextmanager
def progress(spark: SparkSession, interval: str) -> Iterator[None]:
    """Logs, at each interval ("60s"), how many tasks of the running stages are done, and their smoothed rate."""
    import pandas as pd

    seconds, over, rate = pd.Timedelta(interval).total_seconds(), threading.Event(), metadata.Rate()
    tracker, seen = spark.sparkContext.statusTracker(), {}

    def watch() -> None:
        while not over.wait(seconds):
            stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
            seen.update({s.stageId: s.numCompletedTasks for s in stages})
            now = rate.update(sum(seen.values()), time.monotonic())
            log.info("%d of %d tasks of %d stages, %.3g tasks a second", sum(s.numCompletedTasks for s in stages), sum(s.numTasks for s in stages), len(stages), now or 0)

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def run_segment(spark: SparkSession, task: SegmentTask, now: str) -> None:
    with progress(spark, task.log_interval):
        _run_segment(spark, task, now)


def _run_segment(spark: SparkSession, task: SegmentTask, now: str) -> None:
    plan = segment(spark, task, now)
    files.save_files(plan.archives, task.output.target_dir)
    if plan.frames is not None:
        files.save_files(plan.frames, task.output.target_dir)
    if plan.inputs is not None:
        files.save_files(plan.inputs.withColumn("name", F.concat(F.lit("input_"), "name")), task.output.target_dir)


def run_predict(spark: SparkSession, task: PredictTask) -> None:
    with progress(spark, task.log_interval):
        _run_predict(spark, task)


def _run_predict(spark: SparkSession, task: PredictTask) -> None:
    plan = predict(spark, task)
    if task.save_raw_h5:
        files.save_scores(plan.predictions, f"{task.target_dir}/predictions")
    if plan.measurements is not None:
        drawn = ("image", "file") if "image" in plan.measurements.columns else (None, None)
        files.save_files(files.build_archives(plan.measurements, "archive", *drawn), task.target_dir)
    if plan.missing is not None:
        for r in plan.missing.orderBy(F.desc("n_rows"), "description").limit(100).collect():  # a report
            log.warning("no category for %r (%d objects); consider creating one", r["description"], r["n_rows"])
    if plan.labels is not None:
        files.save_files(files.build_archives(plan.labels.withColumn("archive", names.output_name(F.col("archive"), ".labels.zip")), "archive"), task.target_dir)
