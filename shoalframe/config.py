"""Task settings: models, short forms, and an example file made from them."""

from __future__ import annotations

from pathlib import Path
from typing import Any, ClassVar, Literal

import yaml
from pydantic import BaseModel, ConfigDict, Field, model_validator


class Section(BaseModel):
    """Unknown keys are errors. `true` stands for the defaults, and a bare value for the `short` field where there is one."""

    model_config = ConfigDict(extra="forbid", validate_default=True)
    short: ClassVar[str | None] = None

    @model_validator(mode="before")
    @classmethod
    def _short(cls, value: Any) -> Any:
        if value is True:
            return {}
        if not isinstance(value, (dict, BaseModel)) and cls.short:
            return {cls.short: value}
        return value


Off = Literal[False] | None


class DetectDuplicates(Section):
    min_similarity: float = 0.98
    max_age: int = 1


class MergeTelemetry(Section):
    tolerance: str | None = None


class SegmentInput(Section):
    path: str
    discover: bool = True
    ignore_patterns: list[str] = []
    filter_expr: str | None = None
    slice: int | None = Field(None, json_schema_extra={"debug": True})
    default_meta: dict[str, Any] = {}
    valid_frames_fn: str | None = None
    merge_telemetry: MergeTelemetry | Off = MergeTelemetry()
    save_meta: bool = Field(False, json_schema_extra={"debug": True})
    detect_duplicates: DetectDuplicates | Off = False


class Threshold(Section):
    short: ClassVar[str] = "threshold_brighter"
    threshold_brighter: float


class Stitch(Section):
    skip_single: bool = False


class SegmentPostprocess(Section):
    closing_radius: int = 0
    opening_radius: int = 0
    merge_segments_distance: int = 0
    min_area: int = 0
    n_threads: int = 0
    clear_border: bool = False
    isotropic: bool = False


def _plain(model: Any) -> Any:
    """Models are Python functions that choose their device and precision themselves, and tasks run in parallel anyway."""
    if model.device != "cpu":
        raise ValueError("device: the model's factory chooses its device")
    if model.autocast:
        raise ValueError("autocast: the model's factory chooses its precision")
    if model.n_threads > 1:
        raise ValueError("n_threads: Spark runs a model in every task; set spark.task.cpus for more threads of each")
    return model


class ModelSegmentation(Section):
    short: ClassVar[str] = "model_fn"
    stitch: Stitch | Off = Stitch()
    model_fn: str
    device: str = "cpu"
    n_threads: int = 0
    batch_size: int = 0
    autocast: bool = False
    dtype: str = "float32"
    postprocess: SegmentPostprocess | Off = False
    full_frame_archive_fn: str | None = Field(None, json_schema_extra={"debug": True})
    padding: int = 75
    min_intensity: float | None = None
    apply_mask: bool = False
    background_color: int = 0
    keep_background: bool = True

    @model_validator(mode="after")
    def _kept(self) -> ModelSegmentation:
        return _plain(self)


class Segmentation(Section):
    threshold: Threshold | None = None
    model: ModelSegmentation | None = None
    filter_expr: str | None = None

    @model_validator(mode="after")
    def _one(self) -> Segmentation:
        if (self.threshold is None) == (self.model is None):
            raise ValueError("exactly one of threshold and model is needed")
        return self


class Scalebar(Section):
    px_per_mm: float


class MergeAnnotations(Section):
    short: ClassVar[str] = "annotations_fn"
    annotations_fn: str
    min_overlap: float = 0.5
    min_validated_overlap: float = 0.8


class Postprocess(Section):
    scalebar: Scalebar | Off = None
    slice: int | None = Field(None, json_schema_extra={"debug": True})
    filter_expr: str | None = None
    detect_duplicates: DetectDuplicates | Off = False
    merge_annotations: MergeAnnotations | Off = None
    rescale_max_intensity: bool = False


class Output(Section):
    target_dir: str
    skip_existing: bool = False
    image_fn: str = "{object_id}.png"
    store_mask: bool = False
    type_header: bool = True

    @model_validator(mode="after")
    def _png(self) -> Output:
        if not self.image_fn.endswith(".png"):
            raise ValueError("image_fn: images are written as PNG")
        return self


class SegmentTask(Section):
    input: SegmentInput
    segmentation: Segmentation
    postprocess: Postprocess = Postprocess()
    output: Output
    log_interval: str = "60s"


class PredictInput(Section):
    path: str
    ignore_patterns: list[str] = []
    max_n_objects: int | None = Field(None, json_schema_extra={"debug": True})


class ModelOutput(Section):
    channel_names: list[str] | None = None


class ModelMeta(Section):
    outputs: dict[str, ModelOutput] = {}

    @model_validator(mode="after")
    def _one(self) -> ModelMeta:
        if len(self.outputs) > 1:
            raise ValueError("a model has exactly one output")
        return self


class Tiling(Section):
    size: int = 1024
    stride: int = 896


class Model(Section):
    model_fn: str
    device: str = "cpu"
    n_threads: int = 0
    batch_size: int = 0
    autocast: bool = False
    dtype: str = "float32"
    meta: ModelMeta = ModelMeta()
    tiling: Tiling | Off = False

    @model_validator(mode="after")
    def _kept(self) -> Model:
        return _plain(self)


class PredictSegmentation(Section):
    draw: bool = False
    fill_holes: bool | list[str] = False


class Labels(Section):
    taxonomy_fn: str
    lineages_fn: str
    compatible_predictions_only: bool = True
    skip_unchanged_objects: bool = True
    filter_validated: str | None = None
    save_raw_descriptions: bool = False
    strip_metadata: bool = True
    threshold: float = 0.9
    threshold_relative: float = 0.0
    taxonomy_augmentation_rules: dict[str, str] = {}
    prediction_constraint_rules: dict[str, str] = {}


class PredictTask(Section):
    input: PredictInput
    model: Model
    save_raw_h5: bool = False
    segmentation: PredictSegmentation | Off = False
    labels: Labels | Off = False
    target_dir: str
    log_interval: str = "60s"


def one_of(settings: dict[str, Any], *keys: str) -> str:
    """The one key of `keys` that is set; none or several: ValueError."""
    found = [k for k in keys if settings.get(k) not in (None, False)]
    if len(found) != 1:
        raise ValueError(f"exactly one of {', '.join(keys)} is needed, not {len(found)}")
    return found[0]


TASKS: dict[str, type[Section]] = {"segment": SegmentTask, "predict": PredictTask}


def load(path: str, kind: str) -> Section:
    """The validated task of a YAML file; an invalid one raises. Relative paths in it refer to its own folder."""
    file = Path(path).resolve()
    return TASKS[kind].model_validate(yaml.safe_load(file.read_text()) or {}, context={"folder": str(file.parent)})


def _example(model: type[BaseModel]) -> dict:
    out: dict[str, Any] = {}
    for name, field in model.model_fields.items():
        if (field.json_schema_extra or {}).get("debug"):
            continue
        inner = next((t for t in [field.annotation, *getattr(field.annotation, "__args__", ())] if isinstance(t, type) and issubclass(t, BaseModel)), None)
        if inner:
            out[name] = _example(inner)
        else:
            out[name] = f"<{name}>" if field.is_required() else field.default
    return out


def example(kind: str) -> str:
    """A YAML file with every setting but those for debugging, at its default; required ones in angle brackets."""
    if kind not in TASKS:
        raise ValueError(f"unknown task {kind!r}; there are {', '.join(TASKS)}")
    return yaml.safe_dump(_example(TASKS[kind]), sort_keys=False, allow_unicode=True)
