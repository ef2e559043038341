"""Metadata: layers, validation, filters, telemetry, selections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.expressions import compile_expression, ignore_pattern, names

# Fields that every sample needs, and the sensors' names with those of their columns.
REQUIRED_FIELDS = [
    "sample_bottomdepth", "sample_region", "sample_detail_location", "sample_vessel", "sample_latitude", "sample_longitude", "sample_station", "sample_haul", "acq_instrument",
]
SENSORS = {
    "GPS_LON": "object_lon",
    "GPS_LAT": "object_lat",
    "PRESS": "object_pressure",
    "TEMP": "object_temperature",
    "OXY_CON": "object_oxygen_concentration",
    "OXY_SAT": "object_oxygen_saturation",
    "OXY_TEMP": "object_temperature_oxsens",
    "COND_COND": "object_conductivity",
    "COND_SALY": "object_salinity",
}
#: Leads of the columns that an archive may hold.
PREFIXES = ("object", "sample", "process", "acq", "img")
#: Columns that are left of an object whose metadata is stripped.
STRIPPED = ["object_id", "object_annotation_category", "object_annotation_status", "sample_id"]


class MissingMetaError(ValueError):
    """Samples lack required fields."""


def overlay(table: DataFrame, layers: list[dict[str, Column]]) -> DataFrame:
    """Layers of columns, the later replacing the earlier by name, nulls included."""
    merged: dict[str, Column] = {}
    for layer in layers:
        merged |= layer
    return table.withColumns(merged)


def _not_in(keys: Column) -> Callable[[Column, Column], Column]:
    return lambda k, _: ~F.map_contains_key(keys, k)


def overlay_maps(*maps: Column) -> Column:
    """The same for map columns: a key's last value counts, nulls included."""
    out = maps[0]
    for m in maps[1:]:
        out = F.map_concat(F.map_filter(out, _not_in(m)), m)
    return out


def merge_settings(base: dict, update: dict, keep_left: bool = True) -> dict:
    """update over base, level by level; keep_left False drops keys that only base has."""
    out = dict(base) if keep_left else {}
    for k, v in update.items():
        out[k] = merge_settings(base[k], v, keep_left) if isinstance(v, dict) and isinstance(base.get(k), dict) else v
    return out


def rename_present(table: DataFrame, mapping: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """The mapped columns that are there, renamed, after those in keep."""
    return table.select(*(keep or []), *[F.col(a).alias(b) for a, b in mapping.items() if a in table.columns])


def valid_prefixes(table: DataFrame, prefixes: tuple[str, ...] = PREFIXES) -> DataFrame:
    return table.select(*[c for c in table.columns if c.split("_")[0] in prefixes])


def valid_prefix_keys(column: Column, prefixes: tuple[str, ...] = PREFIXES) -> Column:
    return F.map_filter(column, lambda k, _: F.split(k, "_")[0].isin(*prefixes))


def strip(table: DataFrame, everything: bool = True) -> DataFrame:
    """The four naming columns alone; or all but annotation columns other than category and status."""
    if everything:
        return table.select(*[c for c in STRIPPED if c in table.columns])
    keep = ("object_annotation_category", "object_annotation_status")
    return table.drop(*[c for c in table.columns if c.startswith("object_annotation_") and c not in keep])


def missing_fields(table: DataFrame, present: str = "present_keys", required: list[str] = REQUIRED_FIELDS) -> DataFrame:
    """Rows that lack required fields, with those sorted."""
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.col(present)))
    return table.withColumn("missing", missing).filter(F.size("missing") > 0)


def require_fields(table: DataFrame, key: str, present: str = "present_keys", required: list[str] = REQUIRED_FIELDS, shown: int = 100) -> DataFrame:
    """table, after one check of all its samples; the error names the first `shown` of those that lack fields, and their number."""
    bad = missing_fields(table, present, required)
    rows = bad.orderBy(key).limit(shown).collect()
    if rows:
        raise MissingMetaError(f"{bad.count()} samples lack fields: " + "; ".join(f"{r[key]}: {', '.join(r['missing'])}" for r in rows))
    return table


# ---------------------------------------------------------------- filters
def where(table: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is true; an unknown name fails at once."""
    if unknown := names(expression) - {*table.columns, "meta"}:
        raise KeyError(f"{expression!r} reads {', '.join(sorted(unknown))}")
    return table.filter(compile_expression(expression))


def first_rows(table: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    """The first n rows in the given order; a following filter sees only those."""
    return table if n is None else table.orderBy(*order).limit(n)


def not_ignored(table: DataFrame, path: str, patterns: list[str]) -> DataFrame:
    for p in patterns:
        table = table.filter(~F.col(path).rlike(ignore_pattern(p)))
    return table


def observed(table: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """table with a row counter that costs no extra job."""
    watch = Observation(name)
    return table.observe(watch, F.count(F.lit(1)).alias("rows")), watch


class Rate:
    """Items a second, exponentially smoothed, from counts and times."""

    def __init__(self, smoothing: float = 0.5):
        self.smoothing, self.rate, self.last = smoothing, None, None

    def update(self, count: int, seconds: float) -> float | None:
        if self.last is not None and seconds > self.last[1]:
            now = (count - self.last[0]) / (seconds - self.last[1])
            self.rate = now if self.rate is None else self.smoothing * now + (1 - self.smoothing) * self.rate
        self.last = (count, seconds)
        return self.rate

    def left(self, remaining: int) -> float | None:
        return remaining / self.rate if self.rate else None


def pipe(table: DataFrame, *steps: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The steps in order; None is a step that is turned off."""
    for step in steps:
        if step:
            table = step(table)
    return table


# ---------------------------------------------------------------- telemetry and order
def union_primary(primary: DataFrame, secondary: DataFrame, keys: list[str], stem: str | None = None) -> DataFrame:
    """All primary rows, and the secondary ones of which neither the key (nor, if given, the file stem) is primary."""
    rest = secondary.join(primary.select(*keys), keys, "left_anti")
    if stem:
        rest = rest.join(primary.select(stem).distinct(), stem, "left_anti")
    return primary.unionByName(rest, allowMissingColumns=True)


def last_by_path(readings: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Of several readings of one key, that of the last path."""
    return readings.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in readings.columns if c not in keys]), path).alias("_r")).select(*keys, "_r.*")


def run_groups(table: DataFrame, by: list[str], key: str, order: list[str]) -> DataFrame:
    """table with `run`: consecutive rows of one key form a run; a key that comes back later starts another."""
    w = Window.partitionBy(*by).orderBy(*order)
    change = F.when(F.col(key).eqNullSafe(F.lag(key).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return table.withColumn("_c", change).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def sampling_interval(table: DataFrame, by: list[str], on: str) -> DataFrame:
    """The median of successive time differences, in microseconds."""
    us = F.unix_micros(F.col(on).cast("timestamp"))
    step = us - F.lag(us).over(Window.partitionBy(*by).orderBy(us))
    return table.withColumn("_d", step).filter("_d is not null").groupBy(*by).agg(F.median("_d").alias("median_us"))


def stitch_groups(objects: DataFrame, frame: str, item: list[str], skip_single: bool = False) -> DataFrame:
    """Each frame with its objects in order."""
    out = objects.groupBy(frame).agg(F.array_sort(F.collect_list(F.struct(*item))).alias("objects"))
    return out.filter(F.size("objects") > 1) if skip_single else out
