"""Joins: nearest in time, best box overlap, semi and anti joins, lookups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry


def asof_nearest(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], tolerance: str | None = None) -> DataFrame:
    """Left join to the row of `right` nearest in time within `by`; of two equally near the later one.

    tolerance: a pandas interval such as "6h", inclusive; none: unlimited. The `values` of right replace equal-named
    columns of left where a match exists, else they are as in left (null if new). Null times match nothing. Of
    several right rows of one time, the one with the largest values counts. One shuffle; with a tolerance, windows
    are a bucket of time wide, so no key collects in one task.
    """
    limit = None if tolerance is None else int(pd.Timedelta(tolerance).value // 1000)
    us = F.unix_micros(F.col(on).cast("timestamp"))
    keys = [*by]
    payload = F.struct(F.col("_us"), *[F.col(v) for v in values])
    r = right.select(*by, us.alias("_us"), *values).filter("_us is not null").groupBy(*by, "_us").agg(F.max(F.struct(*values)).alias("_v"))
    r = r.select(*by, F.col("_us"), *[F.col(f"_v.{v}").alias(v) for v in values]).select(*by, "_us", payload.alias("_tel"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    l = left.select(*by, us.alias("_us"), F.lit(None).cast(r.schema["_tel"].dataType).alias("_tel"), F.struct("*").alias("_row"))  # noqa: E741
    if limit is not None:
        width = max(limit, 1)
        l = l.withColumn("_bucket", F.floor(F.col("_us") / width))  # noqa: E741
        r = r.withColumn("_bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("_us") / width) + d)))
        keys.append("_bucket")
    both = l.unionByName(r)
    w = Window.partitionBy(*keys).orderBy("_us")
    # RANGE frames, so that equal times see each other from both sides
    back = F.last("_tel", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.first("_tel", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    both = both.withColumn("_b", back).withColumn("_f", ahead).filter("_row is not null")
    after, before = F.col("_f._us") - F.col("_us"), F.col("_us") - F.col("_b._us")
    near = F.when(F.col("_us").isNull(), F.lit(None)).when(F.col("_b").isNull() | (after <= before), F.col("_f")).otherwise(F.col("_b"))
    both = both.withColumn("_m", near)
    if limit is not None:
        both = both.withColumn("_m", F.when(F.abs(F.col("_m._us") - F.col("_us")) <= limit, F.col("_m")))
    own = [F.when(F.col("_m").isNotNull(), F.col(f"_m.{c}")).otherwise(F.col(f"_row.{c}")).alias(c) if c in values else F.col(f"_row.{c}").alias(c) for c in left.columns]
    return both.select(*own, *[F.col(f"_m.{v}").alias(v) for v in values if v not in left.columns])


def in_frames(table: DataFrame, frames: DataFrame, key: str = "object_frame_id") -> DataFrame:
    """Rows whose frame is listed. Spark broadcasts the list if it is small enough."""
    return table.join(frames.select(key).distinct(), key, "left_semi")


def skip_existing(table: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return table.join(existing.select(key).distinct(), key, "left_anti")


def lookup(table: DataFrame, mapping: DataFrame, key: str, value: str, strict: bool = True) -> DataFrame:
    """table with `value` for its `key`; an unlisted key fails the query if strict, or gives null."""
    unique = mapping.groupBy(key).agg(F.min(value).alias(value), F.count_distinct(value).alias("_n"))
    out = table.join(unique, key, "left")
    if strict:
        missing = F.raise_error(F.concat(F.lit(f"unknown or ambiguous {key}: "), F.col(key).cast("string"))).cast("string")
        out = out.withColumn(value, F.when((F.col("_n") == 1) | F.col(key).isNull(), F.col(value)).otherwise(missing))
    return out.drop("_n")


def lookup_or_keep(table: DataFrame, mapping: DataFrame, key: str, value: str, old: str) -> DataFrame:
    """table with `old` replaced by the mapping's `value` where `key` is listed."""
    return table.join(mapping.select(key, F.col(value).alias("_new")), key, "left").withColumn(old, F.coalesce("_new", old)).drop("_new")


def misses(table: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Unlisted keys with their number of rows: candidates for new categories."""
    return table.join(mapping.select(key), key, "left_anti").groupBy(key).agg(F.count("*").alias("n_rows"))


# ---------------------------------------------------------------- annotations
#: Columns that an annotation table must have.
REQUIRED = ["object_id", "object_frame_id", "object_posx", "object_posy", "object_width", "object_height", "object_annotation_status"]
#: Statuses that a person gave.
REVIEWED = ("validated", "dubious")


def merge_annotations(objects: DataFrame, annotations: DataFrame, min_overlap: float = 0.5, min_validated_overlap: float = 0.8, id_column: str = "object_id") -> DataFrame:
    """Each object with the annotation of its frame that overlaps it most.

    object_annotation_merge_overlap is set where the frame has annotations. Over (not at) min_overlap, all
    object_annotation columns and object_annotation_merge_src are copied, and a reviewed status becomes `predicted`
    below min_validated_overlap; otherwise they are "". Without annotations in the frame they are null. An annotation
    may serve several objects; equal overlaps go to the smaller annotation id.
    """
    if missing := [c for c in REQUIRED if c not in annotations.columns]:
        raise ValueError(f"annotations lack {', '.join(missing)}")
    copied = [c for c in annotations.columns if c.startswith("object_annotation")]
    a = annotations.filter("object_frame_id is not null").select(F.col("object_frame_id"), F.col("object_id").alias("_src"), geometry.box().alias("_a"), F.struct(*copied).alias("_copy"))
    keep = [c for c in objects.columns if c not in copied]
    pairs = objects.select(*keep, geometry.box().alias("_o")).join(a, "object_frame_id", "left")
    pairs = pairs.withColumn("_iou", geometry.overlap("_a", "_o")["overlap_xy"])
    # an object is in one frame, so this window keeps the join's partitioning
    w = Window.partitionBy("object_frame_id", id_column).orderBy(F.col("_iou").desc_nulls_last(), F.col("_src"))
    top = pairs.withColumn("_k", F.row_number().over(w)).filter("_k = 1")
    has, hit = F.col("_src").isNotNull(), F.col("_iou") > min_overlap
    outdated = (F.col("_iou") < min_validated_overlap) & F.col("_copy.object_annotation_status").isin(*REVIEWED)

    def value(c: str) -> Column:
        v = F.col(f"_copy.{c}").cast("string")
        if c == "object_annotation_status":
            v = F.when(outdated, F.lit("predicted")).otherwise(v)
        return F.when(has & hit, v).when(has, F.lit("")).alias(c)

    return top.select(
        *keep,
        *[value(c) for c in copied],
        F.when(has, F.coalesce("_iou", F.lit(0.0))).alias("object_annotation_merge_overlap"),
        F.when(has & hit, F.col("_src").cast("string")).when(has, F.lit("")).alias("object_annotation_merge_src"),
    )
