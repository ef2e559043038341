"""The library's queries over the plain tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import ctes, table, view
from .functions import arrays, geometry, kernels, names
from .operators import duplicates, joins, metadata, segments, taxonomy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_BOX = "greatest(0, least(a.object_posx + a.object_width, o.object_posx + o.object_width) - greatest(a.object_posx, o.object_posx))"
_BOY = "greatest(0, least(a.object_posy + a.object_height, o.object_posy + o.object_height) - greatest(a.object_posy, o.object_posy))"
_IOU = f"CAST({_BOX} * {_BOY} AS DOUBLE) / NULLIF(a.object_width * a.object_height + o.object_width * o.object_height - {_BOX} * {_BOY}, 0)"


# ---------------------------------------------------------------- joins
@query(
    ctes("objects", "annotations")
    + f""", p AS (SELECT o.object_id, a.object_id AS src, a.object_annotation_category AS cat, a.object_annotation_status AS st, {_IOU} AS iou
  FROM objects o LEFT JOIN annotations a ON a.object_frame_id = o.object_frame_id),
t AS (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY iou DESC NULLS LAST, src) AS k FROM p)
SELECT object_id, CASE WHEN src IS NULL THEN NULL WHEN iou > 0.5 THEN cat ELSE '' END AS object_annotation_category,
  CASE WHEN src IS NULL THEN NULL WHEN iou > 0.5 THEN CASE WHEN iou < 0.8 AND st IN ('validated', 'dubious') THEN 'predicted' ELSE st END ELSE '' END AS object_annotation_status,
  CASE WHEN src IS NOT NULL THEN coalesce(iou, 0) END AS object_annotation_merge_overlap,
  CASE WHEN src IS NULL THEN NULL WHEN iou > 0.5 THEN src ELSE '' END AS object_annotation_merge_src
FROM t WHERE k = 1"""
)
def annotation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = joins.merge_annotations(view(spark, sf_dir, "objects"), view(spark, sf_dir, "annotations"))
    return merged.select("object_id", *[c for c in merged.columns if c.startswith("object_annotation")])


def _asof(limit: str, left: str = "object_times") -> str:
    return f"""p AS (SELECT o.object_id, o.sample_id, o.ts, t.object_temperature AS v,
  row_number() OVER (PARTITION BY o.object_id ORDER BY abs(epoch_us(t.ts) - epoch_us(o.ts)), t.ts DESC) AS k
  FROM {left} o LEFT JOIN telemetry_primary t ON t.sample_id = o.sample_id {limit})
SELECT object_id, sample_id, ts, v AS object_temperature FROM p WHERE k = 1"""


@query(ctes("object_times", "telemetry_primary") + ", " + _asof(""))
def asof_nearest_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.asof_nearest(view(spark, sf_dir, "object_times"), view(spark, sf_dir, "telemetry_primary"), ["sample_id"], "ts", ["object_temperature"])


@query(ctes("object_times", "telemetry_primary") + ", " + _asof("AND abs(epoch_us(t.ts) - epoch_us(o.ts)) <= 21600000000"))
def asof_nearest_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.asof_nearest(view(spark, sf_dir, "object_times"), view(spark, sf_dir, "telemetry_primary"), ["sample_id"], "ts", ["object_temperature"], "6h")


@query(
    "WITH object_times AS (SELECT event_id AS object_id, event_id % 7 AS sample_id, to_timestamp(event_id * 60)::TIMESTAMP AS ts FROM events), "
    "telemetry_primary AS (SELECT event_id % 7 AS sample_id, to_timestamp(event_id * 60 + 30)::TIMESTAMP AS ts, max(value) AS object_temperature FROM events WHERE event_id % 3 = 0 GROUP BY 1, 2 "
    "UNION ALL SELECT event_id % 7, to_timestamp(event_id * 60 - 30)::TIMESTAMP, max(value) FROM events WHERE event_id % 3 <> 2 GROUP BY 1, 2), "
    + _asof("AND abs(epoch_us(t.ts) - epoch_us(o.ts)) <= 300000000")
)
def asof_tie_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 7).alias("sample_id"), "value")
    at = lambda s: F.timestamp_seconds(F.col("event_id") * 60 + s).cast("timestamp_ntz").alias("ts")
    left = e.select(F.col("event_id").alias("object_id"), "sample_id", at(0))
    right = e.filter("event_id % 3 = 0").select("sample_id", at(30), F.col("value").alias("object_temperature"))
    right = right.union(e.filter("event_id % 3 <> 2").select("sample_id", at(-30), "value"))
    return joins.asof_nearest(left, right, ["sample_id"], "ts", ["object_temperature"], "5m")


@query(ctes("objects", "valid_frames") + " SELECT object_id, object_frame_id FROM objects WHERE object_frame_id IN (SELECT object_frame_id FROM valid_frames)")
def frame_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.in_frames(view(spark, sf_dir, "objects"), view(spark, sf_dir, "valid_frames")).select("object_id", "object_frame_id")


@query("SELECT c_custkey AS sample_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def skip_existing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("sample_id"))
    return joins.skip_existing(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id")), done, "sample_id")


@query(
    "SELECT o_orderkey, o_orderpriority, CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN 'p{p[0]}'" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + " END AS description FROM orders"
)
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    mapping = o.select("o_orderpriority").distinct().withColumn("description", F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)))
    return joins.lookup(o, mapping, "o_orderpriority", "description")


@query(
    "WITH b AS (SELECT n_name AS description, 'r' || n_regionkey || '/' || n_name AS display_name FROM nation WHERE n_nationkey % 3 <> 0) "
    "SELECT c_custkey, coalesce(display_name, c_mktsegment) AS category FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN b ON b.description = n_name"
)
def label_lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    backward = n.filter("n_nationkey % 3 <> 0").select(F.col("n_name").alias("description"), F.concat(F.lit("r"), "n_regionkey", F.lit("/"), "n_name").alias("display_name"))
    c = table(spark, sf_dir, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("c_mktsegment").alias("category"), F.col("n_name").alias("description"))
    return joins.lookup_or_keep(c, backward, "description", "display_name", "category").select("c_custkey", "category")


@query("SELECT n_name AS description, count(*) AS n_rows FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 3 = 0 GROUP BY 1")
def create_category_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("description"))
    return joins.misses(c, n.filter("n_nationkey % 3 <> 0").select(F.col("n_name").alias("description")), "description")


@query(
    ctes("objects", "annotations")
    + f""" SELECT o.object_id, a.object_id AS annotation_id,
  CAST({_BOX} AS DOUBLE) / greatest(1, greatest(a.object_posx + a.object_width, o.object_posx + o.object_width) - least(a.object_posx, o.object_posx)) AS overlap_x,
  CAST({_BOY} AS DOUBLE) / greatest(1, greatest(a.object_posy + a.object_height, o.object_posy + o.object_height) - least(a.object_posy, o.object_posy)) AS overlap_y,
  {_IOU} AS overlap_xy FROM objects o JOIN annotations a ON a.object_frame_id = o.object_frame_id"""
)
def bbox_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "objects").select("object_frame_id", "object_id", geometry.box().alias("o"))
    a = view(spark, sf_dir, "annotations").select("object_frame_id", F.col("object_id").alias("annotation_id"), geometry.box().alias("a"))
    return o.join(a, "object_frame_id").select("object_id", "annotation_id", *[c.alias(n) for n, c in geometry.overlap("a", "o").items()])


# ---------------------------------------------------------------- metadata
@query(
    ctes("telemetry_primary", "telemetry_secondary")
    + " SELECT sample_id, ts, object_temperature, NULL::DOUBLE AS object_salinity FROM telemetry_primary UNION ALL SELECT sample_id, ts, NULL, object_salinity FROM telemetry_secondary s "
    "WHERE NOT EXISTS (SELECT 1 FROM telemetry_primary p WHERE p.sample_id = s.sample_id AND p.ts = s.ts)"
)
def telemetry_union_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.union_primary(view(spark, sf_dir, "telemetry_primary"), view(spark, sf_dir, "telemetry_secondary"), ["sample_id", "ts"])


@query(
    "SELECT c_custkey AS sample_id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE n_name END AS sample_region, coalesce(NULLIF(c_mktsegment, 'BUILDING'), 'LOKI') AS acq_instrument, c_acctbal AS sample_latitude "
    "FROM customer JOIN nation ON n_nationkey = c_nationkey"
)
def meta_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer's null replaces a value that is there."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    layers = [
        {"sample_region": F.col("c_mktsegment"), "acq_instrument": F.lit(names.INSTRUMENT)},
        {"sample_latitude": F.col("c_acctbal"), "acq_instrument": F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit(names.INSTRUMENT))},
        {"sample_region": F.when(F.col("c_custkey") % 4 != 0, F.col("n_name"))},
    ]
    return metadata.overlay(c.withColumn("sample_id", F.col("c_custkey")), layers).select("sample_id", "sample_region", "acq_instrument", "sample_latitude")


@query(
    ctes("sample_meta")
    + " SELECT sample_id, missing FROM (SELECT sample_id, list_sort(list_filter(["
    + ", ".join(f"'{f}'" for f in metadata.REQUIRED_FIELDS)
    + "], lambda k: NOT list_contains(present_keys, k))) AS missing FROM sample_meta) WHERE len(missing) > 0"
)
def required_fields_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.missing_fields(view(spark, sf_dir, "sample_meta")).select("sample_id", "missing")


@query("SELECT event_id, event_type, value FROM events WHERE (value > 50 AND event_type IN ('view', 'click')) OR (NOT value >= 10 AND event_id % 3 = 1)")
def expr_filter_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "value > 50 and event_type in ('view', 'click') or not value >= 10 and event_id % 3 == 1"
    return metadata.where(table(spark, sf_dir, "events"), text).select("event_id", "event_type", "value")


@query("SELECT event_id, value FROM (SELECT * FROM events ORDER BY event_id LIMIT 300) WHERE value > 20")
def slice_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.where(metadata.first_rows(table(spark, sf_dir, "events"), 300, ["event_id"]), "value > 20").select("event_id", "value")


@query("SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^.*/en/.*$') AND NOT regexp_matches(url, '^http://.*[0-4]$')")
def ignore_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.not_ignored(table(spark, sf_dir, "pages").select("page_id", "url"), "url", ["*/en/*", "http://*[0-4]"])


@query(
    "SELECT path, row_number() OVER (ORDER BY lower(p_type), p_size, p_partkey) - 1 AS ordinal FROM (SELECT *, p_type || '/' || p_size || '/x' || p_partkey AS path FROM part)"
)
def natural_order_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.files import natural_order

    paths = table(spark, sf_dir, "part").select(F.concat("p_type", F.lit("/"), "p_size", F.lit("/x"), "p_partkey").alias("path"))
    return natural_order(paths, "path").withColumn("ordinal", F.col("ordinal").cast("long"))


@query(
    "WITH e AS (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) "
    "SELECT e.event_id, e.user_id, CAST(sum(CASE WHEN p IS DISTINCT FROM e.event_type THEN 1 ELSE 0 END) OVER (PARTITION BY e.user_id ORDER BY x.ts, e.event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run "
    "FROM e JOIN events x ON x.event_id = e.event_id"
)
def run_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.run_groups(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"]).select("event_id", "user_id", "run")


@query(
    ctes("telemetry_primary")
    + ", d AS (SELECT sample_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY sample_id ORDER BY ts) AS d FROM telemetry_primary) SELECT sample_id, CAST(median(d) AS DOUBLE) AS median_us FROM d WHERE d IS NOT NULL GROUP BY sample_id"
)
def sampling_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.sampling_interval(view(spark, sf_dir, "telemetry_primary"), ["sample_id"], "ts")


@query(
    ctes("objects")
    + " SELECT object_frame_id, count(*) AS n, string_agg(object_id, ',' ORDER BY object_posx, object_posy, object_id) AS ids FROM objects GROUP BY 1 HAVING count(*) > 1"
)
def stitch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = metadata.stitch_groups(view(spark, sf_dir, "objects"), "object_frame_id", ["object_posx", "object_posy", "object_id"], skip_single=True)
    return g.select("object_frame_id", F.size("objects").cast("long").alias("n"), F.array_join(F.transform("objects", lambda o: o["object_id"]), ",").alias("ids"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS object_id, p_size AS object_width, p_name AS sample_id FROM part")
def prefix_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("object_id"), F.col("p_size").alias("object_width"), F.col("p_name").alias("sample_id"), F.col("p_type").alias("other_type"), "p_brand")
    return metadata.valid_prefixes(p)


@query(ctes("objects", "annotations") + " SELECT object_id, object_annotation_category, object_annotation_status FROM annotations")
def strip_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.strip(view(spark, sf_dir, "annotations"))


# ---------------------------------------------------------------- names
_ID = "strftime(o_orderdate, '%Y%m%d') || ' ' || strftime(o_orderdate, '%H%M%S') || '  ' || printf('%03d', l_orderkey % 1000) || '  ' || printf('%06d %04d %04d', l_orderkey, (l_partkey * 7) % 40, (l_suppkey * 11) % 40)"


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = table(spark, sf_dir, "lineitem").join(o, F.col("o_orderkey") == F.col("l_orderkey"))
    made = names.format_object_id(
        F.date_format("o_orderdate", "yyyyMMdd"), F.date_format("o_orderdate", "HHmmss"), F.format_string("%03d", F.col("l_orderkey") % 1000), F.col("l_orderkey"), (F.col("l_partkey") * 7) % 40, (F.col("l_suppkey") * 11) % 40
    )
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", made.alias("object_id"))


@query(
    f"SELECT {_ID} AS object_id, l_orderkey AS seq, (l_partkey * 7) % 40 AS posx, (l_suppkey * 11) % 40 AS posy, strftime(o_orderdate, '%Y%m%d') AS date, true AS same FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
)
def object_id_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _ids(spark, sf_dir).withColumn("p", names.parse_object_id(F.col("object_id")))
    again = names.format_object_id(*[F.col(f"p.{c}") for c in ("date", "time", "ms", "seq", "posx", "posy")])
    return p.select("object_id", "p.seq", "p.posx", "p.posy", "p.date", (again == F.col("object_id")).alias("same"))


@query(
    "SELECT strftime(o_orderdate, '%Y%m%d') || ' ' || strftime(o_orderdate, '%H%M%S') || '  ' || printf('%03d', l_orderkey % 1000) AS object_frame_id, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"
)
def frame_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.with_frame_id(_ids(spark, sf_dir)).groupBy("object_frame_id").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS ts FROM events")
def filename_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_id") % 5 == 0, F.lit("no time.tmd")).otherwise(F.concat(F.lit("a/b x"), F.date_format("ts", "yyyyMMdd HHmmss"), F.lit(".tmd")))
    return table(spark, sf_dir, "events").select("event_id", names.file_time(name).alias("ts"))


@query("SELECT p_partkey, p_brand || '/' || printf('%05d', p_partkey) || '_' || p_size || '.jpg' AS img_file_name FROM part")
def image_fn_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", names.template("{p_brand}/{p_partkey:05d}_{p_size}.jpg", p.columns).alias("img_file_name"))


@query(
    "SELECT c_custkey, c_mktsegment || '_' || c_nationkey AS sample_id, 'LOKI_' || c_mktsegment || '_' || c_nationkey AS acq_id, 'LOKI_' || c_mktsegment || '_' || c_nationkey || '_2024-01-01T00:00:00' AS process_id, "
    "'LOKI_' || c_mktsegment || '_' || c_nationkey || '.zip' AS archive FROM customer"
)
def archive_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    station, haul = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    made = names.generated_ids(station, haul, F.lit(None).cast("string"), F.lit("2024-01-01T00:00:00"))
    return table(spark, sf_dir, "customer").select("c_custkey", *[c.alias(n) for n, c in made.items()], names.archive_name(station, haul).alias("archive"))


@query("SELECT page_id, regexp_replace(split_part(url, '/', -1), '\\.[^.]*$', '') || '.labels.zip' AS output, regexp_replace(url, '(\\.[^./]*)?$', '_mask\\1') AS mask FROM pages")
def output_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.output_name(F.col("url"), ".labels.zip").alias("output"), names.file_suffix(F.col("url"), "_mask").alias("mask"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey >= 3600 THEN printf('%d:%02d:%02d', l_orderkey // 3600, l_orderkey // 60 % 60, l_orderkey % 60) ELSE printf('%02d:%02d', l_orderkey // 60, l_orderkey % 60) END AS t FROM lineitem"
)
def interval_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", names.interval(F.col("l_orderkey") + F.lit(0.7)).alias("t"))


# ---------------------------------------------------------------- arrays
@query(ctes("scores") + " SELECT object_id, CAST(len(list_filter(probabilities, lambda x: x > 0.5)) AS BIGINT) AS area FROM scores")
def mask_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "scores").select("object_id", arrays.area(F.col("probabilities")).alias("area"))


@query(ctes("images") + " SELECT object_id, CASE WHEN list_max(pixels) > 0 THEN list_transform(pixels, lambda x: CAST(floor(CAST(x * 255 AS DOUBLE) / list_max(pixels)) AS INT)) ELSE pixels END AS pixels FROM images")
def rescale_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "images").select("object_id", arrays.rescale_max(F.col("pixels")).alias("pixels"))


@query(ctes("images") + " SELECT object_id, label FROM images WHERE list_max(pixels) > 200")
def bright_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "images").filter(arrays.brighter_than(F.col("pixels"), 200)).select("object_id", "label")


_DIM = "list_transform(pixels, lambda x: CASE WHEN x < 140 THEN 0 ELSE x END)"


@query(ctes("images") + f", d AS (SELECT object_id, pixels[1:8] AS head, {_DIM} AS p FROM images) SELECT object_id FROM d WHERE len(list_filter(p[1:8], lambda x: x > 0)) > 0")
def empty_tile_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = F.transform(F.slice("pixels", 1, 8), lambda x: F.when(x < 140, 0).otherwise(x))
    return view(spark, sf_dir, "images").filter(arrays.has_signal(dim)).select("object_id")


@query(
    ctes("images")
    + f", d AS (SELECT object_id, {_DIM} AS p, pixels FROM images), m AS (SELECT object_id, list_filter(list_zip(p, pixels), lambda z: z[2] > 100) AS z FROM d) "
    "SELECT object_id, CAST(len(list_filter(z, lambda x: x[1] = 0)) AS DOUBLE) / NULLIF(len(z), 0) AS fraction FROM m"
)
def frac_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = view(spark, sf_dir, "images").withColumn("dim", F.transform("pixels", lambda x: F.when(x < 140, 0).otherwise(x)))
    return i.select("object_id", arrays.fraction_invalid(F.col("dim"), arrays.threshold_mask(F.col("pixels"), 100)).alias("fraction"))


@query(ctes("images") + " SELECT object_id, list_transform(pixels, lambda x: CAST(x AS DOUBLE) / 255) AS pixels FROM images")
def dtype_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "images").select("object_id", arrays.to_float(F.col("pixels")).alias("pixels"))


@query(ctes("images") + " SELECT object_id, [pixels, pixels, pixels] AS rgb FROM images")
def grey_to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "images").select("object_id", arrays.grey_to_rgb(F.col("pixels")).alias("rgb"))


@query(
    ctes("images")
    + " SELECT object_id, list_transform(range(0, 16), lambda i: pixels[(i // 4 + 2) * 8 + i % 4 + 3]) AS cropped, "
    "list_transform(range(0, 100), lambda i: CASE WHEN i // 10 - 1 BETWEEN 0 AND 7 AND i % 10 - 1 BETWEEN 0 AND 7 THEN pixels[(i // 10 - 1) * 8 + i % 10] ELSE 0 END) AS padded FROM images"
)
def centre_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("pixels")
    return view(spark, sf_dir, "images").select("object_id", arrays.centre_fit(p, 8, 8, 4).alias("cropped"), arrays.centre_fit(p, 8, 8, 10).alias("padded"))


@query(ctes("objects") + " SELECT object_id, object_width * object_height AS object_bounding_box_area, object_posx + 2 AS object_posx, object_posy + 1 AS object_posy, object_width - 2 AS object_width, object_height - 1 AS object_height FROM objects")
def region_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "objects")
    bbox = F.struct(F.lit(1).alias("min_row"), F.lit(2).alias("min_col"), F.col("object_height").alias("max_row"), F.col("object_width").alias("max_col"))
    return o.select("object_id", (F.col("object_width") * F.col("object_height")).alias("object_bounding_box_area"), *[c.alias(n) for n, c in geometry.region_geometry(F.col("object_posx"), F.col("object_posy"), bbox).items()])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount = 0 THEN 0 ELSE l_tax / l_discount END AS ratio FROM lineitem")
def convex_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", geometry.ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio"))


# ---------------------------------------------------------------- taxonomy
@query(
    ctes("taxonomy")
    + ", d AS (SELECT *, len(string_split(lineage, '>')) AS depth FROM taxonomy), k AS (SELECT *, row_number() OVER (PARTITION BY description ORDER BY depth, ordinal) AS k FROM d) "
    "SELECT description, display_name, lineage, CAST(depth AS BIGINT) AS depth FROM k WHERE k = 1"
)
def taxonomy_shallowest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.translation(view(spark, sf_dir, "taxonomy"))[1]


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 4 <> 0")
def taxonomy_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    star = F.when(F.col("n_nationkey") % 4 == 0, F.lit("*")).otherwise(F.lit(""))
    return taxonomy.without_wildcards(n.withColumn("aliases", F.array("n_name", F.concat("n_name", star)))).select("n_nationkey", "n_name")


_NAMES = [f"c{i}" for i in range(10)]
_DESCRIBE = (
    "list_filter([" + ", ".join(f"CASE WHEN p[{i + 1}] > 0.7 AND p[{i + 1}] > s + 0.01 THEN 'c{i}' WHEN p[{i + 1}] < CAST(1 AS DOUBLE) - CAST(0.7 AS DOUBLE) THEN '!c{i}' END" for i in range(10)) + "], lambda x: x IS NOT NULL)"
)
_D = f", q AS (SELECT object_id, label, probabilities AS p, list_reverse_sort(probabilities)[2] AS s FROM scores), d AS (SELECT object_id, label, {_DESCRIBE} AS description FROM q)"


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "scores").select("object_id", "label", taxonomy.describe(F.col("probabilities"), _NAMES, 0.7, 0.01).alias("description"))


@query(ctes("scores") + _D + " SELECT object_id, array_to_string(description, ' ') AS description FROM d")
def label_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(spark, sf_dir).select("object_id", F.array_join("description", " ").alias("description"))


_HAS = lambda d, *q: " AND ".join(f"list_contains({d}, '{x}')" for x in q)
_WITHOUT = lambda d, x: f"list_filter({d}, lambda z: z <> '{x}')"


def _rule_sql(d: str, q: tuple[str, ...], u: str) -> str:
    gone = u[1:] if u.startswith("!") else "!" + u
    base = _WITHOUT(d, gone)
    return f"CASE WHEN {_HAS(d, *q)} THEN CASE WHEN list_contains({base}, '{u}') THEN {base} ELSE list_append({base}, '{u}') END ELSE {d} END"


@query(
    ctes("scores")
    + _D
    + f", r1 AS (SELECT object_id, {_rule_sql('description', ('!c0',), 'c1')} AS a FROM d), r2 AS (SELECT object_id, {_rule_sql('a', ('c1', '!c2'), 'c2')} AS b FROM r1), "
    f"r3 AS (SELECT object_id, {_rule_sql('b', ('c2',), '!c0')} AS c FROM r2) SELECT object_id, array_to_string(list_sort(list_distinct(c)), ' ') AS description FROM r3"
)
def rules_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = taxonomy.parse_rules({"!c0": "c1", "c1 !c2": "c2", "c2": "!c0"})
    out = taxonomy.apply_rules(_described(spark, sf_dir), "description", rules)
    return out.select("object_id", F.array_join(F.array_sort("description"), " ").alias("description"))


@query(
    ctes("scores")
    + _D
    + ", m AS (SELECT object_id, list_filter(list_transform(description, lambda x: CASE x WHEN 'c3' THEN 'c1' WHEN '!c4' THEN '' ELSE x END), lambda x: x <> '' AND NOT starts_with(x, '!')) AS x FROM d) "
    "SELECT object_id, array_to_string(list_sort(list_distinct(x)), ' ') AS description FROM m"
)
def exclude_unpredicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = taxonomy.positives(taxonomy.exclude_unpredicted(F.col("description"), {"c3": "c1", "!c4": None}))
    return _described(spark, sf_dir).select("object_id", F.array_join(F.array_sort(out), " ").alias("description"))


@query(ctes("scores") + _D + " SELECT object_id FROM d WHERE object_id % 2 = 1 OR list_contains(description, '!c0')")
def validated_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.compatible(_described(spark, sf_dir), "description", F.col("object_id") % 2 == 0, ["!c0"]).select("object_id")


@query(
    ctes("objects")
    + " SELECT object_id, CASE WHEN object_posx % 3 = 0 THEN 'N' ELSE category END AS object_annotation_category, 'predicted' AS object_annotation_status FROM objects WHERE object_posx % 3 = 0 AND category <> 'N'"
)
def label_update_skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "objects").select(
        "object_id", F.col("category").alias("object_annotation_category"), F.lit("validated").alias("object_annotation_status"), F.when(F.col("object_posx") % 3 == 0, F.lit("N")).alias("new")
    )
    return taxonomy.update_labels(o, "new").drop("new")


@query("SELECT p_partkey AS object_id, array_to_string(list_sort(list_distinct(list_concat(string_split(p_type, ' '), string_split(p_name, ' ')))), ' ') AS description FROM part")
def readd_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = F.split("p_type", " ")
    both = taxonomy.readd(new, F.split("p_name", " "))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("object_id"), F.array_join(F.array_sort(both), " ").alias("description"))


# ---------------------------------------------------------------- segments
_COMPONENTS = """, px AS (SELECT object_id, unnest(pixels) AS v, unnest(range(0, 64)) AS i FROM images),
on_ AS (SELECT object_id, i, i // 8 AS y, i % 8 AS x, v FROM px WHERE v > 150),
nb AS (SELECT a.object_id, a.i, b.i AS j FROM on_ a JOIN on_ b ON a.object_id = b.object_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
reach AS (SELECT object_id, i, j FROM nb UNION SELECT r.object_id, r.i, n.j FROM reach r JOIN nb n ON n.object_id = r.object_id AND n.i = r.j),
comp AS (SELECT object_id, i, min(j) AS component FROM reach GROUP BY object_id, i),
size AS (SELECT object_id, component, count(*) AS size FROM comp GROUP BY 1, 2)"""
_RECURSIVE = ctes("images").replace("WITH ", "WITH RECURSIVE ", 1) + _COMPONENTS


@query(_RECURSIVE + " SELECT object_id, CAST(component AS BIGINT) AS component, size FROM size")
def component_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.component_sizes(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 150)


@query(_RECURSIVE + " SELECT object_id, CAST(component AS BIGINT) AS component, size FROM size WHERE size >= 4")
def remove_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.component_sizes(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 150, segments.PostProcess(min_area=4))


@query(
    _RECURSIVE
    + " SELECT object_id, CAST(component AS BIGINT) AS component, size FROM size s WHERE NOT EXISTS (SELECT 1 FROM comp c WHERE c.object_id = s.object_id AND c.component = s.component AND (c.i // 8 IN (0, 7) OR c.i % 8 IN (0, 7)))"
)
def clear_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.component_sizes(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 150, segments.PostProcess(clear_border=True))


@query(_RECURSIVE + ", k AS (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY size DESC, component) AS k FROM size) SELECT object_id, CAST(component AS BIGINT) AS component, size FROM k WHERE k = 1")
def largest_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = segments.component_sizes(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 150)
    return sizes.groupBy("object_id").agg(F.max_by("component", F.struct("size", -F.col("component"))).alias("component"), F.max("size").alias("size"))


_VARY = "avg(power(c.{0} - b.c{0}, 2)) + 1 / 12.0"


@query(
    _RECURSIVE
    + ", b AS (SELECT object_id, component, CAST(min(i // 8) AS INT) AS min_row, CAST(min(i % 8) AS INT) AS min_col, CAST(max(i // 8) + 1 AS INT) AS max_row, CAST(max(i % 8) + 1 AS INT) AS max_col, count(*) AS area, avg(i // 8) AS cy, avg(i % 8) AS cx FROM comp GROUP BY 1, 2), "
    "c AS (SELECT comp.object_id, component, o.y, o.x, o.v FROM comp JOIN on_ o ON o.object_id = comp.object_id AND o.i = comp.i), "
    f"m AS (SELECT c.object_id, c.component, {_VARY.format('y')} AS yy, {_VARY.format('x')} AS xx, avg((c.y - b.cy) * (c.x - b.cx)) AS xy, min(v) AS lo, max(v) AS hi, avg(v) AS mid, stddev_pop(v) AS dev FROM c JOIN b ON b.object_id = c.object_id AND b.component = c.component GROUP BY 1, 2) "
    "SELECT object_id, CAST(row_number() OVER (PARTITION BY object_id ORDER BY component) AS INT) AS label, area, min_row, min_col, max_row, max_col, round(cy, 6) AS centroid_row, round(cx, 6) AS centroid_col, "
    "round(sqrt(8 * (yy + xx + sqrt(4 * xy * xy + (yy - xx) * (yy - xx)))), 6) AS major_axis, round(sqrt(8 * greatest(0, yy + xx - sqrt(4 * xy * xy + (yy - xx) * (yy - xx)))), 6) AS minor_axis, "
    "round(mid, 6) AS mean, round(dev, 6) AS std, CAST(lo AS DOUBLE) AS min, CAST(hi AS DOUBLE) AS max FROM b JOIN m USING (object_id, component)"
)
def region_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segments.segment(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 150)
    measured = [F.round(c, 6).alias(c) for c in ("centroid_row", "centroid_col", "major_axis", "minor_axis", "mean", "std")]
    return found.select("object_id", "label", "area", "min_row", "min_col", "max_row", "max_col", *measured, "min", "max")


_MASK = ctes("images") + ", px AS (SELECT object_id, unnest(pixels) AS v, unnest(range(0, 64)) AS i FROM images), m0 AS (SELECT object_id, i // 8 AS y, i % 8 AS x, v > {threshold} AS hit FROM px)"
_FAR = "(a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)"
_ON = " SELECT object_id, CAST(y * 8 + x AS INT) AS pos FROM {last} WHERE hit"


def _morphology(threshold: int, *steps: tuple[str, str]) -> str:
    """SQL of steps over masks: of each pixel, `and` or `or` over those whose squared distance meets the condition."""
    made = [
        f", m{n} AS (SELECT a.object_id, a.y, a.x, bool_{how}(b.hit) AS hit FROM m{n - 1} a JOIN m{n - 1} b ON a.object_id = b.object_id AND {_FAR} {near} GROUP BY 1, 2, 3)"
        for n, (how, near) in enumerate(steps, 1)
    ]
    return _MASK.format(threshold=threshold) + "".join(made) + _ON.format(last=f"m{len(steps)}")


def _masked(spark: SparkSession, sf_dir: str, threshold: int, step: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """object_id and place of each pixel of the masks that the step makes."""
    out = segments.map_masks(view(spark, sf_dir, "images"), "object_id", "pixels", 8, threshold, step)
    return out.select("object_id", F.posexplode("mask").alias("pos", "hit")).filter("hit").select("object_id", "pos")


@query(_morphology(110, ("and", "<= 1"), ("or", "<= 1")))
def opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, 110, lambda m: kernels.opening(m, 1))


@query(_morphology(140, ("or", "<= 4"), ("and", "<= 4")))
def closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, 140, lambda m: kernels.closing(m, 2))


@query(_morphology(110, ("and", "<= 1"), ("or", "< 1.96")))
def isotropic_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, 110, lambda m: kernels.isotropic_dilate(kernels.isotropic_erode(m, 1), 1.4))


@query(_morphology(140, ("or", "< 4"), ("and", "<= 4")))
def isotropic_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, 140, lambda m: kernels.isotropic_closing(m, 2))


@query(
    _MASK.format(threshold=110)
    + f", d AS (SELECT a.object_id, a.y, a.x, min({_FAR}) AS far FROM m0 a JOIN m0 b ON a.object_id = b.object_id WHERE NOT b.hit GROUP BY 1, 2, 3) "
    "SELECT object_id, CAST(y * 8 + x AS INT) AS pos, sqrt(far) AS distance FROM d"
)
def distance_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segments.map_masks(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 110, kernels.distance, "distance", "double")
    return out.select("object_id", F.posexplode("distance").alias("pos", "distance")).filter("distance is not null")


@query(
    _MASK.format(threshold=120).replace("WITH ", "WITH RECURSIVE ", 1)
    + ", outside AS (SELECT object_id, y, x FROM m0 WHERE NOT hit AND (y IN (0, 7) OR x IN (0, 7)) UNION "
    "SELECT b.object_id, b.y, b.x FROM outside a JOIN m0 b ON a.object_id = b.object_id AND abs(a.y - b.y) + abs(a.x - b.x) = 1 WHERE NOT b.hit), "
    "filled AS (SELECT m0.object_id, m0.y, m0.x, o.object_id IS NULL AS hit FROM m0 LEFT JOIN outside o ON o.object_id = m0.object_id AND o.y = m0.y AND o.x = m0.x)" + _ON.format(last="filled")
)
def fill_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, 120, kernels.fill_holes)


@query()
def postprocess_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    post = segments.PostProcess(opening_radius=1, closing_radius=1, min_area=2, merge_segments_distance=2)
    return segments.segment(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 120, post)


@query()
def region_cutouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.cut_regions(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 150, padding=1, min_intensity=170, apply_mask=True)


@query()
def measure_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = view(spark, sf_dir, "images").withColumns({"body": arrays.to_float(F.col("pixels")), "gut": F.transform("pixels", lambda x: (x - 30) / 255.0)})
    return segments.measure(i, "object_id", {"body": "body", "gut": "gut"}, 8, fill=["body"])


@query(
    ctes("images")
    + ", t AS (SELECT object_id, pixels, y, x FROM images, (SELECT unnest([0, 2, 4]) AS y), (SELECT unnest([0, 2, 4]) AS x)), c AS (SELECT object_id, y + i // 4 AS row, x + i % 4 AS col, pixels[(y + i // 4) * 8 + x + i % 4 + 1] + y + x AS v FROM t, (SELECT unnest(range(0, 16)) AS i)) "
    "SELECT object_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, avg(v) AS value FROM c GROUP BY ALL"
)
def tiles_8x8_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = segments.tiles(view(spark, sf_dir, "images"), "object_id", "pixels", 8, 8, 4, 2)
    t = t.withColumn("tile", F.transform("tile", lambda v: v + F.col("top") + F.col("left")))
    return segments.blend(t, "object_id", "tile", 4, linear=False)


@query(ctes("images") + " SELECT object_id, CAST(list_sum(pixels) AS DOUBLE) AS total, CAST(list_max(pixels) AS DOUBLE) AS top FROM images")
def model_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = lambda: lambda x: np.stack([x.sum(1), x.max(1)], 1)
    out = segments.infer(view(spark, sf_dir, "images"), "pixels", load, dtype="float64", batch_size=64)
    return out.select("object_id", F.col("predictions")[0].alias("total"), F.col("predictions")[1].alias("top"))


# ---------------------------------------------------------------- duplicates
@query()
def dup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.detect(view(spark, sf_dir, "objects"), "sample_id", "object_frame_id", min_similarity=0.5, max_age=1).select("object_id", "dupset_id")


@query()
def duplicate_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_sets(dup_full(spark, sf_dir))
