"""Stand-in views with the operators' input shapes over the plain tables; texts valid in Spark, and in DuckDB where noted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .operators.metadata import REQUIRED_FIELDS

_FIELDS = ", ".join(f"'{f}'" for f in REQUIRED_FIELDS)

#: Valid in both engines.
COMMON = {
    "objects": """SELECT concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber, dup_no) AS object_id, o_custkey AS sample_id, l_orderkey AS object_frame_id,
  (l_partkey * 7) % 40 AS object_posx, (l_suppkey * 11) % 40 AS object_posy, CAST(l_quantity AS BIGINT) + 5 AS object_width, CAST(l_linenumber AS BIGINT) * 6 + 5 AS object_height,
  l_returnflag AS category, l_linestatus AS linestatus
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber ORDER BY l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS dup_no FROM lineitem) l
JOIN orders ON o_orderkey = l_orderkey""",
    "annotations": """SELECT object_id, object_frame_id, object_posx + ((object_frame_id * 5 + object_width) % 9) * 2 AS object_posx, object_posy + object_height % 3 AS object_posy,
  object_width, object_height, category AS object_annotation_category,
  CASE WHEN linestatus = 'F' THEN 'validated' WHEN object_posy % 2 = 0 THEN 'dubious' ELSE 'predicted' END AS object_annotation_status
FROM objects WHERE object_frame_id % 5 <> 0 AND object_height <> 47""",
    "valid_frames": "SELECT DISTINCT o_orderkey AS object_frame_id FROM orders WHERE o_orderstatus = 'F'",
    "object_times": "SELECT event_id AS object_id, user_id AS sample_id, CAST(date_trunc('second', ts) AS {ts}) AS ts FROM events WHERE event_type = 'view'",
    "telemetry_primary": "SELECT user_id AS sample_id, CAST(date_trunc('second', ts) AS {ts}) AS ts, max(value) AS object_temperature FROM events WHERE event_type = 'click' GROUP BY user_id, date_trunc('second', ts)",
    "telemetry_secondary": "SELECT user_id AS sample_id, CAST(date_trunc('second', ts) AS {ts}) AS ts, max(value) AS object_salinity FROM events WHERE event_type = 'error' OR (event_type = 'click' AND event_id % 7 = 0) GROUP BY user_id, date_trunc('second', ts)",
    "taxonomy": """SELECT p_partkey AS ordinal, concat_ws('>', p_type, p_brand) AS lineage, p_brand AS description, concat(p_type, '/', p_brand) AS display_name FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, concat_ws('>', p_type, p_brand, p_name), p_brand, concat(p_name, '/', p_brand) FROM part WHERE p_partkey % 2 = 1""",
}
SPARK = {
    "images": "SELECT vec_id AS object_id, label, transform(embedding, x -> CAST(greatest(0, least(255, floor((CAST(x AS DOUBLE) + 0.5) * 255))) AS INT)) AS pixels FROM embeddings",
    "scores": "SELECT vec_id AS object_id, label, transform(slice(embedding, 1, 10), x -> greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), CAST(x AS DOUBLE) * 2 + 0.5))) AS probabilities FROM embeddings",
    "sample_meta": f"SELECT c_custkey AS sample_id, filter(array({_FIELDS}), (k, i) -> (c_custkey + i * 3) % 11 <> 0) AS present_keys FROM customer",
}
DUCK = {
    "images": "SELECT vec_id AS object_id, label, list_transform(embedding, lambda x: CAST(greatest(0, least(255, floor((CAST(x AS DOUBLE) + 0.5) * 255))) AS INT)) AS pixels FROM embeddings",
    "scores": "SELECT vec_id AS object_id, label, list_transform(embedding[1:10], lambda x: greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), CAST(x AS DOUBLE) * 2 + 0.5))) AS probabilities FROM embeddings",
    "sample_meta": f"SELECT c_custkey AS sample_id, list_filter([{_FIELDS}], lambda k, i: (c_custkey + (i - 1) * 3) % 11 <> 0) AS present_keys FROM customer",
}
_NEEDS = {"objects": ["lineitem", "orders"], "valid_frames": ["orders"], "object_times": ["events"], "telemetry_primary": ["events"], "telemetry_secondary": ["events"], "taxonomy": ["part"], "images": ["embeddings"], "scores": ["embeddings"], "sample_meta": ["customer"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a DataFrame."""
    if name == "annotations":
        return spark.sql(COMMON[name].replace("FROM objects", "FROM {objects}"), objects=view(spark, sf_dir, "objects"))
    text = (SPARK | COMMON)[name].replace("{ts}", "TIMESTAMP_NTZ")
    used = {}
    for t in _NEEDS[name]:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
        used[t] = table(spark, sf_dir, t)
    return spark.sql(text, **used)


def ctes(*names: str) -> str:
    """WITH clause of the views for DuckDB, in the order given."""
    return "WITH " + ", ".join(f"{n} AS ({(DUCK | COMMON)[n].replace('{ts}', 'TIMESTAMP')})" for n in names)
