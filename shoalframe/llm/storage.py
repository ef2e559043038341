"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of texts that travel to Python at once, at most.
BATCH = 1000

_written: list[tuple[object, str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, one of our own for a master that runs in this process alone, as in
    tests; a cluster must name one that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="shoalframe-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def long_rows(table: DataFrame) -> DataFrame:
    """table, in a session that sends at most BATCH rows to Python at once: texts and pages are long, so that Spark's 10,000 would
    take hundreds of megabytes in each worker. The setting is only ever lowered."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(table.sparkSession.conf.get(key))
    if not 0 < now <= BATCH:
        table.sparkSession.conf.set(key, str(BATCH))
    return table


def trim() -> None:
    """Gives freed memory of this Python worker back to the system; workers outlive their tasks."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again, so that a lost executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a table that materialise() returned and that nothing reads any more."""
    entry = (table.sparkSession, table.written_at)
    _written.remove(entry)
    _delete(*entry)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(table: DataFrame, name: str) -> DataFrame:
    """table, as read from its files, with each row's number from 0 on, in the order of writing, as column `name`. What isn't read
    from files is written first. Reading deals files out by size, so that the order of the rows as read says nothing."""
    try:
        table.select("_metadata.row_index")
    except AnalysisException:
        table = materialise(table, "numbered")
    path = F.col("_metadata.file_path")
    rows = table.select("*", path.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = table.select(path.alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    files = files.withColumn("_part", F.regexp_extract("_file", r".*part-(\d+)", 1).try_cast("long"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_base"))
    return rows.join(F.broadcast(files), "_file").select(*[rows[c] for c in table.columns], (F.col("_base") + F.col("_row")).alias(name))


def release() -> None:
    """Deletes what materialise() has written; DataFrames that read it can't be used afterwards."""
    while _written:
        try:
            _delete(*_written.pop())
        except Exception:  # noqa: BLE001  the session has ended; the folder's owner clears it
            return


atexit.register(release)
