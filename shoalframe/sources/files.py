"""Files as tables: discovery, pictures, telemetry, sample metadata, side tables, archives."""

from __future__ import annotations

import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names
from . import jpeg
from .jpeg import Unsupported
from ..operators.metadata import SENSORS, last_by_path, not_ignored, rename_present, union_primary

# A sample's folders, and the patterns of its files.
PICTURES, TELEMETRY, LOG, META = "Pictures", "Telemetrie", r"/Log/LOKI[^/]*\.log$", r"/meta\.yaml$"
SUFFIXES = r"\.(jpg|bmp|png)$"


def files(spark: SparkSession, pattern: str, ignore: list[str] = ()) -> DataFrame:
    """path, length, content of all files under the pattern; content is only read where it is used."""
    table = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern).select("path", "length", "content")
    return not_ignored(table, "path", list(ignore))


def sample_roots(listing: DataFrame, discover: bool = True) -> DataFrame:
    """root, ordinal: folders that hold both pictures and telemetry, in natural order."""
    folder = rf"^(.*)/({PICTURES}|{TELEMETRY})/"
    roots = listing.select(F.regexp_extract("path", folder, 1).alias("root"), F.regexp_extract("path", folder, 2).alias("kind")).filter("root <> ''")
    found = roots.groupBy("root").agg(F.count_distinct("kind").alias("n"))
    found = found.filter("n = 2") if discover else found
    return natural_order(found.select("root"), "root")


def natural_order(table: DataFrame, column: str) -> DataFrame:
    """table with `ordinal`, counting from 0 in natural order: a list of roots or archives, not of their rows."""
    return table.withColumn("ordinal", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(names.natural_key(F.col(column)), F.col(column))) - 1)


def pictures(listing: DataFrame) -> DataFrame:
    """root, path, object_id of the pictures two levels under Pictures; suffixes are case-sensitive."""
    place = rf"^(.*)/{PICTURES}/[^/]+/([^/]+)$"
    rows = listing.select(F.regexp_extract("path", place, 1).alias("root"), "path", F.regexp_extract("path", place, 2).alias("file"), "content")
    rows = rows.filter("root <> ''").filter(F.col("file").rlike(SUFFIXES))
    stem = F.regexp_replace(F.regexp_replace("file", r"\.[^.]*$", ""), "%20", " ")
    return rows.select("root", "path", stem.alias("object_id"), "content")


# ---------------------------------------------------------------- pictures
def _png(data: bytes) -> np.ndarray:
    at, idat, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            idat.append(body)
        at += 12 + n
    w, h, depth, color, _, _, interlaced = head
    if depth != 8 or interlaced:
        raise Unsupported("only plain 8-bit PNG is read")
    c = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    raw = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8).reshape(h, 1 + w * c)
    out = np.zeros((h + 1, w * c + c), np.int32)
    for y in range(h):
        kind, line, up, now = raw[y, 0], raw[y, 1:].astype(np.int32), out[y], out[y + 1]
        if kind in (0, 2):
            now[c:] = (line + (up[c:] if kind else 0)) & 255
        else:
            for x in range(w * c):
                a, b, d = now[x], up[x + c], up[x]
                if kind == 1:
                    p = a
                elif kind == 3:
                    p = (a + b) // 2
                else:
                    e = a + b - d
                    p = min((abs(e - a), 0, a), (abs(e - b), 1, b), (abs(e - d), 2, d))[2]
                now[x + c] = (line[x] + p) & 255
    pixels = out[1:, c:].astype(np.uint8).reshape(h, w, c)
    return palette[pixels[..., 0]] if color == 3 else pixels[..., :1] if color == 4 else pixels[..., :3]


def _bmp(data: bytes) -> np.ndarray:
    offset, w, h, bits = struct.unpack("<I", data[10:14])[0], *struct.unpack("<ii", data[18:26]), struct.unpack("<H", data[28:30])[0]
    if bits not in (8, 24) or struct.unpack("<I", data[30:34])[0]:
        raise Unsupported("only plain 8-bit and 24-bit BMP is read")
    row = (w * bits + 31) // 32 * 4
    raw = np.frombuffer(data, np.uint8, row * abs(h), offset).reshape(abs(h), row)
    raw = raw[::-1] if h > 0 else raw
    if bits == 24:
        return raw[:, : 3 * w].reshape(abs(h), w, 3)[..., ::-1]
    start = 14 + struct.unpack("<I", data[14:18])[0]
    return np.frombuffer(data, np.uint8, offset - start, start).reshape(-1, 4)[:, 2::-1][raw[:, :w]]


def decode(data: bytes) -> np.ndarray:
    """A grey image of a JPEG, PNG or BMP file; anything else is an error, Unsupported for files that are only of a kind not read here."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        image = _png(data)
    elif data[:2] == b"BM":
        image = _bmp(data)
    elif data[:3] == b"\xff\xd8\xff":
        image = jpeg.decode(data)
    else:
        raise ValueError("unknown image format")
    if image.shape[2] == 1:
        return image[..., 0]
    return (image @ np.array([19595, 38470, 7471]) + 0x8000 >> 16).astype(np.uint8)


def encode_png(image: np.ndarray) -> bytes:
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    h, w = image.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1).astype(np.uint8)], 1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def read_images(table: DataFrame, content: str = "content") -> DataFrame:
    """table with height, width and pixels for its content; rows that can't be decoded have nulls.

    Files that are damaged or no pictures have nulls: filter on `pixels is not null` to skip them, and count them with observed().
    A picture of a kind that isn't read (progressive JPEG, 16-bit PNG) fails the query instead of getting lost. Filter rows before
    this, too: the decoder only sees what is left.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for data in s:
                try:
                    image = decode(bytes(data))
                    rows.append((*image.shape, image.ravel().astype(int).tolist()))
                except Unsupported:
                    raise
                except Exception:  # noqa: BLE001  whatever is wrong with this file, the others go on
                    rows.append((None, None, None))
            yield pd.DataFrame(rows, columns=["height", "width", "pixels"]).astype({"height": "Int64", "width": "Int64"})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    image = F.pandas_udf(run, "height long, width long, pixels array<int>")(F.col(content))
    return table.withColumn("_i", image).select(*[c for c in table.columns if c != content], "_i.*")


# ---------------------------------------------------------------- telemetry and metadata
def telemetry(listing: DataFrame) -> DataFrame:
    """root, ts and sensor columns: all .tmd readings, and .dat readings of neither their stems nor their times.

    Lines are `NAME value` with :, ;, =, a comma or space between. A file without any known sensor has no row.
    """
    place = rf"^(.*)/{TELEMETRY}/(?:.*/)?([^/]+)\.(tmd|dat)$"
    rows = listing.select(F.regexp_extract("path", place, 1).alias("root"), F.regexp_extract("path", place, 2).alias("stem"), F.regexp_extract("path", place, 3).alias("kind"), "path", F.decode("content", "ISO-8859-1").alias("text"))
    rows = rows.filter("root <> ''").withColumn("ts", names.file_time(F.regexp_replace("path", "%20", " "))).filter("ts is not null")
    value = lambda s: F.regexp_extract("text", rf"(?m)^\s*{s}\s*[:;=, \t]+\s*([-+]?[0-9.]+(?:[eE][-+]?\d+)?)", 1)
    rows = rows.withColumns({s: F.when(value(s) != "", value(s).try_cast("double")) for s in SENSORS})
    rows = rename_present(rows.filter(F.coalesce(*SENSORS).isNotNull()), SENSORS, ["root", "ts", "stem", "kind", "path"])
    both = [last_by_path(rows.filter(F.col("kind") == k).drop("kind"), ["root", "ts"], "path") for k in ("tmd", "dat")]
    stems = rows.filter("kind = 'tmd'").select("root", "stem").distinct()
    return union_primary(both[0], both[1].join(stems, ["root", "stem"], "left_anti"), ["root", "ts"]).drop("stem", "path")


def sample_metadata(listing: DataFrame) -> DataFrame:
    """root, meta: `key: value` lines of the sample's one log, then the entries of meta.yaml over them.

    A sample with no log or several fails the query.
    """
    logs = listing.filter(F.col("path").rlike(LOG)).select(F.regexp_extract("path", r"^(.*)/Log/", 1).alias("root"), "content", F.lit(0).alias("k"))
    metas = listing.filter(F.col("path").rlike(META)).select(F.regexp_extract("path", r"^(.*)/meta\.yaml$", 1).alias("root"), "content", F.lit(1).alias("k"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        log = group[group["k"] == 0]["content"]
        if len(log) != 1:
            raise ValueError(f"{key[0]} has {len(log)} logs instead of one")
        meta = {m[1].strip(): m[2].strip() for m in re.finditer(r"(?m)^([\w ]+?)\s*[:=]\s*(.*)$", bytes(log.iloc[0]).decode("latin-1"))}
        for text in group[group["k"] == 1]["content"]:
            meta |= {k: None if v is None else str(v) for k, v in (yaml.safe_load(bytes(text)) or {}).items()}
        return pd.DataFrame({"root": [key[0]], "meta": [meta]})

    return logs.union(metas).groupBy("root").applyInPandas(run, "root string, meta map<string,string>")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with header; a second line of type marks ([t], [f]) is left out."""
    table = spark.read.csv(path, sep="\t", header=True)
    marks = [F.coalesce(F.col(f"`{c}`").isin("[t]", "[f]"), F.lit(False)) for c in table.columns]
    every = marks[0]
    for m in marks[1:]:
        every = every & m
    return table.filter(~every)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


def read_archives(spark: SparkSession, pattern: str, ignore: list[str] = ()) -> DataFrame:
    """archive, object_id, meta, image of the rows of zipped tables; image is the file named by img_file_name, or null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    inside = set(z.namelist())
                    for name in sorted(n for n in inside if n.endswith((".tsv", ".txt"))):
                        table = pd.read_csv(z.open(name), sep="\t", dtype=str, keep_default_na=False)
                        if len(table) and table.iloc[0].isin(["[t]", "[f]"]).all():
                            table = table.iloc[1:]
                        for r in table.to_dict("records"):
                            file = r.get("img_file_name")
                            rows.append((path, r.get("object_id"), r, z.read(file) if file in inside else None))
                yield pd.DataFrame(rows, columns=["archive", "object_id", "meta", "image"])

    listing = files(spark, pattern, ignore).filter(F.col("path").endswith(".zip")).select("path", "content")
    return listing.mapInPandas(run, "archive string, object_id string, meta map<string,string>, image binary")


# ---------------------------------------------------------------- sinks
def build_archives(table: DataFrame, archive: str, image: str | None = None, file: str | None = None, type_header: bool = True, mask: str | None = None) -> DataFrame:
    """name, content: one zipped table per archive with its images (arrays of bytes) under the names in `file`.

    An archive is one file and so one task's work. mask: also stored, as <name>_mask<ext>.
    """
    columns = [c for c in table.columns if c not in (archive, image, mask, file)]
    numeric = {f.name for f in table.schema if f.dataType.typeName() in ("integer", "long", "double", "float", "short")}

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        meta = group[columns].copy()
        if file:
            meta["img_file_name"] = group[file]
        if "object_id" in meta:
            meta = meta.sort_values("object_id")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            text = meta.to_csv(sep="\t", index=False)
            if type_header:
                head, _, rest = text.partition("\n")
                text = head + "\n" + "\t".join("[f]" if c in numeric else "[t]" for c in meta.columns) + "\n" + rest
            z.writestr(zipfile.ZipInfo("ecotaxa_export.tsv"), text)
            if image and file:
                for name, data in sorted(zip(group[file], group[image], strict=True)):
                    z.writestr(zipfile.ZipInfo(name), bytes(data))
            if mask and file:
                for name, data in sorted(zip(group[file], group[mask], strict=True)):
                    stem, dot, ext = name.rpartition(".")
                    z.writestr(zipfile.ZipInfo(f"{stem or ext}_mask{dot}{ext if stem else ''}"), bytes(data))
        return pd.DataFrame({"name": [key[0]], "content": [out.getvalue()]})

    return table.groupBy(archive).applyInPandas(run, "name string, content binary")


def debug_images(frames: DataFrame, key: str, pixels: str, width: int, labels: str | None = None, scores: str | None = None) -> DataFrame:
    """name, content: each frame as PNG, with its labels over it and its scores as grey levels if given."""
    from ..functions.drawing import overlay

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                image = np.asarray(r[pixels]).reshape(-1, width).astype(np.uint8)
                rows.append((f"{r[key]}.png", encode_png(image)))
                if labels:
                    rows.append((f"{r[key]}_overlay.png", encode_png(overlay(image, np.asarray(r[labels]).reshape(image.shape)))))
                if scores:
                    rows.append((f"{r[key]}_score.png", encode_png(np.rint(255 * np.clip(np.asarray(r[scores], float), 0, 1)).astype(np.uint8).reshape(image.shape))))
            yield pd.DataFrame(rows, columns=["name", "content"])

    return frames.select(key, pixels, *[c for c in (labels, scores) if c]).mapInPandas(run, "name string, content binary")


def save_files(built: DataFrame, target: str) -> list[str]:
    """Writes (name, content) rows into a folder that executors share; the names of the files.

    Executors write, each file under a name of its own first, so that a task that runs twice leaves whole files. Where pyarrow doesn't
    know the folder's file system, the files pass through the driver one at a time, to Hadoop's.
    """
    from pyarrow import ArrowInvalid
    from pyarrow.fs import FileSystem, FileType

    def place() -> tuple[FileSystem, str]:
        return FileSystem.from_uri(target if "://" in target or target.startswith("file:") else Path(target).resolve().as_uri())

    try:
        place()
    except (ArrowInvalid, OSError):
        spark = built.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
        written = []
        for row in built.toLocalIterator():
            out = fs.create(path(target, row["name"]), True)
            out.write(bytearray(row["content"]))
            out.close()
            written.append(row["name"])
        return written

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = place()
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                final = f"{root}/{name}"
                part = f"{final}.{uuid.uuid4().hex}.part"
                fs.create_dir(final.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(part) as out:
                    out.write(bytes(content))
                if fs.get_file_info(final).type == FileType.File:
                    fs.delete_file(final)
                fs.move(part, final)
            yield batch[["name"]]

    return [r["name"] for r in built.select("name", "content").mapInPandas(run, "name string").collect()]


def save_scores(table: DataFrame, path: str, key: str = "object_id", scores: str = "predictions") -> None:
    table.select(key, scores).write.option("compression", "gzip").parquet(path)


def existing_names(spark: SparkSession, target: str) -> DataFrame:
    """The names of the files in a folder, none if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return spark.createDataFrame([(n,) for n in found], "name string")
