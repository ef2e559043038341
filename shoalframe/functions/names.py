"""Object ids, frame ids, generated ids, file names."""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The id's pattern (two spaces before and after the milliseconds), and the time in a file's name.
OBJECT_ID = r"^(\S+) (\S+)  (\S+)  (\d+) (\d+) (\d+)$"
OBJECT_ID_FORMAT = "%s %s  %s  %06d %04d %04d"
FILE_TIME = r"(\d{8} \d{6})"
#: Instrument name where none is given, and the lead of an archive's name.
INSTRUMENT = "LOKI"


def parse_object_id(column: Column) -> Column:
    """date, time, ms (strings), seq, posx, posy (numbers); an unparsable id fails the query."""
    def fields(p: Column) -> Column:
        numbers = [p[3 + i].try_cast("long").alias(n) for i, n in enumerate(("seq", "posx", "posy"))]
        return F.struct(p[0].alias("date"), p[1].alias("time"), p[2].alias("ms"), *numbers)

    # no part of a parsable id has a space; the one-element array keeps Catalyst from splitting once for every field
    parsed = F.transform(F.array(F.split(column, " +")), fields)[0]
    return F.when(column.rlike(OBJECT_ID), parsed).when(column.isNotNull(), F.raise_error(F.concat(F.lit("can't parse object id: "), column)).cast("struct<date:string,time:string,ms:string,seq:bigint,posx:bigint,posy:bigint>"))


def format_object_id(date: Column, time: Column, ms: Column, seq: Column, posx: Column, posy: Column) -> Column:
    return F.format_string(OBJECT_ID_FORMAT, date, time, ms, seq, posx, posy)


def frame_id(column: Column) -> Column:
    """The part of an object id that its frame's objects share; null if unparsable."""
    part = lambda i: F.regexp_extract(column, OBJECT_ID, i)
    return F.when(column.rlike(OBJECT_ID), F.concat(part(1), F.lit(" "), part(2), F.lit("  "), part(3)))


def with_frame_id(table: DataFrame, strict: bool = False) -> DataFrame:
    """table with object_frame_id, derived from object_id if absent; neither: ValueError."""
    if "object_frame_id" in table.columns:
        return table
    if "object_id" not in table.columns:
        raise ValueError("neither object_frame_id nor object_id is there")
    out = frame_id(F.col("object_id"))
    if strict:
        out = F.coalesce(out, F.raise_error(F.concat(F.lit("can't parse object id: "), F.col("object_id"))).cast("string"))
    return table.withColumn("object_frame_id", out)


def file_time(column: Column) -> Column:
    """The first time in a file's name, null without one."""
    text = F.regexp_extract(column, FILE_TIME, 1)
    return F.try_to_timestamp(F.when(text != "", text), F.lit("yyyyMMdd HHmmss")).cast("timestamp_ntz")


def template(pattern: str, columns: list[str]) -> Column:
    """A str.format pattern over columns, as a concatenation; an unknown field is a KeyError."""
    parts = []
    for text, field, spec, _ in Formatter().parse(pattern):
        if text:
            parts.append(F.lit(text))
        if field is not None:
            if field not in columns:
                raise KeyError(field)
            c = F.col(field)
            if m := re.fullmatch(r"(0?\d*)d", spec or ""):
                c = F.format_string(f"%{m[1]}d", c.cast("long"))
            elif m := re.fullmatch(r"\.(\d+)f", spec or ""):
                c = F.format_string(f"%.{m[1]}f", c.cast("double"))
            elif spec:
                raise ValueError(f"unsupported format: {spec}")
            parts.append(c.cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def generated_ids(station: Column, haul: Column, instrument: Column, now: Column) -> dict[str, Column]:
    sample = F.concat_ws("_", station, haul)
    acq = F.concat_ws("_", F.coalesce(instrument, F.lit(INSTRUMENT)), sample)
    return {"sample_id": sample, "acq_id": acq, "process_id": F.concat_ws("_", acq, now)}


def archive_name(station: Column, haul: Column) -> Column:
    return F.concat(F.lit(f"{INSTRUMENT}_"), station.cast("string"), F.lit("_"), haul.cast("string"), F.lit(".zip"))


def output_name(path: Column, suffix: str) -> Column:
    """The path's base name with `suffix` for its last extension."""
    return F.concat(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", ""), F.lit(suffix))


def file_suffix(path: Column, suffix: str) -> Column:
    """`suffix` before the last extension."""
    last = r"(\.[^./]*)$"
    return F.when(path.rlike(last), F.regexp_replace(path, last, f"{suffix}$1")).otherwise(F.concat(path, F.lit(suffix)))


def natural_key(column: Column) -> Column:
    """Sorts paths part by part, case-insensitively, with runs of digits as numbers."""
    tokens = F.regexp_extract_all(F.lower(column), F.lit(r"([0-9]+|[^0-9/]+|/)"), F.lit(1))
    # a separator sorts before all else, so that a folder's files stand before its longer-named siblings
    return F.transform(tokens, lambda t: F.when(t == "/", F.lit("\x01")).when(t.rlike(r"^[0-9]+$"), F.concat(F.lit("\x02"), F.lpad(t, 30, "0"))).otherwise(F.concat(F.lit("\x03"), t)))


def si(value: Column, base: int = 1000) -> Column:
    """A number with an SI (1000) or IEC (1024) prefix."""
    units = ["", "k", "M", "G", "T", "P"] if base == 1000 else ["", "Ki", "Mi", "Gi", "Ti", "Pi"]
    out = F.format_string("%.2f" + units[-1], value / F.lit(float(base)) ** (len(units) - 1))
    for i in range(len(units) - 2, -1, -1):
        out = F.when(F.abs(value) < float(base) ** (i + 1), F.format_string("%.2f" + units[i], value / float(base) ** i)).otherwise(out)
    return out


def interval(seconds: Column) -> Column:
    """H:MM:SS, or MM:SS under an hour; fractions are cut."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))
