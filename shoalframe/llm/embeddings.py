"""Embedding near-dedup by an epsilon grid order join.

Unit vectors of cosine 0.98 or more lie at most epsilon = sqrt(2 - 2 * 0.98) apart. The vectors are projected on
the leading principal axes of a bounded sample (any axes give the same links, better ones skip more), ordered by
the cells of a grid of that width, and cut into intervals of the order. Pairs of intervals whose boxes are over
epsilon apart are skipped, first among the sorted partitions, then among their blocks, then by halving the blocks;
what remains is compared in double precision. Only counts and spanning edges leave a task, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .storage import materialise

COSINE = 0.98
#: Vectors of the sample that the principal axes come from, and how many axes order the grid.
SAMPLE, AXES = 4096, 6
#: Rows and bytes of a block of vectors, which travels as one row; of 64 vectors at least.
BLOCK, BYTES, SMALL = 1024, 1 << 20, 96
SALTS = 4
Y = [f"y{i}" for i in range(AXES)]


def _units(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each dimension, where its vectors are and these of length one."""
    size = np.array([len(r) // 8 for r in raw], np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        x = np.frombuffer(b"".join(raw[i] for i in at)).reshape(-1, n)
        x = x / np.abs(x).max(1, keepdims=True)
        yield at, x / np.sqrt((x * x).sum(1, keepdims=True))


def _named(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists, labels = batch.column("embedding"), batch.column("label").to_pylist()
    # nulls become NaN, and -0.0 becomes 0.0
    x = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0
    ends = lists.offsets.to_numpy()
    bad, some = (np.concatenate([[0], np.cumsum(flags)])[ends] for flags in (~np.isfinite(x), x != 0))
    good = (np.diff(bad) == 0) & (np.diff(some) > 0) & lists.is_valid().to_numpy(zero_copy_only=False)
    rows = []
    for label, ok, i, j in zip(labels, good.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if ok and label is not None:
            grp, raw = f"{label}/{j - i}", x[i:j].tobytes()
            rows.append((grp, hashlib.blake2b(grp.encode() + b"\0" + raw, digest_size=16).digest(), raw))
        else:
            rows.append((None, None, None))
    kinds = (pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("vec_id"), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]], ["vec_id", "grp", "cls", "raw"])


def vectors(table: DataFrame) -> DataFrame:
    """vec_id, grp (label and dimension), cls, raw; the last three are null for a vector that links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _named(batch)

    return table.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), "embedding").mapInArrow(run, "vec_id long, grp string, cls binary, raw binary")


def axes(sample: list[bytes]) -> dict[int, np.ndarray]:
    """Principal axes for each dimension in the sample."""
    return {x.shape[1]: np.linalg.eigh(np.cov(x.T, bias=True).reshape(2 * x.shape[1:]))[1][:, ::-1][:, :AXES].copy() for _, x in _units(sample)}


def _project(raw: list[bytes], basis: dict[int, np.ndarray]) -> np.ndarray:
    out = np.zeros((len(raw), AXES))
    for at, x in _units(raw):
        y = x @ basis[x.shape[1]] if x.shape[1] in basis else x[:, :AXES]
        out[at, : y.shape[1]] = y
    return out


def _box(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return y.min(0), y.max(0)


def _apart(a: tuple, b: tuple, eps: float) -> bool:
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(gap @ gap) > eps * eps


def pack(rows: pd.DataFrame) -> dict:
    """A block of rows in grid order as one row, and its box."""
    y = rows[Y].to_numpy(float)
    low, high = _box(y)
    packed = {"ids": rows["id"].to_numpy(np.int64).tobytes(), "copies": rows["copies"].to_numpy(np.int64).tobytes(), "x": b"".join(rows["raw"]), "y": y.tobytes()}
    return packed | {"low": low.tolist(), "high": high.tolist()}


def blocks(batches: Iterator[pd.DataFrame], part: int, most: int) -> Iterator[pd.DataFrame]:
    """The packed blocks of a partition, whose rows come in grid order, group by group."""
    out: list[dict] = []
    held, grp, block = [], None, 0

    def close(rows: pd.DataFrame) -> None:
        nonlocal block
        out.append({"grp": grp, "part": part, "block": block} | pack(rows))
        block += 1

    for batch in batches:
        edges = np.flatnonzero(batch["grp"].ne(batch["grp"].shift()).to_numpy()).tolist()
        for i, j in zip(edges, [*edges[1:], len(batch)], strict=True):
            rows = batch.iloc[i:j]
            if rows["grp"].iat[0] != grp:
                if held:
                    close(pd.concat(held))
                held, grp, block = [], rows["grp"].iat[0], 0
            held.append(rows)
            size = min(most, max(64, BYTES // len(rows["raw"].iat[0])))
            if sum(map(len, held)) >= size:
                rows = pd.concat(held)
                for k in range(0, len(rows) - size + 1, size):
                    close(rows.iloc[k : k + size])
                rows = rows.iloc[len(rows) // size * size :]
                held = [rows] if len(rows) else []
            if sum(len(o["x"]) for o in out) > 8 * BYTES or len(out) > 500:
                yield pd.DataFrame(out)
                out.clear()
    if held:
        close(pd.concat(held))
    if out:
        yield pd.DataFrame(out)


class Side:
    """Rows of one packed block, in grid order."""

    def __init__(self, row: dict):
        self.ids, self.copies = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64)
        self.x = np.frombuffer(row["x"]).reshape(len(self.ids), -1)
        scale = np.abs(self.x).max(1)
        self.x = np.where((scale > 1e100) | (scale < 1e-100), 1 / scale, 1.0)[:, None] * self.x
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.y = np.frombuffer(row["y"]).reshape(-1, AXES)
        self.links = np.zeros(len(self.ids), np.int64)


def span(near: np.ndarray, a: np.ndarray, b: np.ndarray, forest: Forest, edges: list[tuple[int, int]]) -> None:
    """Joins the ids of rows (a) and columns (b) that are near: each row to its first column and each column to its first row,
    then only what these leave apart, so that a dense matrix costs its sides, not its area, in Python."""
    rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    pairs = [*zip(a[rows].tolist(), b[near[rows].argmax(1)].tolist(), strict=True), *zip(a[near[:, cols].argmax(0)].tolist(), b[cols].tolist(), strict=True)]
    edges += [p for p in pairs if forest.join(*p)]
    x, y = (np.array([forest.root(i) for i in ids.tolist()], np.int64) for ids in (a[rows], b[cols]))
    i, j = np.nonzero(near[np.ix_(rows, cols)] & (x[:, None] != y[None, :]))
    if len(i):
        edges += [p for p in map(tuple, np.unique(np.stack([x[i], y[j]], 1), axis=0).tolist()) if forest.join(*p)]


def join(a: Side, b: Side, cosine: float, eps: float, small: int, forest: Forest, edges: list[tuple[int, int]], la: int = 0, ha: int | None = None, lb: int = 0, hb: int | None = None) -> None:
    """Links between two intervals of the order, recursively by halves; a is b: each pair once."""
    ha, hb = len(a.ids) if ha is None else ha, len(b.ids) if hb is None else hb
    if a is b and lb < la or la >= ha or lb >= hb or _apart(_box(a.y[la:ha]), _box(b.y[lb:hb]), eps):
        return
    if max(ha - la, hb - lb) > small:
        ma, mb = (la + ha) // 2, (lb + hb) // 2
        for x, y in ((la, ma), (ma, ha)):
            for z, w in ((lb, mb), (mb, hb)):
                join(a, b, cosine, eps, small, forest, edges, x, y, z, w)
        return
    near = (a.x[la:ha] @ b.x[lb:hb].T) / (a.norm[la:ha, None] * b.norm[None, lb:hb]) >= cosine
    if a is b and la == lb:
        np.fill_diagonal(near, False)
    if not near.any():
        return
    if a is b and la == lb:
        a.links[la:ha] += near @ a.copies[la:ha]
    else:
        a.links[la:ha] += near @ b.copies[lb:hb]
        b.links[lb:hb] += near.T @ a.copies[la:ha]
    span(near, a.ids[la:ha], b.ids[lb:hb], forest, edges)


def near_duplicates(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of table (vec_id, embedding, label).

    Only vectors of equal, non-null label and equal length are compared. Null, empty or zero vectors, and those with
    null or non-finite components, link with nothing, and so do rows with a null vec_id (their component_id is null). Equal vectors link; vec_ids should be unique.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) * (1 + 1e-9) + 1e-9
    own = materialise(vectors(table), "vectors")
    classes = own.filter("cls is not null and vec_id is not null").groupBy("cls").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("grp").alias("grp"), F.first("raw").alias("raw"))
    classes = materialise(classes, "vector-classes")
    sample = classes.select("id", "raw").orderBy(F.xxhash64("id")).limit(SAMPLE).collect()
    basis = axes([bytes(r["raw"]) for r in sample])

    def grid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = _project(batch["raw"].tolist(), basis)
            yield batch[["id", "copies", "grp", "raw"]].assign(**{c: y[:, i] for i, c in enumerate(Y)})

    rows = classes.mapInPandas(grid, f"id long, copies long, grp string, raw binary, {', '.join(f'{c} double' for c in Y)}")
    key = ["grp", *[F.floor(F.col(c) / eps) for c in Y], F.xxhash64("id")]
    rows = rows.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    most, small = BLOCK, SMALL

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        yield from blocks(batches, TaskContext.get().partitionId(), most)

    packed = "grp string, part int, block long, ids binary, copies binary, x binary, y binary, low array<double>, high array<double>"
    placed = materialise(rows.mapInPandas(cut, packed), "grid")
    boxes = placed.select("grp", "part", "block", "low", "high")
    spans = boxes.groupBy("grp", "part").agg(*[F.min(F.col("low")[i]).alias(f"l{i}") for i in range(AXES)], *[F.max(F.col("high")[i]).alias(f"h{i}") for i in range(AXES)])
    spans = spans.select("grp", "part", F.array(*[f"l{i}" for i in range(AXES)]).alias("low"), F.array(*[f"h{i}" for i in range(AXES)]).alias("high"))

    def close(a: str, b: str) -> object:
        gaps = F.zip_with(
            F.zip_with(f"{a}.low", f"{b}.high", lambda p, q: p - q), F.zip_with(f"{b}.low", f"{a}.high", lambda p, q: p - q), lambda p, q: F.greatest(p, q, F.lit(0.0))
        )
        return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps

    x, y = spans.alias("x"), spans.alias("y")
    upper = x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.part") <= F.col("y.part")) & close("x", "y"))
    upper = upper.select(F.col("x.grp").alias("grp"), F.col("x.part").alias("p"), F.col("y.part").alias("q"))
    x, y = boxes.alias("x"), boxes.alias("y")
    ordered = (F.col("u.p") < F.col("u.q")) | (F.col("x.block") <= F.col("y.block"))
    pairs = upper.alias("u").join(x, (F.col("u.grp") == F.col("x.grp")) & (F.col("u.p") == F.col("x.part")))
    pairs = pairs.join(y, (F.col("u.grp") == F.col("y.grp")) & (F.col("u.q") == F.col("y.part")) & ordered & close("x", "y"))
    pairs = pairs.select(F.col("u.grp").alias("grp"), "p", F.col("x.block").alias("i"), "q", F.col("y.block").alias("j"))
    sides = pairs.select(
        "grp", "p", "i", "q", "j",
        F.explode(F.array_distinct(F.array(F.struct(F.col("p").alias("part"), F.col("i").alias("block")), F.struct(F.col("q").alias("part"), F.col("j").alias("block"))))).alias("s"),
    ).select("grp", "p", "i", "q", "j", "s.part", "s.block")
    sent = placed.join(sides, ["grp", "part", "block"])

    def verify(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        forest, edges = Forest(), []
        side = [Side(row) for row in group.sort_values(["part", "block"]).to_dict("records")]
        join(side[0], side[-1], cosine, eps, small, forest, edges)
        out = [(i, n, None) for s in side for i, n in zip(s.ids.tolist(), s.links.tolist(), strict=True) if n]
        return pd.DataFrame(out + [(a, 0, b) for a, b in edges], columns=["a", "n", "b"]).astype({"a": "Int64", "n": "Int64", "b": "Int64"})

    found = materialise(sent.groupBy("grp", "p", "i", "q", "j").applyInPandas(verify, "a long, n long, b long"), "links")
    linked = components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    known = classes.select("cls", "id", "copies").join(counts, F.col("id") == F.col("a"), "left").join(linked, "id", "left")
    known = known.select("cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("component"))
    known = known.filter("n > 0").withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(SALTS)])))
    out = own.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("cls")).alias("cls"), F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt")).join(known, ["cls", "salt"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
