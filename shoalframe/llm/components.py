"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, materialise

#: Most hubs that are broadcast, 16 bytes each, and rows that a hub has at least.
HUBS, OFTEN = 4096, 256


class Forest:
    """Union-find over hashable ids; the smallest id of a set is its root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x: object) -> object:
        up = self.up
        top = x
        while (n := up.get(top, top)) != top:
            top = n
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a: object, b: object) -> bool:
        """True if they weren't in one set."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def local(edges: DataFrame) -> DataFrame:
    """The same components with at most one edge per id and partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
                forest.join(a, b)
        pairs = [(x, forest.root(x)) for x in list(forest.up)]
        yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInPandas(run, "a long, b long")


def _with_least(rows: DataFrame, total: int) -> DataFrame:
    """u, v, m of the rows (u, v): m is the least v of all rows of that u. total: about how many rows there are.

    A u of over a HUBS-th of the rows is a hub, of which there are fewer than HUBS: their m are broadcast, so that a hub's rows stay
    where they are; only the others meet by their u.
    """
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    often = max(OFTEN, total // HUBS)
    hubs, others = least.filter(F.col("n") > often).select("u", "m"), least.filter(F.col("n") <= often).select("u", "m")
    near = rows.join(F.broadcast(hubs), "u").select("u", "v", "m")
    return near.union(rows.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(others, "u").select("u", "v", "m"))


def _large(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _with_least(both, 2 * total).filter("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()


def _small(edges: DataFrame, total: int) -> DataFrame:
    rows = _with_least(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), total)
    moved = rows.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(edges.groupBy("a").agg(F.min("b").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in an edge of two different ids; component is its smallest id.

    Edges (a, b) may repeat and go either way; nulls and loops are left out; no edges: no rows.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # written first: what made the edges and local() would otherwise keep two Python workers in each task
    found = materialise(edges, "found")
    edges = materialise(local(found), "edges")
    discard(found)
    while True:
        # every id has one edge, and that leads to an id that has none: only stars are left
        ends = edges.agg(F.count("a").alias("n"), F.count_distinct("a").alias("ids")).first()
        if ends["n"] == ends["ids"] and edges.select("b").distinct().join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        stars = materialise(_large(edges, ends["n"]), "stars")
        discard(edges)
        edges = materialise(_small(stars, ends["n"]), "edges")
        discard(stars)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
