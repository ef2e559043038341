"""Objects seen again in following frames: stateful matching by box overlap."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import assign

#: Least similarity of a duplicate, and frames that an object may be away.
MIN_SIMILARITY, MAX_AGE = 0.98, 1


def iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of boxes (posx, posy, width, height): a matrix."""
    def common(k: int) -> np.ndarray:
        return np.maximum(0, np.minimum((a[:, k] + a[:, k + 2])[:, None], (b[:, k] + b[:, k + 2])[None]) - np.maximum(a[:, k][:, None], b[:, k][None]))

    both = common(0) * common(1)
    joint = (a[:, 2] * a[:, 3])[:, None] + (b[:, 2] * b[:, 3])[None] - both
    return np.divide(both, joint, out=np.zeros(both.shape), where=joint > 0)


class Matcher:
    """Feeds on frames in order; known: id -> [box, frames since it was last seen]."""

    def __init__(self, min_similarity: float = MIN_SIMILARITY, max_age: int = MAX_AGE):
        self.min_similarity, self.max_age = min_similarity, max_age
        self.known: dict[str, tuple[tuple, int]] = {}

    def frame(self, ids: list, boxes: np.ndarray | list) -> list:
        """The first-seen id of each object: matched to the known ones by the largest total similarity, which counts
        only where it reaches the minimum (inclusive). A match passes on its box."""
        out = list(ids)
        boxes = boxes.tolist() if isinstance(boxes, np.ndarray) else boxes
        if self.known and out:
            old = list(self.known)
            before = [v[0] for v in self.known.values()]
            for i, j, s in _pairs(before, boxes) if self.min_similarity > 0 else _all_pairs(before, boxes):
                if s >= self.min_similarity:
                    out[j] = old[i]
        known = {k: (box, age + 1) for k, (box, age) in self.known.items() if age < self.max_age}
        for k, box in zip(out, boxes, strict=True):
            known.pop(k, None)
            known[k] = (tuple(box), 0)
        self.known = known
        return out


def _all_pairs(a: list, b: list) -> list[tuple[int, int, float]]:
    m = iou(np.array(a, float), np.array(b, float))
    return [(i, j, m[i, j]) for i, j in assign(m)]


def _pairs(a: list, b: list) -> list[tuple[int, int, float]]:
    """The assignment's pairs with any overlap. Boxes that overlap nothing else are paired without a solver."""
    if len(a) * len(b) > 2500:
        m = iou(np.array(a, float), np.array(b, float))
        found = [(int(i), int(j), m[i, j]) for i, j in zip(*np.nonzero(m), strict=True)]
    else:
        found = []
        for i, (ax, ay, aw, ah) in enumerate(a):
            for j, (bx, by, bw, bh) in enumerate(b):
                w = min(ax + aw, bx + bw) - max(ax, bx)
                if w > 0:
                    h = min(ay + ah, by + bh) - max(ay, by)
                    if h > 0:
                        found.append((i, j, w * h / (aw * ah + bw * bh - w * h)))
    rows, cols = Counter(f[0] for f in found), Counter(f[1] for f in found)
    out = [f for f in found if rows[f[0]] == 1 and cols[f[1]] == 1]
    rest = [f for f in found if not (rows[f[0]] == 1 and cols[f[1]] == 1)]
    if rest:
        i, j = sorted({f[0] for f in rest}), sorted({f[1] for f in rest})
        at_i, at_j = {k: n for n, k in enumerate(i)}, {k: n for n, k in enumerate(j)}
        m = np.zeros((len(i), len(j)))
        for x, y, s in rest:
            m[at_i[x], at_j[y]] = s
        out += [(i[x], j[y], m[x, y]) for x, y in assign(m)]
    return out


BOX = ["object_posx", "object_posy", "object_width", "object_height"]


def detect(
    objects: DataFrame, sample: str | None, frame: str, order: str = "object_id", min_similarity: float = MIN_SIMILARITY, max_age: int = MAX_AGE, column: str = "dupset_id"
) -> DataFrame:
    """objects with the id of their duplicate set: that of its first member.

    Samples are matched independently (None: one sequence, state carried through), their frames in ascending
    order. Partitions hold whole samples, sorted; state is carried over Arrow batches and dropped when the sample changes.
    """
    rows = objects.withColumn("_s", F.col(sample) if sample else F.lit(0))
    id_kind = objects.schema["object_id"].dataType.simpleString()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in objects.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        now, matcher = None, None

        def finish(part: pd.DataFrame) -> pd.DataFrame:
            """All rows of part; its frames are complete."""
            nonlocal now, matcher
            out: list = []
            samples, ids, boxes = part["_s"].tolist(), part["object_id"].tolist(), part[BOX].to_numpy().tolist()
            edges = np.flatnonzero((part["_s"].ne(part["_s"].shift()) | part[frame].ne(part[frame].shift())).to_numpy()).tolist()
            for a, b in zip(edges, [*edges[1:], len(part)], strict=True):
                if matcher is None or samples[a] != now:
                    now, matcher = samples[a], Matcher(min_similarity, max_age)
                out += matcher.frame(ids[a:b], boxes[a:b])
            return part.drop(columns="_s").assign(**{column: out})

        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = batch.iloc[-1]
            open_ = ((batch["_s"] == last["_s"]) & (batch[frame] == last[frame])).to_numpy()
            held = batch[open_]
            if not open_.all():
                yield finish(batch[~open_].reset_index(drop=True))
        if held is not None:
            yield finish(held.reset_index(drop=True))

    rows = rows.repartition("_s") if sample else rows.coalesce(1)
    return rows.sortWithinPartitions("_s", frame, order).mapInPandas(run, f"{fields}, `{column}` {id_kind}")


def keep_first(objects: DataFrame, column: str = "dupset_id") -> DataFrame:
    return objects.filter(F.col(column) == F.col("object_id"))


def remove(objects: DataFrame, sample: str | None, frame: str, settings: dict | bool | None, **options: object) -> DataFrame:
    """detect() and keep_first(); a falsy setting turns it off, True stands for the defaults."""
    if not settings:
        return objects
    options |= {} if settings is True else settings
    return keep_first(detect(objects, sample, frame, **options)).drop("dupset_id")


def confirm(detected: DataFrame, images: DataFrame, pixels: str, width: int, min_score: float = 0.5, column: str = "dupset_id") -> DataFrame:
    """detected with `score`, the agreement of each duplicate's image features with those of its set's first member (1 for
    that itself); duplicates under min_score get their own id back. A cheap box match comes first, features only for its pairs."""

    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        from ..functions.features import keypoints, similarity

        return pd.Series([similarity(keypoints(np.asarray(x).reshape(-1, width)), keypoints(np.asarray(y).reshape(-1, width))) for x, y in zip(a, b, strict=True)], dtype=float)

    score.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    pairs = detected.filter(F.col(column) != F.col("object_id")).select("object_id", column)
    own = images.select("object_id", F.col(pixels).alias("_a"))
    first = images.select(F.col("object_id").alias(column), F.col(pixels).alias("_b"))
    scored = pairs.join(own, "object_id").join(first, column).select("object_id", F.pandas_udf(score, "double")("_a", "_b").alias("score"))
    out = detected.join(scored, "object_id", "left")
    single = F.col(column) == F.col("object_id")
    return out.withColumn("score", F.when(single, F.lit(1.0)).otherwise(F.col("score"))).withColumn(column, F.when(single | (F.col("score") >= min_score), F.col(column)).otherwise(F.col("object_id")))


def set_images(detected: DataFrame, images: DataFrame, column: str = "dupset_id", singles: bool = False) -> DataFrame:
    """dupset_id, object_id, leads and the image's columns of every member of a set: what to look at."""
    size = detected.groupBy(column).agg(F.count("*").alias("members"))
    rows = detected.select("object_id", column).join(size if singles else size.filter("members > 1"), column)
    return rows.withColumn("leads", F.col(column) == F.col("object_id")).join(images, "object_id")


def duplicate_sets(detected: DataFrame, column: str = "dupset_id", singles: bool = False) -> DataFrame:
    """Each set with its members, the first one leading."""
    out = detected.groupBy(column).agg(F.sort_array(F.collect_list("object_id")).alias("members"))
    return out if singles else out.filter(F.size("members") > 1)
