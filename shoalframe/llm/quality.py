"""Quality by co-training: one classifier reads the text, another the metadata, and each labels for the other.

In every round, each view's classifier is fitted on its labelled rows and gives the rows of the unlabelled pool that it is most
sure of, for either class, to the other view. The pool is refilled with rows that no round has seen yet; it is a sample, as what
is passed on is a share of it, and a linear model of some 1,300 weights gains little from more. Each view is calibrated on labelled rows kept back, and a small
logistic model over both calibrated views scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix, portions
from .storage import long_rows

#: Rows of the bounded sample: labelled, and unlabelled ones that come to the pool in each round.
LABELLED, POOL = 5000, 1500
TRIGRAMS, SURFACE, META = 1024, 8, 256
ROUNDS = 5
#: Rows that each view passes on per round and class, as a share of the pool.
SHARE = 0.04


def content(texts: list[str | None]) -> np.ndarray:
    """Byte trigram frequencies and surface measures of each whole text."""
    out = np.zeros((len(texts), TRIGRAMS + SURFACE), np.float32)
    for at, part in portions(texts, 1 << 20):
        raw = [(t or "").encode("utf-8", "replace") + b"\n\n" for t in part]
        buf = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
        gram = (buf[:-2] * np.uint32(0x9E3779B1) + buf[1:-1] * np.uint32(0x85EBCA77) + buf[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(22)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        doc = np.repeat(np.arange(len(raw)), sizes)[:-2]
        grams = np.bincount(doc * TRIGRAMS + gram, minlength=len(raw) * TRIGRAMS).reshape(len(raw), TRIGRAMS)
        norm = np.sqrt(grams)
        out[at : at + len(part), :TRIGRAMS] = norm / np.sqrt(sizes)[:, None]
        for i, t in enumerate(part):
            t = t or ""
            words, lines, n = t.split(), t.split("\n"), len(t) + 1
            kinds = len(set(words))
            out[at + i, TRIGRAMS:] = (
                kinds / (len(words) + 1), len(set(lines)) / len(lines), len(words) / n * 4, np.log1p(n) / 10,
                sum(map(str.isupper, words)) / (len(words) + 1), t.count("|") / n * 10, (t.count("!") + t.count("%") + t.count("#") + t.count("*") + t.count("$") + t.count("&")) / n * 10, np.log1p(len(words) - kinds) / 10,
            )
    return out


def metadata(frame: pd.DataFrame, columns: list[str]) -> np.ndarray:
    """Hashed values of the columns, and of their pairs; numbers by their order of magnitude."""
    out = np.zeros((len(frame), META), np.float32)
    values = []
    for c in columns:
        x = frame[c]
        x = np.floor(2 * np.log1p(pd.to_numeric(x, errors="coerce").abs())) if pd.api.types.is_numeric_dtype(x) else x
        values.append([f"{c}={v}" for v in x])
    rows = np.arange(len(frame))
    for i, a in enumerate(values):
        for b in values[i:]:
            out[rows, [zlib.crc32(f"{x};{y}".encode()) % META for x, y in zip(a, b, strict=True)]] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Logistic:
    """Ridge logistic regression by Newton steps on standardised columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 8):
        self.mean, self.sd = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-3
        z = np.ones((len(x), x.shape[1] + 1))
        np.divide(np.subtract(x, self.mean, out=z[:, :-1]), self.sd, out=z[:, :-1])
        self.w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(steps):
            p = _sigmoid(z @ self.w)
            s = np.maximum(p * (1 - p), 1e-4)
            step = np.linalg.solve((z * s[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * self.w)
            self.w -= step
            if np.abs(step).max() < 1e-3:
                break

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.sd) @ self.w[:-1] + self.w[-1], -30, 30)


class CoTrained:
    def __init__(self, views: list[np.ndarray], y: np.ndarray, pools: list[np.ndarray], rounds: int = ROUNDS, share: float = SHARE):
        """views, y: labelled rows, the last fifth of which calibrate; pools: the views of unlabelled rows, an equal part of which joins
        the pool in each round."""
        self.rate = float(y.mean()) if len(y) else 0.5
        self.models = None
        cut = len(y) - len(y) // 5
        if min(np.bincount(y[:cut].astype(int), minlength=2)) < 2 or min(np.bincount(y[cut:].astype(int), minlength=2)) < 1:
            return
        own = [(v[:cut], y[:cut].astype(float)) for v in views]
        free = np.zeros(len(pools[0]), bool)
        for r in range(rounds):
            models = [Logistic(x, t, 10.0) for x, t in own]
            free[len(free) * r // rounds : len(free) * (r + 1) // rounds] = True
            if not free.any():
                break
            logits = [m.logit(p) for m, p in zip(models, pools, strict=True)]
            gifts = []
            for k in (0, 1):
                todo = np.flatnonzero(free)
                order = todo[np.argsort(logits[k][todo], kind="stable")]
                high = max(1, int(share * len(todo) * self.rate * 2))
                low = max(1, int(share * len(todo) * (1 - self.rate) * 2))
                # what a view isn't sure of, it doesn't pass on
                give = np.concatenate([order[:low][logits[k][order[:low]] < -1], order[-high:][logits[k][order[-high:]] > 1]])
                gifts.append((1 - k, give, (logits[k][give] > 0).astype(float)))
            for to, rows, labels in gifts:
                own[to] = (np.concatenate([own[to][0], pools[to][rows]]), np.concatenate([own[to][1], labels]))
                free[rows] = False
        self.models = [Logistic(x, t, 10.0) for x, t in own]
        held = [m.logit(v[cut:])[:, None] for m, v in zip(self.models, views, strict=True)]
        self.calibrated = [Logistic(h, y[cut:].astype(float), 1.0) for h in held]
        both = np.concatenate([c.logit(h)[:, None] for c, h in zip(self.calibrated, held, strict=True)], 1)
        self.both = Logistic(both, y[cut:].astype(float), 1.0)

    def scores(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """Calibrated probabilities: text, metadata, both."""
        if self.models is None:
            return [np.full(len(views[0]), self.rate)] * 3
        logits = [c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrated, self.models, views, strict=True)]
        return [*map(_sigmoid, logits), _sigmoid(self.both.logit(np.stack(logits, 1)))]


def learn(docs: DataFrame, labels: DataFrame, train: object, columns: list[str], labelled: int = LABELLED, pool: int = POOL) -> CoTrained:
    """Fits on bounded samples, drawn by a hash of the doc_id: labelled rows where `train` holds, and others, `pool` for each round. Of rows
    that share a doc_id the least counts, with the greatest label."""
    known = labels.filter(train).filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    some = known.orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(labelled)
    others = docs.select("doc_id").filter("doc_id is not null").join(labels.select("doc_id"), "doc_id", "left_anti")
    others = others.distinct().orderBy(F.xxhash64("doc_id", F.lit("pool")), "doc_id").limit(pool * ROUNDS).select("doc_id", F.lit(-1).alias("y"))
    picked = some.union(others)  # at most labelled + pool * ROUNDS rows

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.concatenate([content(batch["text"].tolist()), metadata(batch, columns)], 1)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "x": [r.astype(np.float16).tobytes() for r in x]})

    # of rows that share a doc_id one counts
    one = docs.select("doc_id", F.struct("text", *columns).alias("row")).join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("row").alias("row"))
    rows = one.select("doc_id", "y", "row.*").mapInPandas(features, "doc_id long, y int, x binary")
    rows = rows.toPandas().sort_values("doc_id", key=lambda s: mix(s.to_numpy(np.int64).astype(np.uint64)))
    y, x = rows["y"].to_numpy(), np.frombuffer(b"".join(rows["x"]), np.float16).reshape(len(rows), -1 if len(rows) else TRIGRAMS + SURFACE + META)
    del rows
    views = [x[:, : TRIGRAMS + SURFACE], x[:, TRIGRAMS + SURFACE :]]
    return CoTrained([v[y >= 0] for v in views], y[y >= 0], [v[y < 0] for v in views])


def scores(docs: DataFrame, model: CoTrained, columns: list[str]) -> DataFrame:
    """doc_id, score_content, score_metadata, score, predicted of every row, from its whole text and its metadata.

    Null texts count as empty, null metadata as a value of its own; without labelled rows of both classes every row gets their rate (0.5
    if there are none). Null doc_ids and repeated rows are kept; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = shared.value.scores([content(batch["text"].tolist()), metadata(batch, columns)])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score_content": s[0], "score_metadata": s[1], "score": s[2], "predicted": (s[2] >= 0.5).astype("int32")})

    return long_rows(docs).select(F.col("doc_id").cast("long"), "text", *columns).mapInPandas(run, "doc_id long, score_content double, score_metadata double, score double, predicted int")
