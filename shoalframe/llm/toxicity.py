"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as the embedding of its name and the summed embeddings of its character runs. The network reads
windows of 32 words, the last 8 of which the next one has too, attention pools a window's states, and a document scores as its
worst window, calibrated on the training documents. Training is multiple-instance: a document's label
holds for its worst window, through which the gradient goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import Words, mix, portions
from .storage import long_rows

#: Documents of each class that the network is trained on, with all their windows.
DOCS = 2000
WINDOW, STRIDE = 32, 24
#: Hash buckets of words and of character runs, lengths of the runs in bytes, and the network's widths.
NAMES, GRAMS, SIZES, WORD, CHAR, HIDDEN, ATTEND = 1 << 16, 1 << 16, (5, 7), 8, 6, 8, 8
EPOCHS, BATCH = 3, 48
#: Few documents are gone over more often, to so many steps.
STEPS = 150


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Texts:
    """The windows of some texts: `at` has each window's distinct words (the last index: none), `doc` its text."""

    def __init__(self, texts: list[str | None]):
        w = Words([t.lower() if t else t for t in texts], letters=True)
        names, first, which = np.unique(w.names[0], return_index=True, return_inverse=True)
        self.bucket = (names % np.uint64(NAMES)).astype(np.int64)
        # runs of a word start at each of its bytes and at the space before, and end with the word at the latest
        size = w.end[first] - w.start[first] + 1
        self.cut = np.cumsum(size) - size
        place = np.repeat(w.start[first] - self.cut, size) + np.arange(int(size.sum())) - 1
        left = np.repeat(w.end[first], size) - place
        buf = np.frombuffer(w.data, np.uint8)
        runs, h = [], np.zeros(len(place), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(max(SIZES)):
                byte = buf[np.minimum(place + k, len(buf) - 1)].astype(np.uint64) if k else np.where(np.arange(len(place)) == np.repeat(self.cut, size), 0, buf[place]).astype(np.uint64)
                h = np.where(k < left, h * np.uint64(0x100000001B3) + byte + np.uint64(1), h)
                if k + 1 in SIZES:
                    runs.append((mix(h + np.uint64(k)) % np.uint64(GRAMS)).astype(np.int64))
        self.grams = np.stack(runs, 1) if len(place) else np.zeros((0, len(SIZES)), np.int64)
        count = w.counts
        n = np.where(count > 0, np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1), 0)
        self.doc = np.repeat(np.arange(len(w)), n)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(n) - n, n)
        begin = np.minimum(nth * STRIDE, np.maximum(count[self.doc] - WINDOW, 0))
        at = (w.first[self.doc] + begin)[:, None] + np.arange(WINDOW)
        inside = (begin[:, None] + np.arange(WINDOW)) < count[self.doc][:, None]
        self.at = np.where(inside, which[np.minimum(at, len(which) - 1)] if len(which) else 0, len(names)).astype(np.int32)
        self.n = len(w)


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        width = WORD + CHAR
        g = lambda *s: (r.standard_normal(s) * (0.6 / np.sqrt(s[0]))).astype(np.float32)
        self.p = {
            "word": (r.standard_normal((NAMES, WORD)) * 0.1).astype(np.float32),
            "char": (r.standard_normal((GRAMS, CHAR)) * 0.03).astype(np.float32),
            "attend": g(2 * HIDDEN, ATTEND),
            "query": g(ATTEND, 1)[:, 0],
            "out": g(2 * HIDDEN, 1)[:, 0],
            "bias": np.zeros(1, np.float32),
        }
        for d in "fb":
            self.p |= {f"x{d}": g(width, 3 * HIDDEN), f"h{d}": g(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.scale, self.shift = 1.0, 0.0
        self.base = 0.0

    def inputs(self, t: Texts) -> np.ndarray:
        """An input row for each distinct word."""
        if not len(t.bucket):
            return np.zeros((0, WORD + CHAR), np.float32)
        chars = sum(np.add.reduceat(self.p["char"][t.grams[:, k]], t.cut) for k in range(len(SIZES)))
        return np.concatenate([self.p["word"][t.bucket], chars], 1)

    def _direction(self, d: str, x: np.ndarray, mask: np.ndarray, trace: list | None) -> np.ndarray:
        """States (time, window, HIDDEN); x: projected inputs (time, window, 3 * HIDDEN)."""
        T, B, _ = x.shape
        h, out, u = np.zeros((B, HIDDEN), np.float32), np.empty((T, B, HIDDEN), np.float32), self.p[f"h{d}"]
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            g = h @ u
            zr = _sigmoid(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if trace is not None:
                trace.append((t, h, z, r, n, g[:, 2 * HIDDEN :]))
            h = np.where(mask[t][:, None], new, h)
            out[t] = h
        return out

    def forward(self, at: np.ndarray, rows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """The logit of each window; at indexes rows, the distinct words' inputs."""
        idx = at.T
        mask = idx < len(rows)
        states, seen = [], {}
        padded = np.concatenate([rows, np.zeros((1, rows.shape[1]), np.float32)])
        for d in "fb":
            projected = padded @ self.p[f"x{d}"] + self.p[f"b{d}"]
            seen[d] = [] if keep else None
            states.append(self._direction(d, projected[idx], mask, seen[d]))
        s = np.concatenate(states, 2)
        a = np.tanh(s @ self.p["attend"])
        e = np.where(mask, a @ self.p["query"], -1e9)
        e = np.exp(e - e.max(0))
        e /= e.sum(0)
        pooled = (e[:, :, None] * s).sum(0)
        return pooled @ self.p["out"] + self.p["bias"][0], {"s": s, "a": a, "e": e, "pooled": pooled, "mask": mask, "idx": idx, "padded": padded} | seen if keep else {}

    def backward(self, grad: np.ndarray, c: dict) -> dict:
        """Gradients for d loss / d logit; `rows` is that of the words' inputs."""
        p, out = self.p, {}
        out["out"], out["bias"] = c["pooled"].T @ grad, np.array([grad.sum()])
        dp = grad[:, None] * p["out"]
        ds = c["e"][:, :, None] * dp
        de = (c["s"] * dp).sum(2)
        de = c["e"] * (de - (c["e"] * de).sum(0))
        out["query"] = np.einsum("tb,tba->a", de, c["a"])
        da = de[:, :, None] * p["query"] * (1 - c["a"] ** 2)
        out["attend"] = np.einsum("tbs,tba->sa", c["s"], da)
        ds += da @ p["attend"].T
        rows = np.zeros_like(c["padded"])
        for k, d in enumerate("fb"):
            dh, u = np.zeros_like(ds[0, :, :HIDDEN]), p[f"h{d}"]
            out[f"h{d}"], dx = np.zeros_like(u), np.zeros((*c["idx"].shape, 3 * HIDDEN), np.float32)
            for t, h, z, r, n, gn in reversed(c[d]):
                dh = dh + ds[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                live = c["mask"][t][:, None]
                new = np.where(live, dh, 0)
                dz, dn = new * (h - n) * z * (1 - z), new * (1 - z) * (1 - n * n)
                dr = dn * gn * r * (1 - r)
                dg = np.concatenate([dz, dr, dn * r], 1)
                dx[t] = np.concatenate([dz, dr, dn], 1)
                out[f"h{d}"] += h.T @ dg
                dh = np.where(live, new * z + dg @ u.T, dh)
            flat = dx.reshape(-1, 3 * HIDDEN)
            index = c["idx"].reshape(-1)
            out[f"x{d}"], out[f"b{d}"] = c["padded"][index].T @ flat, flat.sum(0)
            np.add.at(rows, index, flat @ p[f"x{d}"].T)
        out["rows"] = rows[:-1]
        return out

    def logits(self, t: Texts, rows: np.ndarray | None = None, block: int = 4096) -> np.ndarray:
        rows = self.inputs(t) if rows is None else rows
        return np.concatenate([np.zeros(0, np.float32), *[self.forward(t.at[i : i + block], rows)[0] for i in range(0, len(t.at), block)]])

    def worst(self, t: Texts) -> np.ndarray:
        """The largest logit of each text; without words, that of no window."""
        out = np.full(t.n, -np.inf)
        np.maximum.at(out, t.doc, self.logits(t))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for at, part in portions(texts, 1 << 20):
            worst = self.worst(Texts(part))
            some = np.isfinite(worst)
            out[at : at + len(part)] = np.where(some, _sigmoid(self.scale * np.where(some, worst, 0) + self.shift), self.base)
        return out


def _summed(index: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and each one's sum of gradients."""
    order = np.argsort(index, kind="stable")
    rows, first = np.unique(index[order], return_index=True)
    return rows, np.add.reduceat(grads[order], first) if len(rows) else grads


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """With one class only, a network that gives every text that class' rate."""
    net, y, r = Network(seed), np.array(labels, float), np.random.default_rng(seed)
    net.base = 0.0
    if len(set(labels)) < 2:
        net.scale, net.shift = 0.0, 20.0 if labels and labels[0] else -20.0
        net.base = float(bool(labels and labels[0]))
        return net
    # the first coordinates start as the log odds of words and character runs among the classes' documents
    seen = {k: np.full((2, n), 0.5) for k, n in (("word", NAMES), ("char", GRAMS))}
    for i in range(len(texts)):
        t = Texts(texts[i : i + 1])
        seen["word"][int(y[i]), np.unique(t.bucket)] += 1
        seen["char"][int(y[i]), np.unique(t.grams)] += 1
    for k, n in seen.items():
        odds = np.log(n[1] / (1 + y.sum())) - np.log(n[0] / (1 + (1 - y).sum()))
        net.p[k][:, 0] = np.where(n.sum(0) >= 4, np.clip(odds, -4, 4) / 4, 0)
    m, v = {k: np.zeros_like(x) for k, x in net.p.items()}, {k: np.zeros_like(x) for k, x in net.p.items()}
    step = 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(texts)))):
        order = r.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            t = Texts([texts[j] for j in pick])
            if not len(t.at):
                continue
            rows = net.inputs(t)
            logit = net.logits(t, rows)
            # the worst window of each document, and another one of the harmless
            by = np.lexsort((-logit, t.doc))
            head = by[np.flatnonzero(np.diff(t.doc[by], prepend=-1))]
            clean = np.flatnonzero(y[pick][t.doc] == 0)
            chosen = np.concatenate([head, r.choice(clean, min(len(clean), len(head) // 2), replace=False)]) if len(clean) else head
            words, at = np.unique(t.at[chosen], return_inverse=True)
            words = words[words < len(rows)]
            at = at.reshape(len(chosen), WINDOW)
            out, cache = net.forward(at, rows[words], True)
            grads = net.backward(((_sigmoid(out) - y[pick][t.doc[chosen]]) / len(chosen)).astype(np.float32), cache)
            dense = grads.pop("rows")
            size = np.append(t.cut[1:], len(t.grams))[words] - t.cut[words]
            which = np.repeat(np.arange(len(words)), size)
            place = t.cut[words][which] + np.arange(len(which)) - (np.cumsum(size) - size)[which]
            tables = {"word": (t.bucket[words], dense[:, :WORD]), "char": (t.grams[place].reshape(-1), np.repeat(dense[which, WORD:], len(SIZES), 0))}
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for k in net.p:
                # of the tables, only the rows that were met move
                at, g = _summed(*tables[k]) if k in tables else (slice(None), grads[k])
                m[k][at] += 0.1 * (g - m[k][at])
                v[k][at] += 0.01 * (g * g - v[k][at])
                net.p[k][at] -= (rate * m[k][at] / (np.sqrt(v[k][at]) + 1e-7)).astype(np.float32)
    # calibration of the documents' worst windows
    worst = np.concatenate([net.worst(Texts(texts[i : i + 64])) for i in range(0, len(texts), 64)])
    ok = np.isfinite(worst)
    x, y = worst[ok], y[ok]
    a, b = 1.0, 0.0
    for _ in range(300):
        q = _sigmoid(a * x + b) - y
        a, b = a - 0.3 * ((q * x).mean() + 0.01 * (a - 1)), b - 0.3 * q.mean()
    net.scale, net.shift = float(max(a, 0.05)), float(b)
    return net


def learn(docs: DataFrame, labels: DataFrame, train_rows: object, per_class: int = DOCS) -> Network:
    """Trains on at most `per_class` labelled documents of each class, drawn by a hash of the doc_id. Of rows that share a doc_id one
    counts, with the greatest text and label."""
    known = labels.filter(train_rows).filter("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("hash", F.xxhash64("doc_id", F.lit("toxic")))
    counts = known.agg(F.sum("toxic"), F.count("*")).first()
    share = [max(1, round(min(1.0, 4 * per_class / max(1, n)) * (1 << 40))) for n in ((counts[1] or 0) - (counts[0] or 0), counts[0] or 0)]
    # of each class, about four times as many rows as are wanted are ranked, however many there are
    few = known.filter(F.pmod("hash", F.lit(1 << 40)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    by = Window.partitionBy("toxic").orderBy("hash", "doc_id")
    some = few.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= per_class).select("doc_id", "toxic", "n")
    # at most 2 * per_class rows, as one counts of those that share a doc_id
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("n", "toxic", "doc_id").agg(F.max("text").alias("text"))
    rows = rows.orderBy("n", "toxic", "doc_id").collect()
    rows = [r for r in rows if r["text"]]
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def scores(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score, predicted of every row, from all windows of its whole text.

    Null, empty and wordless texts score as harmless (as the only class, if there was one). Null doc_ids and repeated rows
    are kept; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = net.score(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": s, "predicted": (s >= 0.5).astype("int32")})

    return long_rows(docs).select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, score double, predicted int")
