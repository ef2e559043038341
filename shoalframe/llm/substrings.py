"""Substring dedup by recompression.

Documents travel in portions: some megabytes of rows as one compressed Arrow stream. In each portion, rounds of
recompression replace runs of a symbol, then pairs of adjacent symbols, by new symbols. A symbol's name is a hash of
what it stands for, so it is the same in every portion without a dictionary, and whether two neighbours are joined
depends on them alone: equal word sequences are parsed equally, but for symbols near their ends whose parse
hangs on words outside. Each symbol knows the words its parse hangs on (its context).

A window's anchor is a symbol of the highest level whose context lies in the window (of those, the smallest name), so equal
windows have equal anchors. Anchors are exchanged once; windows whose anchor another portion has as well are then verified: their own
96-bit names are exchanged, and the portions learn which windows start in a document with a smaller id.

Windows are told apart by these 96 bits, in a portion and between portions: among n distinct windows, about n * n / 2**97 pairs would be
taken for equal. The symbols' names only choose anchors, where a clash costs a comparison and changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exchange
from .hashing import Words, mix, runs
from .storage import long_rows, materialise, trim

WINDOW = 13
ROUNDS = 2
#: Bytes of text of a portion.
PORTION = 2 << 20
_FAR = 1 << 40
_A, _B, _C, _D = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xF1357AEA2E62A9C5))


class Parse:
    """One level: names, context names, and contexts [lo, hi) in words; doc: each symbol's document."""

    def __init__(self, names: np.ndarray, doc: np.ndarray):
        at = np.arange(len(names))
        self.name, self.context, self.lo, self.hi, self.doc = names, names, at, at + 1, doc

    def copy(self) -> Parse:
        out = Parse(self.name[:0], self.doc[:0])
        out._set(self.name, self.context, self.lo, self.hi, self.doc)
        return out

    def _set(self, name: np.ndarray, context: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray) -> None:
        self.name, self.context, self.lo, self.hi, self.doc = name, context, lo, hi, doc

    def _sides(self) -> tuple[np.ndarray, ...]:
        """Context names and contexts of each symbol's neighbours; none over the edge of a document."""
        apart = self.doc[1:] != self.doc[:-1]
        before, after = np.roll(self.context, 1), np.roll(self.context, -1)
        lo, hi = np.roll(self.lo, 1), np.roll(self.hi, -1)
        lo[0], hi[-1] = -_FAR, _FAR
        lo[1:][apart], hi[:-1][apart] = -_FAR, _FAR
        return before, after, lo, hi

    def join_runs(self) -> None:
        """A run of one symbol becomes one symbol; it hangs on both neighbours, which end the run."""
        if not len(self.name):
            return
        before, after, lo, hi = self._sides()
        first = np.flatnonzero(np.concatenate([[True], (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])]))
        size = np.diff(first, append=len(self.name))
        last = first + size - 1
        with np.errstate(over="ignore"):
            name = np.where(size > 1, mix(self.name[first] * _A + size.astype(np.uint64)), self.name[first])
            context = mix(before[first] * _B + name + after[last] * _C)
        self._set(name, context, lo[first], hi[last], self.doc[first])

    def join_pairs(self, level: int) -> None:
        """A symbol of the left class and a following one of the right class become one symbol."""
        if not len(self.name):
            return
        right = (mix(self.name + np.uint64(level * int(_D) % (1 << 64))) >> np.uint64(63)).astype(bool)
        before, after, lo, hi = self._sides()
        left = np.append(~right[:-1] & right[1:] & (self.doc[1:] == self.doc[:-1]), False)
        keep = np.flatnonzero(np.concatenate([[True], ~left[:-1]]))
        left, right = left[keep], right[keep]
        with np.errstate(over="ignore"):
            second = np.roll(self.name, -1)[keep]
            name = np.where(left, mix(self.name[keep] * _B + second * _C + np.uint64(level)), self.name[keep])
            own = self.context[keep]
            # alone, a left symbol hangs on the next one, a right symbol on the one before
            context = np.where(left | ~right, mix(own * _A + after[keep]), mix(before[keep] * _D + own))
        self._set(name, context, np.where(left | ~right, self.lo[keep], lo[keep]), np.where(left | ~right, hi[keep], self.hi[keep]), self.doc[keep])


def anchors(names: np.ndarray, doc: np.ndarray, starts: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """The anchor of each window; starts: its first word, ascending. Equal windows have equal anchors."""
    out = np.zeros(len(starts), np.uint64)
    open_ = np.ones(len(starts), bool)
    levels = [Parse(names, doc)]
    for r in range(1, rounds + 1):
        p = levels[-1].copy()
        p.join_runs()
        p.join_pairs(r)
        levels.append(p)
    for level in range(rounds, -1, -1):
        p = levels[level]
        fits = p.hi - p.lo <= window
        lo, hi, name = p.lo[fits], p.hi[fits], mix(p.context[fits] + np.uint64(level))
        if not len(lo):
            continue
        todo = np.flatnonzero(open_)
        at = starts[todo]
        # contexts ascend, so a window's symbols are those from the first that starts in it to the last that ends in it
        a = np.append(0, np.cumsum(np.bincount(lo, minlength=len(names) + 1)))[at]
        b = np.cumsum(np.bincount(hi, minlength=len(names) + 1))[at + window]
        some = a < b
        todo, a, b = todo[some], a[some], b[some]
        best = name[a]
        for k in range(1, int((b - a).max(initial=0))):
            more = a + k < b
            best = np.where(more, np.minimum(best, name[np.minimum(a + k, len(name) - 1)]), best)
        out[todo] = best
        open_[todo] = False
    return out


class Portion:
    """The words and windows of a portion's documents."""

    def __init__(self, rows: pa.Table, streams: int = 1):
        self.words = w = Words(rows["text"].to_pylist(), streams=streams)
        ids = rows["doc_id"].to_pandas().astype("Int64")
        self.null = ids.isna().to_numpy()
        self.ids = ids.fillna(0).to_numpy(np.int64)
        self.doc = np.repeat(np.arange(len(w), dtype=np.int32), w.counts)
        start = np.arange(len(self.doc))
        self.starts = start[(w.first + w.counts)[self.doc] - start >= WINDOW] if len(start) else start
        if len(self.starts):
            self.starts = self.starts[~self.null[self.doc[self.starts]]]
        self.of = self.doc[self.starts] if len(self.starts) else self.starts

    def anchors(self) -> np.ndarray:
        return anchors(self.words.names[0], self.doc, self.starts)

    def windows(self, stream: int) -> np.ndarray:
        return runs(self.words.names[stream], WINDOW, stream)[self.starts]


def _read(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def portions(docs: DataFrame) -> DataFrame:
    """portion, n_words (an upper bound), blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal n, held, size
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            row = pa.RecordBatch.from_pydict({"portion": [part << 32 | n], "n_words": [size // 5], "blob": [sink.getvalue().to_pybytes()]}, schema=pa.schema([("portion", pa.int64()), ("n_words", pa.int64()), ("blob", pa.binary())]))
            n, held, size = n + 1, [], 0
            return row

        for batch in batches:
            lengths = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            at = 0
            while at < batch.num_rows:
                room = PORTION - size + (lengths[at - 1] if at else 0)
                stop = max(at + 1, int(np.searchsorted(lengths, room, "right")))
                held.append(batch.slice(at, stop - at))
                size += int(lengths[stop - 1] - (lengths[at - 1] if at else 0))
                at = stop
                if size >= PORTION * 3 // 4:
                    yield flush()
        if held:
            yield flush()

    return docs.mapInArrow(run, "portion long, n_words long, blob binary")


def deduplicate(docs: DataFrame, keep: bool = False) -> DataFrame:
    """Removes each word that a window of 13 words covers which also starts in a document with a smaller doc_id.

    keep False: doc_id, n_words, n_removed, kept_sha256 of every row. keep True: the rows themselves, in all their
    columns, with the kept words as text; a text that loses nothing stays as it is. Null texts have no words (and
    stay null). A row with a null doc_id loses nothing and removes nothing; rows with equal doc_ids don't remove from each other. Documents of
    fewer than 13 words lose nothing. An empty table gives no rows.
    """
    docs = long_rows(docs)
    schema = docs.schema
    narrow = docs if keep else docs.select(F.col("doc_id").cast("long"), "text")
    columns = narrow.schema
    held = materialise(portions(narrow), "portions")
    words = held.agg(F.sum("n_words")).first()[0] or 0
    parts = exchange.ranges(words // 3)

    def out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for portion, blob in zip(batch["portion"], batch["blob"], strict=True):
                found = np.unique(Portion(_read(blob)).anchors())
                yield exchange.frame(list(exchange.send(np.array([portion], np.int64), np.zeros(len(found), np.int32), found, parts)))
                del found
                trim()

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        index, owners, names = exchange.unpack_all(group["blob"].tolist(), "i8", "u8")
        order = np.argsort(names, kind="stable")
        names, index = names[order], index[order]
        same = names[1:] == names[:-1]
        keep_ = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        names, index = names[keep_], index[keep_]
        order = np.argsort(index, kind="stable")
        names, index = names[order], index[order]
        cut = np.searchsorted(index, np.arange(len(owners) + 1))
        rows = [(o, names[cut[i] : cut[i + 1]].tobytes()) for i, o in enumerate(owners.tolist()) if cut[i] < cut[i + 1]]
        return pd.DataFrame(rows, columns=["portion", "names"])

    sent = held.select("portion", "blob").mapInPandas(out, "part int, blob binary")
    shared = sent.groupBy("part").applyInPandas(meet, "portion long, names binary")

    def verify(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for portion, blob in zip(left["portion"], left["blob"], strict=True):
            known = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in right["names"]])) if len(right) else np.zeros(0, np.uint64)
            if not len(known):
                continue
            p = Portion(_read(blob), streams=2)
            anchor = p.anchors()
            hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, anchor), len(known) - 1)] == anchor)
            one, two, ids = p.windows(0)[hit], (p.windows(1)[hit] >> np.uint64(32)).astype("u4"), p.ids[p.of[hit]]
            order = np.lexsort((ids, two, one))
            one, two, ids = one[order], two[order], ids[order]
            first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])) if len(one) else np.zeros(0, np.int64)
            one, two, ids = one[first], two[first], ids[first]
            rows += exchange.send(np.array([portion], np.int64), np.zeros(len(one), np.int32), one, parts, two, ids)
            del p, anchor, hit, one, two, ids, order, first
        trim()
        return exchange.frame(rows)

    def least(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        index, owners, one, two, ids = exchange.unpack_all(group["blob"].tolist(), "i8", "u8", "u4", "i8")
        order = np.lexsort((ids, two, one))
        one, two, ids, index = one[order], two[order], ids[order], index[order]
        first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        low = np.repeat(ids[first], np.diff(first, append=len(one)))
        later = np.flatnonzero(ids > low)
        later = later[np.argsort(index[later], kind="stable")]
        cut = np.searchsorted(index[later], np.arange(len(owners) + 1))
        rows = []
        for i, o in enumerate(owners.tolist()):
            if cut[i] < cut[i + 1]:
                at = later[cut[i] : cut[i + 1]]
                rows.append((o, one[at].tobytes(), two[at].tobytes(), low[at].tobytes()))
        return pd.DataFrame(rows, columns=["portion", "names", "more", "ids"])

    asked = held.select("portion", "blob").groupBy("portion").cogroup(shared.groupBy("portion")).applyInPandas(verify, "part int, blob binary")
    told = asked.groupBy("part").applyInPandas(least, "portion long, names binary, more binary, ids binary")

    def strip(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for blob in left["blob"].to_pylist():
            rows = _read(blob)
            names = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x, np.uint64) for x in right["names"].to_pylist()]])
            more = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(x, np.uint32) for x in right["more"].to_pylist()]])
            low = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x in right["ids"].to_pylist()]])
            tables.append(_stripped(rows, names, more, low, keep))
        trim()
        return pa.concat_tables(tables) if tables else _stripped(_empty(columns), np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64), keep)

    result = schema if keep else "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return held.select("portion", "blob").groupBy("portion").cogroup(told.groupBy("portion")).applyInArrow(strip, result)


def _empty(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def _stripped(rows: pa.Table, names: np.ndarray, more: np.ndarray, low: np.ndarray, keep: bool) -> pa.Table:
    """rows without the words to remove; names and more (a window's 96 bits), low: windows of smaller documents in other portions."""
    p = Portion(rows, streams=2)
    one, two, ids = p.windows(0), (p.windows(1) >> np.uint64(32)).astype(np.uint32), p.ids[p.of] if len(p.of) else np.zeros(0, np.int64)
    order = np.lexsort((ids, two, one))
    one, two, ids = one[order], two[order], ids[order]
    first = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]) if len(one) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    heads, rest, least = one[at], two[at], ids[at]
    if len(heads) and len(names):
        begin, end = np.searchsorted(heads, names), np.searchsorted(heads, names, "right")
        for k in range(int((end - begin).max())):  # windows that agree in 64 bits
            place = np.minimum(begin + k, len(heads) - 1)
            hit = (begin + k < end) & (rest[place] == more)
            np.minimum.at(least, place[hit], low[hit])
    covers = np.zeros(len(p.doc) + 1, np.int64)
    if len(one):
        doomed = p.starts[order][ids > least[group]]
        np.add.at(covers, doomed, 1)
        np.add.at(covers, doomed + WINDOW, -1)
    gone = np.cumsum(covers)[:-1] > 0
    w = p.words
    removed = np.add.reduceat(np.append(gone, False), np.minimum(w.first, len(gone))) if len(w) else np.zeros(0, np.int64)
    removed = np.where(w.counts > 0, removed, 0)
    texts = rows["text"].to_pylist() if keep else []
    sha = []
    for d, (f, n) in enumerate(zip(w.first.tolist(), w.counts.tolist(), strict=True)):
        if keep and not removed[d]:
            continue
        left = f + np.flatnonzero(~gone[f : f + n])
        kept = b" ".join([w.data[a:b] for a, b in zip(w.start[left].tolist(), w.end[left].tolist(), strict=True)])
        if keep:
            texts[d] = kept.decode()
        else:
            sha.append(hashlib.sha256(kept).hexdigest())
    if keep:
        i = rows.schema.get_field_index("text")
        return rows.set_column(i, rows.schema.field(i), pa.array(texts, rows.schema.field(i).type))
    return pa.table({"doc_id": rows["doc_id"], "n_words": pa.array(w.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})
