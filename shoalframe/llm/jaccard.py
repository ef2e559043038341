"""N-gram Jaccard join by a count-vector R-tree.

Documents with equal shingle sets form a class. Only shingles that several classes share can be in an overlap, so
the shingles' names are exchanged once, and a class stays a candidate only if enough of its shingles are shared
(an exact condition). Classes that share one of their rarest shingles form a family; every link lies in one.

Within a family, a class is the point of its shingle counts by hash group. The points are sorted and cut into
blocks, each with its bounding box; the overlap of any two classes is at most the sum of the smaller counts, and
that of any two boxes at most the sum of the smaller upper bounds. Pairs of blocks that pass the bound are joined by
an R-tree over their points, and pairs that pass it there are verified on their shingles, unless already connected.

Shingles are known by 64-bit names throughout. Among n distinct shingles, about n * n / 2**65 pairs share a name; that
changes an overlap by one where two documents hold one each of such a pair. Classes are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exchange
from .components import Forest, components
from .hashing import Words, mix, portions, runs
from .storage import long_rows, materialise, trim

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
GROUPS = 32
#: Points of a block, and of a leaf of its tree.
BLOCK, LEAF, FANOUT = 512, 8, 8
#: Shingles of a block's classes, about, and of a pair of blocks that shares its task with others.
WEIGHT, LIGHT = 1 << 20, 1 << 16
SALTS = 8
#: Characters of a portion's texts, and a word's with its space.
PORTION, CHARS = 4 << 20, 6
#: Classes of a portion whose numbers travel with a name they share.
FEW = 8


def shingles(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles, as sorted 64-bit names; a text with fewer words has one of all of them."""
    words = Words(texts, lower=True)
    names = words.names[0]
    full = runs(names, size)
    out = []
    for first, n in zip(words.first.tolist(), words.counts.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(full[first : first + n - size + 1]))
        else:
            out.append(runs(names[first : first + n], n)[:1] if n else names[:0])
    return out


def class_of(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


class Manifest:
    """What a portion's tasks need to know of it: its documents (id, null or not, set size, class or -1), its classes (digest, size),
    and the owners of the names that many of its classes have."""

    def __init__(self, ids: list, n: list[int], own: list[int], found: dict[bytes, np.ndarray], many: np.ndarray, owners: list[np.ndarray]):
        null = np.array([i is None or i is pd.NA for i in ids], np.uint8)
        self.ids = np.array([0 if z else i for i, z in zip(ids, null, strict=True)], np.int64)
        self.null, self.n, self.own = null, np.array(n, np.int64), np.array(own, np.int32)
        self.digests, self.sizes = list(found), np.array([len(s) for s in found.values()], np.int64)
        self.many, self.counts = many.astype(np.uint64), np.array([len(o) for o in owners], np.int64)
        self.owners = np.concatenate([np.zeros(0, np.int32), *owners]).astype(np.int32)

    def pack(self) -> bytes:
        parts = (self.ids, self.null, self.n, self.own, self.sizes, self.many, self.counts, self.owners)
        return b"".join([np.array([len(self.ids), len(self.sizes), len(self.many), len(self.owners)], np.int64).tobytes(), *[x.tobytes() for x in parts], *self.digests])

    @classmethod
    def unpack(cls, raw: bytes) -> Manifest:
        out, at = cls.__new__(cls), 32
        docs, classes, many, owners = np.frombuffer(raw, np.int64, 4).tolist()
        for name, kind, n in (("ids", "i8", docs), ("null", "u1", docs), ("n", "i8", docs), ("own", "i4", docs), ("sizes", "i8", classes), ("many", "u8", many), ("counts", "i8", many), ("owners", "i4", owners)):
            value = np.frombuffer(raw, kind, n, at)
            setattr(out, name, value)
            at += value.nbytes
        out.digests = [raw[at + 16 * i : at + 16 * i + 16] for i in range(classes)]
        return out


def _low(names: np.ndarray) -> np.ndarray:
    """The low 7 bytes of each name."""
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]


def _names(low: bytes) -> np.ndarray:
    out = np.zeros((len(low) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(low, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def _spread(counts: np.ndarray) -> np.ndarray:
    """Each group's number, as often as the group has items."""
    return np.repeat(np.arange(len(counts)), counts)


def gathered(docs: DataFrame, parts: int) -> DataFrame:
    """A row for each document (doc: true; doc_id, n_shingles, cls, null for an empty set), and one (doc: false; cls, n, tokens, c) for
    each class of a portion of which enough shingles are in other classes too: tokens packed, the rarest first, c their counts by group.

    The texts are cut into shingles once. A portion sends each name once, whole: its range of names (at least a byte's worth) and its
    other 7 bytes. Names of at most FEW of the portion's classes carry these classes' numbers; the others' stay in the portion's
    manifest, so that a name's range gets a few bytes of it from each portion at most, however many documents have it. A class
    that several portions have comes out several times, alike.
    """
    bits = parts.bit_length() - 1

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        portion = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, texts in portions(batch["text"], PORTION):
                ids = batch["doc_id"].astype("Int64").iloc[at : at + len(texts)].tolist()
                found: dict[bytes, np.ndarray] = {}
                number: dict[bytes, int] = {}
                n, own = [], []
                for first, part in portions(texts, 1 << 20):
                    for i, s in zip(ids[first : first + len(part)], shingles(part), strict=True):
                        n.append(len(s))
                        cls = class_of(s) if len(s) else None
                        own.append(-1 if cls is None or i is pd.NA else number.setdefault(cls, len(number)))
                        if own[-1] >= 0:
                            found.setdefault(cls, s)
                kind = np.uint16 if len(found) <= 1 << 16 else np.uint32
                owner = np.repeat(np.arange(len(found), dtype=kind), [len(s) for s in found.values()])
                names = np.concatenate([np.zeros(0, np.uint64), *found.values()])
                order = np.argsort(names, kind="stable")
                names, owner = names[order], owner[order]
                head = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
                many = np.diff(head, append=len(names))
                wide = np.flatnonzero(many > FEW)
                manifest = Manifest(ids, n, own, found, names[head[wide]], [owner[head[w] : head[w] + many[w]] for w in wide.tolist()]).pack()
                # within a range, by the first class: the classes' numbers then ascend, which compresses
                range_ = names[head] >> np.uint64(64 - bits)
                order = np.lexsort((owner[head], range_))
                head, many, range_ = head[order], many[order], range_[order].astype(np.int64)
                carried = np.where(many > FEW, 0, many)
                edge = np.append(np.flatnonzero(np.diff(range_, prepend=-1)), len(head))
                rows = []
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    which = _spread(carried[a:b])
                    nth = np.arange(len(which)) - (np.cumsum(carried[a:b]) - carried[a:b])[which]
                    rows.append((int(range_[a]), portion, owner.dtype.str[1:], _low(names[head[a:b]]).tobytes(), many[a:b].astype(np.uint32).tobytes(), owner[head[a:b][which] + nth].tobytes(), None))
                rows = rows or [(portion % parts, portion, "u2", b"", b"", b"", None)]
                carrier = (portion * 0x9E3779B97F4A7C15 >> 40) % len(rows)  # another range for each portion
                rows[carrier] = (*rows[carrier][:6], manifest)
                del found, names, owner, head, order, range_, many, carried, manifest
                yield pd.DataFrame(rows, columns=["part", "portion", "kind", "low", "many", "idx", "manifest"])
                portion += 1
                del rows
                trim()

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        names = _names(b"".join(group["low"]))
        if bits > 8:  # bits of the range that the 7 bytes repeat are alike for the whole group
            names = names & np.uint64((1 << (64 - bits)) - 1)
        many = np.frombuffer(b"".join(group["many"]), np.uint32)
        order = np.argsort(names)
        head = np.flatnonzero(np.concatenate([[True], names[order][1:] != names[order][:-1]])) if len(names) else np.zeros(0, np.int64)
        sums = np.add.reduceat(many[order].astype(np.int64), head) if len(head) else head
        often = np.empty(len(names), np.uint16)  # only orders the tokens, and is cut alike for all of them
        often[order] = np.repeat(np.minimum(sums, 65535), np.diff(head, append=len(names)))
        del order, head, sums
        rows, at = [], 0
        for r in group.itertuples():
            m = len(r.low) // 7
            keep, own = often[at : at + m] > 1, many[at : at + m]
            idx = np.frombuffer(r.idx, r.kind)[np.repeat(keep, np.where(own > FEW, 0, own))]
            if r.manifest or keep.any():
                rows.append((r.portion, r.part, r.kind, _low(_names(r.low)[keep]).tobytes(), own[keep].tobytes(), idx.tobytes(), often[at : at + m][keep].tobytes(), r.manifest))
            at += m
        del names, many, often
        trim()
        return pd.DataFrame(rows, columns=["portion", "part", "kind", "low", "many", "idx", "often", "manifest"])

    def gather(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        m = Manifest.unpack(next(x for x in group["manifest"] if x))
        names = _names(b"".join(group["low"])) & np.uint64((1 << (64 - bits)) - 1)
        names |= np.repeat(group["part"].to_numpy(np.uint64), [len(x) // 7 for x in group["low"]]) << np.uint64(64 - bits)
        many, often = np.frombuffer(b"".join(group["many"]), np.uint32), np.frombuffer(b"".join(group["often"]), np.uint16)
        carried = np.where(many > FEW, 0, many)
        index = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r.idx, r.kind).astype(np.int64) for r in group.itertuples()]])
        wide = np.flatnonzero(many > FEW)
        place = np.searchsorted(m.many, names[wide])  # each of them is there
        first = np.cumsum(m.counts) - m.counts
        which = wide[_spread(m.counts[place])]
        nth = np.arange(len(which)) - np.repeat(np.cumsum(m.counts[place]) - m.counts[place], m.counts[place])
        index = np.concatenate([index, m.owners[np.repeat(first[place], m.counts[place]) + nth]])
        which = np.concatenate([_spread(carried), which])
        size = len(m.sizes)
        enough = 100 * np.bincount(index, minlength=size) >= PERCENT * m.sizes
        keep = enough[index]
        index, tokens, often = index[keep], names[which[keep]], often[which[keep]]
        order = np.lexsort((tokens, often, index))
        index, tokens = index[order], tokens[order]
        cut_ = np.searchsorted(index, np.arange(size + 1))
        rows = [(True, None if z else i, n, m.digests[k] if k >= 0 else None, None, None, None) for i, z, n, k in zip(m.ids.tolist(), m.null.tolist(), m.n.tolist(), m.own.tolist(), strict=True)]
        for k in np.flatnonzero(enough).tolist():
            t = tokens[cut_[k] : cut_[k + 1]]
            rows.append((False, None, None, m.digests[k], int(m.sizes[k]), t.tobytes(), counts(t).tolist()))
        del names, many, often, index, which, tokens
        trim()
        out = pd.DataFrame(rows, columns=["doc", "doc_id", "n_shingles", "cls", "n", "tokens", "c"])
        return out.astype({"doc": bool, "doc_id": "Int64", "n_shingles": "Int64", "n": "Int64"})

    sent = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, "part int, portion long, kind string, low binary, many binary, idx binary, manifest binary")
    met = sent.groupBy("part").applyInPandas(meet, "portion long, part int, kind string, low binary, many binary, idx binary, often binary, manifest binary")
    return met.groupBy("portion").applyInPandas(gather, "doc boolean, doc_id long, n_shingles long, cls binary, n long, tokens binary, c array<int>")


def counts(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((tokens >> np.uint64(17)).astype(np.int64) % GROUPS, minlength=GROUPS)


class Tree:
    """An R-tree over count vectors, packed in the given order: levels of (low size, high counts, children)."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        self.sizes, self.points = sizes, points
        starts = np.arange(0, len(sizes), LEAF)
        small, large, top = np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts), np.maximum.reduceat(points, starts)
        self.levels = [(small, large, top, starts, np.append(starts[1:], len(sizes)))]
        while len(small) > 1:
            starts = np.arange(0, len(small), FANOUT)
            ends = np.append(starts[1:], len(small))
            small, large, top = np.minimum.reduceat(small, starts), np.maximum.reduceat(large, starts), np.maximum.reduceat(top, starts)
            self.levels.append((small, large, top, starts, ends))


def _may(small_a: np.ndarray, large_a: np.ndarray, top_a: np.ndarray, small_b: np.ndarray, large_b: np.ndarray, top_b: np.ndarray) -> np.ndarray:
    """For aligned rows of two trees' nodes: whether some pair within may link."""
    bound = np.minimum(top_a, top_b).sum(1)
    return ((100 + PERCENT) * bound >= PERCENT * (small_a + small_b)) & (100 * large_b >= PERCENT * small_a) & (100 * large_a >= PERCENT * small_b)


def candidates(a: Tree, b: Tree | None) -> Iterator[tuple[int, int]]:
    """Pairs of points that pass the bound, b None: of one tree with itself, each pair once."""
    own = b is None
    b = b or a
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    pairs = np.zeros((1, 2), np.int64)
    while True:
        sa, ga, ta, *ca = a.levels[la]
        sb, gb, tb, *cb = b.levels[lb]
        x, y = pairs[:, 0], pairs[:, 1]
        pairs = pairs[_may(sa[x], ga[x], ta[x], sb[y], gb[y], tb[y])]
        if not len(pairs):
            return
        down_a, down_b = (la >= lb or own), (lb >= la or own)
        lo_a, hi_a = (ca[0], ca[1]) if down_a else (np.arange(len(sa)), np.arange(1, len(sa) + 1))
        lo_b, hi_b = (cb[0], cb[1]) if down_b else (np.arange(len(sb)), np.arange(1, len(sb) + 1))
        na, nb = (hi_a - lo_a)[pairs[:, 0]], (hi_b - lo_b)[pairs[:, 1]]
        which = np.repeat(np.arange(len(pairs)), na * nb)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        x = lo_a[pairs[which, 0]] + nth // nb[which]
        y = lo_b[pairs[which, 1]] + nth % nb[which]
        pairs = np.stack([x, y], 1)
        if own:
            pairs = pairs[pairs[:, 0] < pairs[:, 1]] if la == 0 else pairs[pairs[:, 0] <= pairs[:, 1]]
        la, lb = la - down_a, lb - down_b
        if la < 0:  # the higher tree descends alone first, so both reach their points together
            break
    x, y = pairs[:, 0], pairs[:, 1]
    ok = _may(a.sizes[x], a.sizes[x], a.points[x], b.sizes[y], b.sizes[y], b.points[y])
    yield from zip(x[ok].tolist(), y[ok].tolist(), strict=True)


def join_blocks(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]] | None) -> list[tuple[int, int]]:
    """A spanning forest of the links within left, or between left and right. Items: (id, size, sorted tokens)."""
    forest, out = Forest(), []
    sides = [left, right if right is not None else left]
    trees = [Tree(np.array([i[1] for i in s]), np.array([counts(i[2]) for i in s])) for s in (sides[:1] if right is None else sides)]
    for x, y in candidates(trees[0], trees[1] if right is not None else None):
        a, b = sides[0][x], sides[1][y]
        if forest.root(a[0]) != forest.root(b[0]):
            both = len(np.intersect1d(a[2], b[2], assume_unique=True))
            if 100 * both >= PERCENT * (a[1] + b[1] - both):
                forest.join(a[0], b[0])
                out.append((a[0], b[0]))
    return out


def blocks(batches: Iterator[pd.DataFrame], most: int, heavy: int) -> Iterator[pd.DataFrame]:
    """Numbers the blocks of each family in a partition, which is sorted by family: of at most `most` classes and about `heavy` shingles."""
    from pyspark import TaskContext

    part, last, block, size, weight = TaskContext.get().partitionId(), None, -1, 0, 0
    for batch in batches:
        out = []
        for family, n in zip(batch["family"].tolist(), batch["n"].tolist(), strict=True):
            if family != last or size >= most or weight + n > heavy:
                block, size, weight = (block + 1 if family == last else 0), 0, 0
            last, size, weight = family, size + 1, weight + n
            out.append(block)
        yield batch[["family", "id", "n", "c"]].assign(part=part, block=out)


def chained(tokens: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A spanning forest (a, b) of the ids that share a token; both sorted by token, then id."""
    same = np.flatnonzero((tokens[1:] == tokens[:-1]) & (ids[1:] != ids[:-1]))
    forest, out = Forest(), []
    for a, b in np.unique(np.stack([ids[same], ids[same + 1]], 1), axis=0).tolist():
        if forest.join(a, b):
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the classes (id, n, tokens, c) as all links between them would."""
    spark = classes.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Packed (token, id), one id for each token of a batch; the others are chained to it here."""
        for batch in batches:
            found = [(i, mix(np.frombuffer(raw, np.uint64))) for i, raw in zip(batch["id"], batch["tokens"], strict=True)]
            found = [(i, t[: max(0, len(t) + (-PERCENT * n // 100) + 1)]) for (i, t), n in zip(found, batch["n"], strict=True)]
            tokens = np.concatenate([np.zeros(0, np.uint64), *[t for _, t in found]])
            ids = np.repeat(np.array([i for i, _ in found], np.int64), [len(t) for _, t in found])
            order = np.lexsort((ids, tokens))
            tokens, ids = tokens[order], ids[order]
            edges = chained(tokens, ids)
            head = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
            rows = list(exchange.send(np.zeros(1, np.int64), np.zeros(len(head), np.int32), tokens[head], spread, ids[head]))
            yield exchange.frame(rows).assign(edges=[edges.tobytes() if not i else b"" for i in range(len(rows))])

    def chain(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, _, tokens, ids = exchange.unpack_all(group["blob"].tolist(), "i8", "u8", "i8")
        order = np.lexsort((ids, tokens))
        edges = np.concatenate([chained(tokens[order], ids[order]), *[np.frombuffer(e, np.int64).reshape(-1, 2) for e in group["edges"]]])
        return pd.DataFrame(edges, columns=["a", "b"])

    spread = exchange.ranges(exchange.RANGE * parts)
    rare = classes.mapInPandas(prefixes, "part int, blob binary, edges binary")
    family = components(rare.groupBy("part").applyInPandas(chain, "a long, b long")).withColumnRenamed("component", "family")
    family = materialise(family, "families")

    # blocks in the order of the index: by size, which bounds the overlap most, then by the leading counts. A family may hold most
    # classes: it is cut by ranges of that order, and no task sees more of it than its range.
    key = ["family", "n", *[F.col("c")[g] for g in range(4)], "id"]
    place = classes.select("id", "n", "c").join(family, "id").repartitionByRange(parts, *key).sortWithinPartitions(*key)
    most, heavy = BLOCK, WEIGHT
    place = materialise(place.mapInPandas(lambda batches: blocks(batches, most, heavy), "family long, id long, n long, c array<int>, part int, block long"), "points")
    high = F.array(*[F.max(F.col("c")[g]) for g in range(GROUPS)]).alias("top")
    boxes = place.groupBy("family", "part", "block").agg(F.min("n").alias("small"), F.max("n").alias("large"), F.sum("n").alias("weight"), high)
    boxes = materialise(boxes, "boxes")
    high = F.array(*[F.max(F.col("top")[g]) for g in range(GROUPS)]).alias("top")
    spans = boxes.groupBy("family", "part").agg(F.min("small").alias("small"), F.max("large").alias("large"), high)

    def may(x: str, y: str) -> Column:
        """x comes before y, or is y."""
        bound = F.aggregate(F.zip_with(f"{x}.top", f"{y}.top", lambda p, q: F.least(p, q).cast("long")), F.lit(0).cast("long"), lambda s, v: s + v)
        return (F.lit(100 + PERCENT) * bound >= PERCENT * (F.col(f"{x}.small") + F.col(f"{y}.small"))) & (100 * F.col(f"{x}.large") >= PERCENT * F.col(f"{y}.small"))

    x, y = spans.alias("x"), spans.alias("y")
    upper = x.join(y, (F.col("x.family") == F.col("y.family")) & (F.col("x.part") <= F.col("y.part")) & may("x", "y"))
    upper = upper.select(F.col("x.family").alias("family"), F.col("x.part").alias("p"), F.col("y.part").alias("q"))
    x, y = boxes.alias("x"), boxes.alias("y")
    ordered = (F.col("u.p") < F.col("u.q")) | (F.col("x.block") <= F.col("y.block"))
    pairs = upper.alias("u").join(x, (F.col("u.family") == F.col("x.family")) & (F.col("u.p") == F.col("x.part")))
    pairs = pairs.join(y, (F.col("u.family") == F.col("y.family")) & (F.col("u.q") == F.col("y.part")) & ordered & may("x", "y"))
    # small pairs share a task; each heavy one, of two blocks at most, has its own
    name = F.xxhash64("u.family", "p", "x.block", "q", "y.block")
    task = F.when(F.col("x.weight") + F.col("y.weight") > LIGHT, name).otherwise(F.pmod(name, F.lit(16 * parts)))
    pairs = pairs.select(F.col("u.family").alias("family"), "p", F.col("x.block").alias("i"), "q", F.col("y.block").alias("j"), task.alias("task"))
    side = F.explode(F.array_distinct(F.array(F.struct(F.col("p").alias("part"), F.col("i").alias("block")), F.struct(F.col("q").alias("part"), F.col("j").alias("block")))))
    sides = pairs.select("*", side.alias("s")).select("family", "p", "i", "q", "j", "task", "s.part", "s.block")
    wanted = place.select("id", "family", "part", "block").join(sides, ["family", "part", "block"])
    sent = classes.select("id", "n", "tokens").join(wanted, "id")

    def verify(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, p, i, q, j), rows in group.groupby(["family", "p", "i", "q", "j"], sort=False):
            rows = rows.sort_values(["n", "id"])
            at = list(zip(rows["part"], rows["block"], strict=True))
            items = [(r.id, r.n, np.sort(np.frombuffer(r.tokens, np.uint64))) for r in rows.itertuples()]
            left = [x for x, k in zip(items, at, strict=True) if k == (p, i)]
            right = None if (p, i) == (q, j) else [x for x, k in zip(items, at, strict=True) if k == (q, j)]
            out += join_blocks(left, right)
        trim()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return sent.select("task", "family", "p", "i", "q", "j", "part", "block", "id", "n", "tokens").groupBy("task").applyInPandas(verify, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text).

    Null or wordless texts have the empty set, which links with nothing. Rows with equal sets link. doc_ids should
    be unique; rows that repeat one are each returned. A row with a null doc_id has a null component_id and takes no
    part in others' components. Other columns are ignored; an empty table gives no rows.
    """
    docs = long_rows(docs)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = min(max(1 << 8, exchange.ranges(chars // CHARS)), 1 << 23)
    found = materialise(gathered(docs, parts), "sets")
    own = found.filter("doc").select("doc_id", "n_shingles", "cls")
    dups = own.filter("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("most"))
    classes = materialise(dups, "classes")
    shared = found.filter("not doc").select("cls", "n", "tokens", "c").dropDuplicates(["cls"]).join(classes.select("cls", "id"), "cls").select("id", "n", "tokens", "c")
    edges = links(materialise(shared, "candidates"))
    linked = components(edges)
    final = classes.join(linked, "id", "left").select("cls", F.coalesce("component", "id").alias("component_id"), (F.col("id") < F.col("most")).alias("copied"), "id")
    # only classes of several documents, or linked ones, differ from the document's own id; the salt splits a large class
    final = final.filter("copied or component_id <> id").select("cls", "component_id").withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(SALTS)])))
    out = own.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(final, ["cls", "salt"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
