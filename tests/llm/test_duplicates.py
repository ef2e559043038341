import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoalframe.llm import components as components_module
from shoalframe.llm import embeddings, jaccard, substrings
from shoalframe.llm.components import components


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def closure(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


# ---------------------------------------------------------------- components
def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    want = closure({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if any(i in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- Jaccard
def shingle_set(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = split(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_jaccard(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = closure(ids, links)
    return {(i, len(sets[i]), root[i]) for i in ids}


def test_jaccard_against_all_pairs(docs, rows):
    got = {tuple(r) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute_jaccard([(r[0], r[1]) for r in rows])


def test_jaccard_of_one_large_group(spark):
    """More near copies than a block holds, in chains whose ends don't link themselves."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(700):
        w = list(words)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"v{rng.randrange(40)}"
        rows.append((i * 3, " ".join(w)))
    got = {tuple(r) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == brute_jaccard(rows)


def test_jaccard_of_names_that_many_share(spark, monkeypatch):
    """Small portions, blocks and tasks; a passage that most documents have, in portions of many classes."""
    monkeypatch.setattr(jaccard, "PORTION", 6000)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "WEIGHT", 400)
    monkeypatch.setattr(jaccard, "LIGHT", 500)
    rng = random.Random(8)
    rows, passage = [], [f"p{i}" for i in range(25)]
    for i in range(240):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 30]))]
        rows.append((i, " ".join(passage + own if i % 3 else own)))
    for i in range(240, 300):
        t = rows[i - 240][1].split()
        t[rng.randrange(len(t))] = "other"
        rows.append((i, " ".join(t)))
    got = {tuple(r) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute_jaccard(rows)


def test_names_that_agree_in_most_bits_are_told_apart(spark, monkeypatch):
    """Names forced to differ in a few bits only, high or low: all of a name decides."""
    real = jaccard.shingles
    for low in (True, False):

        def close(texts, size=5, low=low):
            keep = np.uint64(0xFFFFF0000000FFFF if low else 0xFF0000000000FFFF)
            return [np.unique(s & keep) for s in real(texts, size)]

        monkeypatch.setattr(jaccard, "shingles", close)
        rng = random.Random(2)
        rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(40))) for i in range(60)]
        rows += [(60 + i, rows[i][1] + " more words here") for i in range(20)]
        names = {i: set(close([t])[0].tolist()) for i, t in rows}
        root = closure(range(80), [(a, b) for a in names for b in names if a < b and 100 * len(names[a] & names[b]) >= 75 * len(names[a] | names[b])])
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = jaccard.gathered(docs, 1 << 10).filter("not doc").select(F.col("tokens")).collect()
        known = set().union(*names.values())
        assert found and all(set(np.frombuffer(r["tokens"], np.uint64).tolist()) <= known for r in found)
        assert {(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()} == set(root.items())


def test_components_of_a_hub(spark, monkeypatch):
    monkeypatch.setattr(components_module, "OFTEN", 3)
    edges = [(5, i) for i in range(100, 180)] + [(i, i + 1000) for i in range(100, 180, 2)] + [(2, 1100), (7, 8), (9, 8), (8, 10)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()}
    assert got == closure({x for e in edges for x in e}, edges)


def test_jaccard_edges(spark, nothing):
    assert jaccard.near_duplicates(nothing).count() == 0
    table = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A B c\td e f"), (1, None), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(table).collect())
    assert got == [(-1, 2, None), (1, 0, 1), (2, 0, 2), (4, 2, 4), (4, 2, 4), (9, 2, 4)]


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(2)
    items = []
    for i in range(150):
        base = np.unique(rng.integers(0, 1 << 60, 40).astype(np.uint64))
        items += [(3 * i + k, len(base) - k, base[k:]) for k in range(3)]
    items.sort(key=lambda x: (x[1], x[0]))
    tree = jaccard.Tree(np.array([i[1] for i in items]), np.array([jaccard.counts(i[2]) for i in items]))
    found = {tuple(sorted((items[a][0], items[b][0]))) for a, b in jaccard.candidates(tree, None)}
    assert {(3 * i + a, 3 * i + b) for i in range(150) for a in range(3) for b in range(a + 1, 3)} <= found
    assert len(found) < len(items) * (len(items) - 1) // 2


# ---------------------------------------------------------------- substrings
def brute_substrings(rows):
    first = {}
    words = {i: split(t) for i, t in rows}
    for i in sorted(words):
        w = words[i]
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("portion", [600, 2 << 20])
def test_substrings_against_plain_windows(docs, rows, monkeypatch, portion):
    monkeypatch.setattr(substrings, "PORTION", portion)
    want = brute_substrings([(r[0], r[1]) for r in rows])
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.deduplicate(docs).collect()}
    assert got == {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, (n, k, t) in want.items()}
    assert any(0 < k < n for n, k, _ in got.values())
    kept = substrings.deduplicate(docs, keep=True)
    assert kept.schema == docs.schema
    texts = {r[0]: r[1] for r in rows}
    for r in kept.collect():
        n, k, t = want[r["doc_id"]]
        assert r["text"] == (t if k else texts[r["doc_id"]]) and r["row"] == "r"


def test_substrings_edges(spark, nothing):
    assert substrings.deduplicate(nothing).count() == 0
    assert substrings.deduplicate(nothing, keep=True).schema == nothing.schema
    long = " ".join(f"w{i}" for i in range(20))
    table = spark.createDataFrame([(None, long), (5, long), (5, long), (7, long), (2, None)], "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"]) for r in substrings.deduplicate(table).collect())
    assert got == [(-1, 20, 0), (2, 0, 0), (5, 20, 0), (5, 20, 0), (7, 20, 20)]


def test_equal_windows_have_equal_anchors():
    """Whatever surrounds them, in text with runs and few words too."""
    rng = np.random.default_rng(4)
    seen = defaultdict(set)
    for _ in range(300):
        text = rng.integers(1, rng.choice([3, 6, 50]), rng.integers(13, 60)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        starts = np.arange(len(text) - 12)
        for s, a in zip(starts, substrings.anchors(text, np.zeros(len(text), int), starts), strict=True):
            seen[text[s : s + 13].tobytes()].add(int(a))
    assert max(map(len, seen.values())) == 1 and all(0 not in x for x in seen.values())


# ---------------------------------------------------------------- embeddings
def brute_embeddings(rows):
    ok = [(i, np.array(v, float), g) for i, v, g in rows if g is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links = [(a, b) for k, (a, v, g) in enumerate(ok) for b, w, h in ok[k + 1 :] if g == h and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.98]
    root = closure([r[0] for r in rows], links)
    return {(i, sum(i in e for e in links), root[i], root[i] == i) for i, _, _ in rows}


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "SMALL", 4)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 25] + rng.normal(size=8) * rng.choice([0.02, 0.15, 0.5])], int(rng.integers(0, 2))) for i in range(260)]
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(5)] + [(2000, [0.0] * 8, 1), (2001, None, 1), (2002, [float("nan")] * 8, 1), (2003, rows[0][1], None), (2004, [None, 1.0], 1), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1), (2007, [], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    assert {tuple(r) for r in embeddings.near_duplicates(table).collect()} == brute_embeddings(rows)


def test_embeddings_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_embeddings_of_awkward_rows(spark):
    """vec_ids that repeat or are null, and columns with the operator's own names."""
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(5, v, 1), (5, v, 1), (9, v, 1), (None, v, 1), (None, None, None), (7, w, 1), (8, w, 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in ("id", "grp", "cls", "raw", "part", "block", "salt", "n", "component")})
    got = sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(table).collect())
    assert got[:2] == [(-1, 0, None, None)] * 2
    assert got[2:] == [(5, 2, 5, True), (5, 2, 5, True), (7, 0, 7, True), (8, 0, 8, True), (9, 2, 5, False)]


def test_embeddings_spanning_edges_of_a_dense_matrix():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.01, 0.05, 0.3, 1.0):
        near = rng.random((40, 30)) < share
        a, b, edges = np.arange(100, 140), np.arange(500, 530), []
        embeddings.span(near, a, b, embeddings.Forest(), edges)
        ids = [*a.tolist(), *b.tolist()]
        links = [(int(a[i]), int(b[j])) for i, j in zip(*np.nonzero(near))]
        assert closure(ids, edges) == closure(ids, links)
        assert len(edges) == len(ids) - len(set(closure(ids, links).values()))


def test_embeddings_blocks_over_batches():
    """Blocks are cut by group and size, wherever a batch ends; none is lost or mixed."""
    groups = ["a/2"] * 150 + ["b/2"] * 64 + ["c/3"]
    rows = pd.DataFrame({"id": range(215), "copies": 1, "grp": groups, "raw": [np.arange(int(g[-1]), dtype=float).tobytes() for g in groups]})
    rows = rows.assign(**{c: rows["id"] * 0.5 for c in embeddings.Y})
    for step in (1, 7, 150, 215):
        out = pd.concat(embeddings.blocks((rows.iloc[i : i + step] for i in range(0, 215, step)), 4, 64)).to_dict("records")
        assert [(r["grp"], r["part"], r["block"], len(r["ids"]) // 8) for r in out] == [("a/2", 4, 0, 64), ("a/2", 4, 1, 64), ("a/2", 4, 2, 22), ("b/2", 4, 0, 64), ("c/3", 4, 0, 1)]
        assert np.concatenate([embeddings.Side(r).ids for r in out]).tolist() == list(range(215))
