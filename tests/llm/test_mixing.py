import random
from collections import Counter
from math import ceil, floor

import pytest

from shoalframe.llm import mixing


def table(spark, sizes, seed=2):
    rng = random.Random(seed)
    rows = [(1000 * k + i, "x" * rng.choice([0, 50, 100, 150]), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


def edf(counts):
    """A plain earliest-deadline-first run over one round."""
    h, done, out = sum(counts), [0] * len(counts), []
    for t in range(h):
        ready = [(ceil((done[i] + 1) * h / c), i) for i, c in enumerate(counts) if done[i] < c and floor(done[i] * h / c) <= t]
        i = min(ready)[1]
        done[i] += 1
        out.append(i)
    return out


def test_no_source_is_a_block_off_its_target(spark):
    sizes = {"a": 400, "b": 150, "c": 30, None: 60}
    out = mixing.schedule(table(spark, sizes), block_chars=300, round_slots=16).collect()
    assert len(out) == sum(sizes.values())
    blocks = {(r["source"], r["block"]): (r["slot"], r["release"], r["due"]) for r in out}
    assert all(release <= slot < due for slot, release, due in blocks.values())
    assert len({s for s, _, _ in blocks.values()}) == len(blocks)
    weight = {r["source"]: r["weight"] for r in out}
    h = next(h for h in range(1, 100) if all(abs(w * h - round(w * h)) < 1e-9 for w in weight.values()))
    n = Counter(s for s, _ in blocks)
    full = h * min(n[s] // round(weight[s] * h) for s in weight)  # slots of rounds in which every source has its part
    at = {slot: s for (s, _), (slot, _, _) in blocks.items()}
    assert full >= 2 * h and sorted(at) == list(range(len(blocks)))
    done = Counter()
    for t in range(full):
        done[at[t]] += 1
        assert all(abs(done[s] - weight[s] * (t + 1)) < 1 for s in weight)


@pytest.mark.parametrize("counts", [[8, 4, 3, 1], [1, 1, 1], [250, 3, 2, 1], [7], [5, 5, 1]])
def test_rounds_against_a_plain_run(spark, counts):
    rows = spark.createDataFrame([(f"s{i}", 3 * c, c) for i, c in enumerate(counts)], "source string, n_blocks long, slots long")
    got = [None] * sum(counts)
    for r in mixing.plan(rows).collect():
        first = r["shapes"][0]
        assert first["h"] == sum(counts) and first["start"] == 0
        for t in first["at"]:
            got[t] = int(r["source"][1:])
    assert got == edf(counts)


def test_given_weights_and_exhaustion(spark):
    out = mixing.schedule(table(spark, {"a": 40, "b": 40}), {"a": 3, "b": 1}, block_chars=200, round_slots=8).collect()
    order = [r["source"] for r in sorted({(r["slot"], r["source"]): r for r in out}.values(), key=lambda r: r["slot"])]
    assert order[:8].count("a") == 6 and order[-1] == "b"
    assert sorted(r["row"]["doc_id"] for r in out) == sorted([*range(40), *range(1000, 1040)])


def test_mix_keeps_all_rows_and_columns(docs, nothing, rows):
    out = mixing.mix(docs, block_chars=200)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert mixing.mix(nothing).count() == 0
    assert mixing.schedule(docs.union(docs)).count() == 2 * len(rows)


def test_rows_against_a_plain_placement(spark):
    """Brute force: each source's rows laid end to end in the operator's order, blocks put into slots by plain runs round by round."""
    size, sizes, weights = 300, {"a": 90, "b": 40, "c": 15}, {"a": 2, "b": 1, "c": 1}
    out = mixing.schedule(table(spark, sizes), weights, block_chars=size, round_slots=4).collect()
    rows = {s: sorted((r for r in out if r["source"] == s), key=lambda r: (r["block"], r["at"], len(r["row"]["text"]))) for s in sizes}
    where, n_blocks = {}, {}
    for s, mine in rows.items():
        chars = sum(len(r["row"]["text"]) for r in mine)
        n_blocks[s] = max(1, -(-chars // size))
        starts = sorted((r["block"] * size + r["at"], len(r["row"]["text"])) for r in mine)
        at = 0
        for start, n in starts:  # gapless: each row begins where those before it end
            assert start == at
            at += n
        where |= {(s, min(start // size, n_blocks[s] - 1)): None for start, _ in starts}
    left, t, done, names = dict(n_blocks), 0, Counter(), sorted(sizes)
    slots = {}
    while any(left.values()):
        counts = [min(weights[s], left[s]) for s in names]
        live = [i for i, c in enumerate(counts) if c]
        for i in edf([counts[i] for i in live]):
            s = names[live[i]]
            slots[s, done[s]] = t
            done[s], left[s], t = done[s] + 1, left[s] - 1, t + 1
    assert {(r["source"], r["block"]): r["slot"] for r in out} == {k: slots[k] for k in where}


def test_awkward_rows(spark):
    kind = "doc_id long, text string, source string, slot long, block string"
    rows = [(1, "x" * 50, "a", 1, "b")] * 3 + [(None, "x" * 50, "a", 1, "b"), (None, None, None, None, None), (2, "", "", 0, "")]
    out = mixing.mix(spark.createDataFrame(rows, kind), block_chars=60)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, rows))
