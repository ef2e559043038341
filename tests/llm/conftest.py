"""Small corpora with every awkward case: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

import pytest

#: Columns whose names the operators use inside.
EXTRA = "cls string, part int, block long, n long, row string, salt int, slot long, id long, score double"


def words(rng, n):
    return " ".join("".join(rng.choice(["the", "on", "er", "ing", "al", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(5)
    base = [words(rng, rng.choice([3, 8, 13, 14, 40, 120])) for _ in range(30)]
    shared = words(rng, 20)
    texts = [None, "", " \n\t ", "one", "a b c d", "x " * 40, "x " * 40, "?! 12 %%", "Ünï çødé ß " * 9, words(rng, 9000)]
    texts += base + base[:6] + [b.upper() for b in base[6:9]]
    for b in base[9:20]:
        t = b.split()
        t[len(t) // 2] = "changed"
        texts.append(" ".join(t))
    texts += [words(rng, 5) + " " + shared + " " + words(rng, 7) for _ in range(6)] + [shared]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None, ""])) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus over several partitions, with two equal texts and extra columns; tests of their own have rows that repeat."""
    kind = f"doc_id long, text string, lang string, source string, {EXTRA}"
    full = [(*r, "x", 1, 2, 3, "r", 4, 5, 6, 0.5) for r in rows]
    return spark.createDataFrame(full, kind).repartition(5, "doc_id").cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], f"doc_id long, text string, lang string, source string, {EXTRA}")
