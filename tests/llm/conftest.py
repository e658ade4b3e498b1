import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, score string, node int, size int, row string,"
          " _g int, _gone int, piece string, removed string")


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names operators use inside."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t), "x", 1, 2, "r", 3, 4, "p", "q") for i, t, lang, src in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 60, 10**6)
    near = base.split()
    near[50] = "other"
    rows = [(i, prose(rng, rng.randrange(1, 60)), rng.choice(["en", "de"]), rng.choice(["b", "a", None])) for i in range(40)]
    rows += [(100, base, "en", "a"), (101, base, "en", "b"), (102, " ".join(near), None, "a"), (103, base.upper(), "en", None)]
    rows += [(110 + k, prose(rng, 30) + " " + passage + "\n" + prose(rng, 20), "de", "b") for k in range(4)]
    rows += [(120, None, "en", "a"), (121, "", "en", "a"), (122, " \t\n", None, None), (123, "?! 12", "en", "a"), (124, "one two", "de", "b"),
             (125, "x" * 30_000, "en", "a"), (126, prose(rng, 9000), "en", "a"), (126, "same id", "en", "a"),
             (None, base, "en", "a"), (None, None, None, None), (40, "z z z", "en", "b"), (40, "z z z", "en", "b")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows).cache()


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
