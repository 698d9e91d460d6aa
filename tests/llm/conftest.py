import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc string, digest string, key string, p0 double, kind int, span string"


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["alpha", "beta", "gamma", "Δelta", "x", "42"]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and very long texts, copies, near copies, repeated rows, shared passages, symbols."""
    rng = random.Random(3)
    base, passage = words(rng, 120), words(rng, 60)
    long = words(rng, 30_000)
    edited = base.split()
    edited[50] = "changed"
    texts = [
        None, "", "", None, " \n", "###", "###", "one two", "One, two!", base, base, base.upper(), " ".join(edited), long, long[5_000:90_000],
        passage + " " + words(rng, 40), words(rng, 30) + " " + passage, words(rng, 10) + " " + passage + " " + passage, "a" * 5_000, "é" * 300, "ab" * 400,
        words(rng, 3), words(rng, 14), "\ud7ff\U0001f600 " * 90, "<|endoftext|> x", "tail",
    ]
    rows = [(3 * i + 1, t, "en", "s", 1, "d", "e", "f", 0.5, 7, "g") for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[13]]  # two rows repeated


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def keyless(spark):
    return spark.createDataFrame([(None, "same text of one row", *[None] * 9), (None, None, *[None] * 9), (5, "same text of one row", *[None] * 9)], DOCS)
