import random

import pytest

SF = "/root/testdata/sf0.001"


def prose(rng, n, words=400):
    """n words with a skewed choice out of a made vocabulary."""
    pool = [f"w{rng.randrange(words)}x{k % 7}" for k in range(words)]
    return " ".join(pool[min(words - 1, int(rng.expovariate(0.01)))] for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empties, blanks, repeats, ties, a very long text."""
    rng = random.Random(3)
    long = prose(rng, 60_000)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three four five"),
            (6, prose(rng, 300)), (7, long), (8, long + " tail"), (None, "no id here"),
            (9, "é" * 50 + " ñandú çedilla " * 20), (4, "one"), (10, "a\n\na\nb\na")]
    return rows + [(20 + k, prose(rng, 30 + k)) for k in range(20)]


@pytest.fixture()
def odd_docs(spark, odd_rows):
    """The odd rows with columns whose names clash with the operators' own."""
    rows = [(i, t, 1, "x", None, 0.5) for i, t in odd_rows]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, n_words int, fp string, spans string, score double")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, extra int")
