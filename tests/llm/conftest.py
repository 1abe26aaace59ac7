import random

import pytest

PARTS = ["the", "and", "of", "éa", "in", "a", "thing", "🙂", "to be", "aaaa"]


def phrase(rng, n):
    return " ".join(rng.choice(PARTS) for _ in range(n))


def word(rng):
    return "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))


@pytest.fixture(scope="session")
def odd_docs():
    """Shared passages, copies, near copies, ties, empty, NULL and long texts."""
    rng = random.Random(2)
    passages = [phrase(rng, rng.randint(5, 40)) for _ in range(6)]
    docs = []
    for _ in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.25 else word(rng) for _ in range(rng.randint(0, 30))]
        docs.append((rng.randint(100, 10**12), " ".join(parts)))
    base = [word(rng) for _ in range(120)]
    for k in range(40):  # near copies, some of which are linked only through others
        copy = list(base)
        for _ in range(k % 5):
            copy[rng.randrange(120)] = word(rng)
        docs.append((2000 + k, " ".join(copy)))
    docs += [
        (5, None), (6, ""), (7, "a" * 500), (8, "a" * 300 + "b"), (9, "ab" * 300), (10, docs[3][1]),
        (10**13, docs[3][1]), (11, " \n\t "), (12, "one two"), (13, "One TWO"), (14, "é" * 60), (15, "x\ny\nx\n\nx"),
        (16, " ".join(word(rng) for _ in range(30000))),
    ]
    return docs


@pytest.fixture(scope="session")
def odd(spark, odd_docs):
    return spark.createDataFrame(odd_docs, "doc_id bigint, text string").repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
