import random

import pytest


def _words(rng, n):
    return " ".join(rng.choice(["ab", "c", "de", "the", "of", "é" + str(rng.randrange(200)), str(rng.randrange(200))]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Small documents (doc_id, text) with copies, near copies, shared
    passages, low-entropy runs, null, empty and long texts."""
    rng = random.Random(5)
    base = [_words(rng, 130) for _ in range(6)]
    docs = []
    for i in range(260):
        r = rng.random()
        if r < 0.3:
            w = rng.choice(base).split()
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
            text = " ".join(w)
        elif r < 0.5:
            text = _words(rng, rng.randrange(50)) + " " + rng.choice(base)[: rng.randrange(100, 400)] + " " + _words(rng, 20)
        elif r < 0.6:
            text = "spam " * rng.randrange(200)
        elif r < 0.63:
            text = None
        elif r < 0.66:
            text = ""
        else:
            text = _words(rng, rng.randrange(80)) + " \t é\n\n" + _words(rng, 9)
        docs.append((i * 3 % 301 - 7, text))
    docs.append((1000, base[0] + "\n" + _words(rng, 4000)))
    docs.append((1001, "q" * 3000))
    return docs


@pytest.fixture()
def frame(spark, corpus):
    """The corpus as a DataFrame with extra columns of clashing names."""
    rows = [(d, t, 1, "x", None) for d, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, n_windows int, anchor string, rank int").repartition(5)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
