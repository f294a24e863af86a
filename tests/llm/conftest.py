import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, component_id long, fingerprint string, size long"


def invented(rng, n):
    return " ".join("".join(rng.choice(["ba", "ko", "ri", "tu", "ne", "sol", "mi"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts(seed=1, n=60):
    """Texts with copies, near copies, shared passages, empty and null ones, and one long one."""
    rng = random.Random(seed)
    out = [invented(rng, rng.randint(0, 120)) for _ in range(n)]
    passage = invented(rng, 30)
    for i in range(0, n, 7):
        words = out[i].split()
        out[i] = " ".join([*words[:5], passage, *words[5:]])
    for i in range(1, n, 9):
        out[i] = out[(i * 3) % n]
    for i in range(2, n, 11):
        out[i] = out[(i * 5) % n] + " zusatz"
    out[5], out[6], out[8] = "", None, "a " * 40
    out[12] = invented(rng, 20_000)
    return out


@pytest.fixture(scope="session")
def rows():
    t = texts()
    own = [(i * 3, x, "en", f"src{i % 4}" if i % 10 else None, len(x or ""), 1, 7, "x", 3) for i, x in enumerate(t)]
    return [*own, own[4], (None, "ohne nummer " * 20, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """documents with extra columns whose names clash with results, a repeated row and a row without an id."""
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
