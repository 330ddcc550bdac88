import random

import pytest

ODD = [
    (None, "a row without id"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "the same text twice"),
    (5, "the same text twice"),
    (6, "the same text twice"),
]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["ba", "ne", "tor", "ül", "ka", "ri", "ses", "mo"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def documents(spark, rows=None, extra=True):
    """Rows of ``(doc_id, text)`` as documents, with columns whose names operators use inside."""
    rows = ODD + [(10 + i, prose(i, 20 * i + 3)) for i in range(12)] if rows is None else rows
    full = [(i, t, "en", f"s{(i or 0) % 3}" if i != 4 else None, len(t or ""), 7, "x") for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key int, fp string"
    df = spark.createDataFrame(full, schema)
    return df if extra else df.drop("key", "fp")


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
