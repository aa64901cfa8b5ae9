from __future__ import annotations

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, row string, u long, component string, n_chars long"


@pytest.fixture(scope="session")
def prose():
    """A maker of invented sentences, the same for the same seed."""

    def make(seed: int, n: int, alphabet: str = "abcdefgh") -> str:
        draw = random.Random(seed)
        return " ".join("".join(draw.choices(alphabet, k=draw.randint(1, 6))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of documents with columns whose names clash with the operators' own."""

    def make(rows):
        rows = [tuple(r) + (None,) * (4 - len(r)) + ("x", 1, "y", 0) for r in rows]
        return spark.createDataFrame(rows, DDL)

    return make


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
