"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

import pytest

SCHEMA = "doc_id long, text string, source string, rid long, row string, kept int, id string, root int, size string"


def rows_of(texts, source=None):
    return [(i, t, (source or ["s0"])[i % len(source or ["s0"])], -i, "x", 9, "y", 3, "z") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda texts, source=None: spark.createDataFrame(rows_of(texts, source), SCHEMA)


@pytest.fixture(scope="session")
def table(spark):
    """Any rows (doc_id, text, source) under the clashing schema."""
    return lambda rows: spark.createDataFrame([(*r, 7, "x", 9, "y", 3, "z") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def prose():
    """Words drawn at random, with a fixed seed."""
    vocabulary = [f"w{i}" for i in range(4000)]

    def make(n, seed):
        return " ".join(random.Random(seed).choices(vocabulary, k=n))

    return make
