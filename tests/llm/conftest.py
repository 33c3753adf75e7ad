import random

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture
def frame(spark):
    """Rows of (doc_id, text) with more columns, named as operators name theirs."""

    def make(rows):
        names = "n_words key member line node shard starts first first_lines start end score a b"
        more = ", ".join(f"{n} int" for n in names.split())
        return spark.createDataFrame([(*r, *[7] * len(names.split())) for r in rows], f"{DOCS}, {more}")

    return make


ODD = [(1, ""), (2, None), (3, " \t\n "), (4, "one"), (4, "one"), (None, "no id here, but some words"), (None, None)]


@pytest.fixture
def odd():
    return list(ODD)
