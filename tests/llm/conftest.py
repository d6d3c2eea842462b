import random

import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long, `__text` string, score string, node long, `key` string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", "y", 7, None) for r in rows]
        return spark.createDataFrame(full, KINDS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def prose():
    """Made-up sentences: ``prose(seed, words)``."""

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("aeinorstlu", k=rng.randint(2, 9))) for _ in range(words))

    return make


def pytest_collection_modifyitems(items):
    items.sort(key=lambda i: "pipeline" in i.nodeid)
