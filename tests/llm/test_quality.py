"""Quality: statistics against plain Python, held-out results, edge rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.quality import STATISTICS, document_statistics, grow, keep_good, op9_quality, remainder, score_quality, statistics, training_rows


def test_statistics_by_hand():
    texts = ["The cat, the Cat 42!\nthe cat\nthe cat", None, "", "é", "a" * 30 + " b | b"]
    found = dict(zip(STATISTICS, statistics(pa.array(texts, pa.string())).T))
    raw = (texts[0]).encode()
    words = texts[0].lower().split()
    assert np.isclose(found["log_bytes"][0], np.log1p(len(raw))) and np.isclose(found["log_words"][0], np.log1p(len(words)))
    assert np.isclose(found["upper"][0], 2 / len(raw)) and np.isclose(found["digit"][0], 2 / len(raw)) and np.isclose(found["newline"][0], 2 / len(raw))
    assert np.isclose(found["distinct_words"][0], len(set(words)) / len(words)) and np.isclose(found["top_word"][0], 4 / len(words))
    assert np.isclose(found["distinct_lines"][0], 2 / 3) and np.isclose(found["mean_word"][0], np.mean([len(w) for w in words]))
    assert np.isclose(found["distinct_pairs"][0], len(set(zip(words, words[1:]))) / (len(words) - 1))
    assert not statistics(pa.array(texts, pa.string()))[1:3].any()
    assert found["non_ascii"][3] == 1 and np.isclose(found["long_words"][4], 1 / 4) and np.isclose(found["no_letter_words"][4], 1 / 4)


def test_trees_learn_and_degenerate():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = grow(x, y, trees=60, depth=3)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.97
    for some in (np.zeros(0), np.ones(5)):
        found = grow(x[: len(some)], some).probability(x)
        assert np.allclose(found, (some.sum() + 1) / (len(some) + 2))


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = op9_quality(spark, sf)
    rows = found.join(labels, "doc_id").withColumn("c", F.crc32(F.col("doc_id").cast("string").cast("binary"))).collect()
    assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (r.c % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95


def test_edges(spark, make_docs, prose):
    rows = [(i, prose(i, 30)) for i in range(40)] + [(40 + i, "XX!! " * 30) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "y " * 50_000), (102, "y " * 50_000), (None, "no id")]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    found = score_quality(make_docs(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    kept = keep_good(make_docs(rows), labels)
    assert kept.columns == make_docs(rows).columns
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in make_docs(rows).collect()}  # no column is overwritten
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(40)) <= ids and not ids & set(range(40, 80))
    assert score_quality(make_docs([]), labels).collect() == []
    assert {r.score for r in score_quality(make_docs(rows), labels.limit(0)).collect()} == {0.5}


def recursive(trees, x):
    """Score of one row, tree by tree and node by node."""

    def leaf(node):
        if trees.left[node] == node:
            return trees.value[node]
        return leaf(trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node])

    return 1 / (1 + np.exp(-(trees.base + sum(leaf(root) for root in trees.roots))))


def test_flattened_walk_equals_recursive_walk():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    trees = grow(x, (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float), trees=20, depth=4)
    more = np.vstack([x, rng.normal(size=(200, 5)).astype(np.float32), np.zeros((1, 5), np.float32)])
    assert np.allclose(trees.probability(more), [recursive(trees, r) for r in more])


def test_query_equals_one_row_at_a_time(spark):
    """Statistics of each text alone, and the recursive walk, give the query's scores."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    measured = document_statistics(docs.select("doc_id", "text"), "text", "doc_id")
    trees = grow(*training_rows(measured, labels, "quality", remainder("doc_id", 5) != 0))
    wanted = {r.doc_id: recursive(trees, statistics(pa.array([r.text], pa.string()))[0]) for r in docs.select("doc_id", "text").collect()}
    found = {r.doc_id: r.score for r in op9_quality(spark, sf).collect()}
    assert found.keys() == wanted.keys() and all(np.isclose(found[i], wanted[i]) for i in found)
