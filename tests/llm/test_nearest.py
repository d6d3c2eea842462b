"""Exact search against all inner products, with one shard and with many."""

import math

import numpy as np
import pytest
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F

from tidemark.llm import nearest


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_rows(nearest.op7_top_products(spark, sf)) == duck_rows(sf, nearest.ORACLE)


def brute(rows, every, top=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for i in sorted({i for i, _ in good if i % every == 0}):
        q = min(v for j, v in good if j == i)
        best = sorted({(-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q)})
        seen, ranked = set(), []
        for s, j in best:
            if j not in seen:
                seen.add(j)
                ranked.append((j, -s))
        found += [(i, k + 1, j, s) for k, (j, s) in enumerate(ranked[:top])]
    return found


@pytest.mark.parametrize("shard_rows", [10_000, 40, 15])
def test_equals_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(nearest, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) + (i % 3)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # many copies: ties go to smaller ids
    rows += [(300, None), (301, [float("nan")] * 6), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [rows[5], rows[100], (310, [0.0] * 6), (320, []), (330, [1.0, 2.0])]  # repeated rows, other lengths
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string").repartition(5)
    found = nearest.top_products(frame, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows, 10))


def test_few_rows(spark):
    kinds = "vec_id long, embedding array<float>"
    ask = F.col("vec_id") % 50 == 0
    assert nearest.top_products(spark.createDataFrame([], kinds), ask).collect() == []
    assert nearest.top_products(spark.createDataFrame([(0, [1.0])], kinds), ask).collect() == []
    two = spark.createDataFrame([(0, [1.0]), (1, [-0.001])], kinds)
    assert [tuple(r) for r in nearest.top_products(two, ask).collect()] == [(0, 1, 1, -256)]


def test_large_components(spark):
    big = [(0, [3.0e6, 1.0]), (1, [3.0e6, 2.0]), (2, [-3.0e6, 0.0])]
    frame = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, nearest.top_products(frame, F.col("vec_id") == 0).collect())) == brute(big, 50)
