"""Order statistics found by narrowing equal those of sorted values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import bucket_of, natural_key
from tidemark.functions.ranks import exact_quantiles, values_at_ranks
from tidemark.functions.sketch import spread_quantiles


def samples(kind, n=20_000):
    rng = random.Random(1)
    if kind == "even":
        return [rng.random() for _ in range(n)]
    if kind == "outliers":
        return [rng.gauss(0, 1) * (1e12 if i % 1000 == 0 else 1) for i in range(n)]
    if kind == "one value":
        return [5.0] * n
    if kind == "two values":
        return [float(i % 3 == 0) for i in range(n)]
    return [float(min(rng.randrange(50), 20)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["even", "outliers", "one value", "two values", "a third alike"])
@pytest.mark.parametrize("order", ["shuffled", "sorted"])
def test_values_at_ranks(spark, kind, order):
    values = samples(kind)
    rows = sorted(values) if order == "sorted" else values
    df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(6) if order == "shuffled" else spark.createDataFrame([(v,) for v in rows], "v double")
    n = len(values)
    ranks = [0, 1, n // 4, n // 3, n // 2, n - 2, n - 1]
    found = values_at_ranks(df, "v", {None: ranks}, {None: n}, max_rows=200)
    wanted = sorted(values)
    assert found == {(None, r): wanted[r] for r in ranks}


def test_groups_and_ties(spark):
    rng = random.Random(2)
    rows = [(g, rng.randrange(40), i) for i in range(9_000) for g in [rng.choice(["a", "a", "a", "b", "c"])]]
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(5)
    parts = {g: sorted((v, i) for h, v, i in rows if h == g) for g in "abc"}
    ranks = {g: [0, len(p) // 3, len(p) // 2, len(p) - 1] for g, p in parts.items()}
    sizes = {g: len(p) for g, p in parts.items()}
    found = values_at_ranks(df, "v", ranks, sizes, by="g", tie="id", max_rows=100)
    assert found == {(g, r): parts[g][r] for g in parts for r in ranks[g]}


@pytest.mark.parametrize("claim", [1, 1000, 10**6])
def test_a_wrong_claim_of_even_values_costs_time_only(spark, claim):
    rng = random.Random(4)
    values = [int(rng.gauss(500, 100)) for _ in range(5_000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, id long")
    order = sorted((v, i) for i, v in enumerate(values))
    ranks = [0, 1_234, 2_500, 4_999]
    found = values_at_ranks(df, "v", {None: ranks}, {None: 5_000}, tie="id", max_rows=50, even=claim)
    assert found == {(None, r): order[r] for r in ranks}


def test_exact_quantiles_both_ways(spark):
    rows = [(a, b if i % 5 else None) for i, (a, b) in enumerate(zip(samples("even"), samples("a third alike")))]
    df = spark.createDataFrame(rows, "a double, b double")
    known = [b for _, b in rows if b is not None]
    wanted = {"a": np.quantile([a for a, _ in rows], [0.25, 0.5, 0.75]), "b": np.quantile(known, [0.25, 0.5, 0.75])}
    sizes = {"a": len(rows), "b": len(known)}
    for limit in (10**6, 500):
        found = exact_quantiles(df, {c: F.col(c) for c in "ab"}, [0.25, 0.5, 0.75], sizes, max_rows=limit)
        for c in "ab":
            assert found[c] == pytest.approx(list(wanted[c]), abs=1e-12)


def test_sketch_of_uneven_partitions(spark):
    small = spark.createDataFrame([(float(i),) for i in range(10)], "v double").coalesce(1)
    large = spark.range(100_000).select((F.col("id") + 1000.0).alias("v")).repartition(3)
    points = spread_quantiles(small.unionByName(large), "v", [0.25, 0.5]).first()["p"]
    assert points == pytest.approx([26_000, 51_000], rel=0.01)


def test_bucket_of(spark):
    df = spark.createDataFrame([(float(v),) for v in range(10)], "v double")
    edges = [F.lit(x) for x in (2.0, 5.0, 9.0)]
    found = [r[1] for r in df.select("v", bucket_of(F.col("v"), edges)).collect()]
    assert found == [0, 0, 1, 1, 1, 2, 2, 2, 2, 3]


def test_natural_order():
    assert sorted(["feature_10", "feature_2", "a", "feature_1"], key=natural_key) == ["a", "feature_1", "feature_2", "feature_10"]
