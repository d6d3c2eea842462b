"""Fold sizes, determinism, and the narrowing path."""

import math
import random
from collections import Counter

import pytest

from tidemark.operators import splits


def rows(n=997, seed=3):
    rng = random.Random(seed)
    return [(i * 7 + 3, rng.choice("aaaaabbc")) for i in range(n)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(rows(), "id long, y string").repartition(3)


def tagged(frame, tag="fold"):
    return {r["id"]: r[tag] for r in frame.collect()}


@pytest.mark.parametrize("k", [2, 3, 5, 10])
def test_kfold_sizes(df, k):
    sizes = Counter(tagged(splits.kfold(df, "id", k)).values())
    assert sorted(sizes) == list(range(k))
    assert max(sizes.values()) - min(sizes.values()) <= 1


@pytest.mark.parametrize("make", [splits.stratified_kfold, splits.ordered_stratified_folds])
@pytest.mark.parametrize("k", [2, 5])
def test_every_label_is_spread(df, make, k):
    folds = tagged(make(df, "id", "y", k))
    assert len(folds) == 997
    label = dict(rows())
    per = Counter((label[i], f) for i, f in folds.items())
    for y in "abc":
        counts = [per[y, f] for f in range(k)]
        assert max(counts) - min(counts) <= 1
    totals = Counter(folds.values())
    assert max(totals.values()) - min(totals.values()) <= 1


def test_ordered_folds_are_contiguous(df):
    folds, label = tagged(splits.ordered_stratified_folds(df, "id", "y", 4)), dict(rows())
    for y in "abc":
        mine = [folds[i] for i in sorted(folds) if label[i] == y]
        assert mine == sorted(mine)


@pytest.mark.parametrize("size", [0.2, 0.33, 0.5])
def test_split_sizes(df, size):
    test, label = tagged(splits.train_test_split(df, "id", "y", size), "is_test"), dict(rows())
    assert sum(test.values()) == math.ceil(997 * size)
    for y in "abc":
        mine = [test[i] for i in test if label[i] == y]
        train = len(mine) - sum(mine)
        assert abs(train - len(mine) * (997 - sum(test.values())) / 997) < 1


def test_narrowing_changes_nothing(df):
    for make in (
        lambda m: splits.kfold(df, "id", 5, max_rows=m),
        lambda m: splits.stratified_kfold(df, "id", "y", 5, max_rows=m),
        lambda m: splits.ordered_stratified_folds(df, "id", "y", 5, max_rows=m),
    ):
        assert tagged(make(10)) == tagged(make(10**6))


def test_same_rows_same_folds_however_partitioned(df):
    assert tagged(splits.kfold(df.repartition(1), "id")) == tagged(splits.kfold(df.repartition(9, "y"), "id"))
    assert tagged(splits.kfold(df, "id", seed=1)) != tagged(splits.kfold(df, "id", seed=2))


def test_errors(spark, df):
    with pytest.raises(ValueError, match="at least 2"):
        splits.kfold(df, "id", 1)
    with pytest.raises(ValueError, match="cannot make"):
        splits.kfold(df.limit(3), "id", 5)
    with pytest.raises(ValueError, match="without a label"):
        splits.stratified_kfold(spark.createDataFrame([(1, "a"), (2, None)], "id long, y string"), "id", "y", 2)
    with pytest.raises(ValueError, match="two rows"):
        splits.train_test_split(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, y string"), "id", "y", 0.5)
    with pytest.raises(ValueError, match="between 0 and 1"):
        splits.train_test_split(df, "id", "y", 1.5)
    with pytest.warns(UserWarning, match="fewer rows"):
        splits.stratified_kfold(spark.createDataFrame([(i, "a" if i else "b") for i in range(9)], "id long, y string"), "id", "y", 3)


def test_tagging_does_not_shuffle_the_rows(df, spark):
    wide = spark.range(1000).selectExpr("id", "CAST(id % 2 AS STRING) AS y", "id * 2 AS payload")
    plan = splits.stratified_kfold(wide, "id", "y", 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan
