"""Metrics against direct computation."""

import random

import pytest

from tidemark.operators import metrics


def scored(seed, n=400, levels=None):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(rng.random() < 0.4)
        s = rng.random() * 0.7 + 0.3 * y
        s = round(s * levels) / levels if levels else s
        rows.append((y, s, int(s > 0.5)))
    return rows


def pair_auc(rows):
    pos, neg = [s for y, s, _ in rows if y], [s for y, s, _ in rows if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [None, 4])
@pytest.mark.parametrize("bucket_rows", [10**6, 20])
def test_auc(spark, levels, bucket_rows):
    rows = scored(1, levels=levels)
    df = spark.createDataFrame(rows, "y int, s double, p int").repartition(3)
    assert metrics.roc_auc(df, "y", "s", bucket_rows=bucket_rows).first()[0] == pytest.approx(pair_auc(rows), abs=1e-12)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()[0] is None


def test_evaluate(spark):
    rows = scored(2)
    df = spark.createDataFrame(rows, "y int, s double, p int")
    found = {r["metric"]: r["value"] for r in metrics.evaluate(df, "y", "p", "s").collect()}
    tp = sum(y and p for y, _, p in rows)
    fp, fn = sum(p and not y for y, _, p in rows), sum(y and not p for y, _, p in rows)
    assert found["accuracy"] == pytest.approx(sum(y == p for y, _, p in rows) / len(rows))
    assert found["precision"] == pytest.approx(tp / (tp + fp))
    assert found["recall"] == pytest.approx(tp / (tp + fn))
    assert found["f1_score"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert found["roc_auc"] == pytest.approx(pair_auc(rows))
    some = metrics.evaluate(df, "y", "p", metrics=["recall", "roc_auc"]).collect()
    assert [r["metric"] for r in some] == ["recall"]
    with pytest.raises(ValueError, match="unknown metrics"):
        metrics.evaluate(df, "y", "p", metrics=["mse"])


def test_nothing_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    assert tuple(metrics.precision_recall_f1(df, "y", "p").first()) == (0.0, 0.0, 0.0)


def test_text_labels(spark):
    df = spark.createDataFrame([("b", "b"), ("a", "b"), ("c", "c"), ("a", "a")], "y string, p string")
    found = {r["metric"]: r["value"] for r in metrics.evaluate_classes(df, "y", "p").collect()}
    assert found["accuracy"] == 0.75
    assert found["precision"] == pytest.approx((1 + 0.5 + 1) / 3)
    assert found["recall"] == pytest.approx((0.5 + 1 + 1) / 3)
