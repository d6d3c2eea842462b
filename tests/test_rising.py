"""Rising curves against pooling one value at a time, and Spark's own isotonic regression."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from tidemark.operators import rising


def plain(scores, truths):
    """Corners of the rising curve."""
    blocks = []
    for s in np.unique(scores):
        t = truths[scores == s]
        blocks.append([s, s, t.sum(), len(t)])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            _, high, y, w = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + y, blocks[-1][3] + w]
    corners = [(x, y / w) for low, high, y, w in blocks for x in sorted({low, high})]
    return np.array(corners).T


def frame(spark, scores, truths):
    return spark.createDataFrame([(float(s), bool(t)) for s, t in zip(scores, truths)], "s double, t boolean").repartition(4)


def made(seed, n):
    rng = np.random.default_rng(seed)
    scores = np.round(rng.normal(size=n), 2 if seed % 2 else 6)
    return scores, rng.random(n) < (0.5 + 0.4 * np.sin(scores * (seed + 1)) if seed else 0.5 - 0.4 * np.tanh(scores))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block, corners", [(10_000, 1000), (40, 1000), (40, 0)])
def test_equals_plain_pooling(spark, monkeypatch, seed, block, corners):
    monkeypatch.setattr(rising, "BLOCK_ROWS", block)
    monkeypatch.setattr(rising, "MAX_CORNERS", corners)
    scores, truths = made(seed, 400)
    curve = rising.rising_curve(frame(spark, scores, truths), "s", F.col("t"))
    assert (curve.corners is None) == (corners == 0)
    s, p = plain(scores, truths)
    ask = [*np.linspace(-5, 5, 41).tolist(), *scores[:20].tolist(), None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ask)], "i int, x double")
    found = {r.i: r.q for r in curve(rows, "x", "q").collect()}
    assert found.pop(len(ask) - 1) is None
    assert np.allclose([found[i] for i in range(len(ask) - 1)], np.interp(ask[:-1], s, p))


def test_many_scores_in_many_ranges(spark, monkeypatch):
    """More rounds are needed, and the driver sees a row for each range only."""
    monkeypatch.setattr(rising, "BLOCK_ROWS", 5_000)
    rows = spark.range(200_000).select((F.col("id") / 200_000).alias("s"), (F.pmod(F.xxhash64("id"), F.lit(1000)) < 500 + 300 * F.sin(F.col("id") / 9_000)).alias("t"))
    curve = rising.rising_curve(rows, "s", F.col("t"))
    points = rows.select(array_to_vector(F.array("s")).alias("features"), F.col("t").cast("double").alias("label"))
    model = IsotonicRegression().fit(points)
    ask = np.linspace(0, 1, 501)
    assert np.allclose(np.interp(ask, *curve.corners), np.interp(ask, model.boundaries.toArray(), model.predictions.toArray()))


def test_curve_is_read_by_another_job(spark):
    scores, truths = made(1, 200)
    curve = rising.rising_curve(frame(spark, scores, truths), "s", F.col("t"))
    assert rising.RisingCurve.read(spark, curve.path).corners == curve.corners


def test_no_rows(spark):
    curve = rising.rising_curve(spark.createDataFrame([], "s double, t boolean"), "s", F.col("t"))
    assert curve(spark.createDataFrame([(1.0,)], "x double"), "x", "q").collect()[0].q is None
