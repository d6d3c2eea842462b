"""Hard negatives against all pairs; invariants of the cover tree."""

import math

import numpy as np
import pytest
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hard

KINDS = "vec_id long, embedding array<float>, label int, id string, x int, dim string, shard int"


def frame(spark, rows, partitions=5):
    return spark.createDataFrame([(*r, "i", 1, "d", 2) for r in rows], KINDS).repartition(partitions)


def brute(rows, every, top=5, near=80):
    good = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows if None not in (i, v, l) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in sorted({r[0] for r in good if r[0] % every == 0}):
        _, label, q = min(r for r in good if r[0] == a)
        scored = sorted((-sum(s * t for s, t in zip(q, x)), i, l == label) for i, l, x in good if i != a and len(x) == len(q))
        for p, i, _ in [s for s in scored if s[2]][:top]:
            fits = [(s, j) for s, j, same in scored if not same and near * -p <= 100 * -s <= 100 * -p]
            out += [(a, i, k + 1, j, -p, -s) for k, (s, j) in enumerate(fits[:top])]
    return sorted(out)


def mined(df, every, **options):
    return sorted(map(tuple, hard.mine(df, F.col("vec_id") % every == 0, F.col("label"), **options).collect()))


def random_rows(seed, n, dim, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    return [(i, [float(np.float32(v)) for v in centres[i % 4] + 0.3 * rng.normal(size=dim)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("shard_rows, leaf", [(10_000, 32), (40, 4), (15, 1)])
def test_equals_all_pairs(spark, monkeypatch, shard_rows, leaf):
    for name, value in {"SHARD_ROWS": shard_rows, "LEAF_ROWS": leaf, "BLOCK_QUERIES": 3, "BLOCK_BALLS": 2, "REGION_SAMPLE": 30}.items():
        monkeypatch.setattr(hard, name, value)
    rows = random_rows(shard_rows, 240, 6)
    rows += [(300 + i, rows[0][1], i % 3) for i in range(60)]  # equal vectors: ties go to smaller ids
    rows += [(400, None, 1), (410, [math.nan] * 6, 1), (420, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (430, [math.inf] + [0.0] * 5, 2), (440, rows[3][1], None), (None, [1.0] * 6, 0)]
    rows += [rows[10], rows[20], (30, rows[7][1], 2), (450, [0.0] * 6, 0), (460, [], 1), (470, [], 2), (480, [1.0, 2.0], 0), (481, [1.0, 2.5], 0), (482, [1.0, 2.4], 1)]
    assert mined(frame(spark, rows), 10) == brute(rows, 10)


def test_few_rows(spark):
    assert mined(frame(spark, []), 10) == []
    assert mined(frame(spark, [(0, [1.0], 1)]), 10) == []
    assert mined(frame(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (3, [0.5], 2), (4, [1.1], 2)]), 10) == [(0, 1, 1, 2, 65536, 58880)]
    zero = [(0, [0.0], 1), (1, [5.0], 1), (2, [-3.0], 2), (3, [7.0], 3)]
    assert mined(frame(spark, zero), 10) == [(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)] == brute(zero, 10)


def test_negative_scores_have_no_negatives(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-1.0, 0.1], 2), (3, [-0.9, 0.0], 2)]
    assert mined(frame(spark, rows), 10) == [] == brute(rows, 10)


def test_large_components(spark):
    rows = [(0, [3.0e6, 1.0], 1), (1, [3.0e6, 2.0], 1), (2, [2.9e6, 1.0], 2), (3, [3.0e6, 1.5], 2), (4, [-3.0e6, 0.0], 2)]
    assert mined(frame(spark, rows), 10) == brute(rows, 10)


@pytest.mark.parametrize("dim, spread", [(3, 0.05), (8, 0.3), (64, 1.0)])
def test_cover_tree(dim, spread):
    rng = np.random.default_rng(dim)
    x = np.floor(256 * (rng.normal(size=(12, dim))[rng.integers(12, size=1500)] + spread * rng.normal(size=(1500, dim)))).astype(np.int64)
    x[:200] = x[0]
    labels = rng.integers(3, size=1500)
    tree = hard.build(x, labels)
    y, norm = hard.augmented(x)
    assert np.allclose(np.linalg.norm(y, axis=1), norm)
    order = tree["order"]
    assert sorted(order) == list(range(1500))
    y = y[order]
    for i, (start, end, first, count) in enumerate(tree["nodes"]):
        centre, radius = tree["centre"][i], tree["radius"][i]
        distance = np.linalg.norm(y[start:end] - y[centre], axis=1)
        assert start <= centre < end and distance.max() <= radius <= distance.max() * 1.001 + norm * 1e-6
        assert tree["mixed"][i] == (len(set(labels[order[start:end]])) > 1) and tree["label"][i] == labels[order[start]]
        if count:
            kids = slice(first, first + count)
            assert tree["nodes"][kids][0][0] == start and tree["nodes"][kids][-1][1] == end
            assert (tree["nodes"][kids][1:, 0] == tree["nodes"][kids][:-1, 1]).all()
            assert tree["centre"][first] == centre  # the centre stays one of its children's
            net = y[tree["centre"][kids]]
            apart = np.linalg.norm(net[:, None] - net[None], axis=2) + np.diag([np.inf] * count)
            assert apart.min() > radius / hard.SHRINK - norm * 1e-6
            assert (tree["radius"][kids] <= radius / hard.SHRINK + norm * 1e-6).all()
    if dim < 64:
        shard = hard.Shard(np.arange(1500)[order], labels[order], x[order], tree)
        shard.search(-1, 0, x[700], np.array([hard.LOW]), np.array([hard.HIGH]), True, 5)
        assert shard.visited < 1000  # most leaves are never opened


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_rows(hard.op11_hard_negatives(spark, sf)) == duck_rows(sf, hard.ORACLE)
