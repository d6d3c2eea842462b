"""The point-in-time join against a search through all pairs."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tidemark.operators import asof

START = datetime(2024, 1, 1)


def random_tables(seed, keys=4, n=120, hot=False):
    rng = random.Random(seed)

    def key():
        if rng.random() < 0.05:
            return None
        return 0 if hot and rng.random() < 0.6 else rng.randrange(keys)

    def moment():
        return None if rng.random() < 0.03 else START + timedelta(minutes=rng.randrange(200))

    features = [(key(), moment(), rng.randrange(5), i, None if rng.random() < 0.2 else float(i)) for i in range(n)]
    entities = [(i, key(), moment()) for i in range(n)]
    return entities, features


def frames(spark, entities, features):
    e = spark.createDataFrame(entities, "row int, k int, event_timestamp timestamp_ntz")
    f = spark.createDataFrame(features, "k int, ts timestamp_ntz, made int, id int, v double")
    return e, f


def all_pairs(entities, features, ttl=None):
    found = {}
    for row, k, t in entities:
        fits = [f for f in features if k is not None and f[0] == k and f[1] and t and f[1] <= t]
        best = max(fits, key=lambda f: (f[1], f[2], f[3]), default=None)
        if best and ttl and best[1] < t - ttl:
            best = None
        found[row] = (best[3], best[4]) if best else (None, None)
    return found


def joined(e, f, **options):
    out = asof.as_of_join(e, f, ["k"], "ts", ["id", "v"], created="made", tiebreak=["id"], **options)
    rows = out.collect()
    assert len(rows) == e.count()
    return {r["row"]: (r["id"], r["v"]) for r in rows}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ttl", [None, timedelta(minutes=20)])
def test_equals_all_pairs(spark, seed, ttl):
    entities, features = random_tables(seed)
    e, f = frames(spark, entities, features)
    assert joined(e, f, ttl=ttl) == all_pairs(entities, features, ttl)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [5, 20, 60])
def test_hot_keys_are_cut_without_changing_the_result(spark, seed, hot_rows):
    entities, features = random_tables(seed, n=200, hot=True)
    e, f = frames(spark, entities, features)
    wanted = all_pairs(entities, features, timedelta(minutes=30))
    assert joined(e, f, ttl=timedelta(minutes=30), hot_rows=hot_rows) == wanted


def test_segments_of_hot_keys_are_bounded(spark, monkeypatch):
    entities, features = random_tables(7, n=2000, hot=True)
    e, f = frames(spark, entities, features)
    seen = []
    through = asof.write_through
    monkeypatch.setattr(asof, "write_through", lambda df, label, *a: seen.append((label, through(df, label, *a))) or seen[-1][1])
    folders = []
    new = asof.new_folder
    monkeypatch.setattr(asof, "new_folder", lambda *a: folders.append(new(*a)) or folders[-1])
    assert joined(e, f, hot_rows=100) == all_pairs(entities, features)
    hot = dict(seen)["hot-keys"].collect()
    counts = Counter(r[1] for r in entities) + Counter(r[0] for r in features if r[0] is not None and r[1])
    assert sorted(r._n for r in hot) == sorted(n for n in counts.values() if n > 100)
    sizes = [r["count"] for r in spark.read.parquet(folders[-1]).groupBy("_segment").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 400


def test_small_segments_do_not_become_more_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(asof, "SEGMENTS", 8)
    entities, features = random_tables(7, n=600, hot=True)
    e, f = frames(spark, entities, features)
    folders, new = [], asof.new_folder
    monkeypatch.setattr(asof, "new_folder", lambda *a: folders.append(new(*a)) or folders[-1])
    assert joined(e, f, hot_rows=10) == all_pairs(entities, features)
    assert 1 < spark.read.parquet(folders[-1]).select("_segment").distinct().count() <= 8


def test_segments_keep_to_the_largest_size():
    assert asof._segment_count(36_000_000, 500) == asof.SEGMENTS
    assert asof._segment_count(1_000 * asof.HOT_ROWS, 500) == 1_000
    assert asof._segment_count(1_200, 500) == 3


def test_hot_key_within_one_second(spark):
    rng = random.Random(5)
    def at():
        return START + timedelta(microseconds=rng.randrange(900))

    entities = [(i, 1, at()) for i in range(300)]
    features = [(1, at(), 0, i, float(i)) for i in range(300)]
    e, f = frames(spark, entities, features)
    for hot_rows in (7, 50):
        assert joined(e, f, hot_rows=hot_rows) == all_pairs(entities, features)


def test_segments_without_features_hand_on(spark):
    entities = [(i, k, START + timedelta(minutes=i)) for i in range(200) for k in (1, 2)]
    entities = [(row, k, t) for row, (_, k, t) in enumerate(entities)]
    features = [(1, START, 0, 1, 1.5), (2, START + timedelta(minutes=150), 0, 2, 2.5)]
    e, f = frames(spark, entities, features)
    assert joined(e, f, hot_rows=10) == all_pairs(entities, features)


def test_lifetime_reaches_the_feature_scan(spark, tmp_path):
    entities, features = random_tables(1)
    e, f = frames(spark, entities, features)
    f.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    out = asof.as_of_join(e, stored, ["k"], "ts", ["v"], ttl=timedelta(minutes=5))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan
    assert "ReadSchema: struct<k:int,ts:timestamp_ntz,v:double>" in plan


def test_one_key_and_one_moment_for_all_rows(spark):
    entities = [(i, 1, START) for i in range(300)]
    features = [(1, START, 0, i, float(i)) for i in range(300)]
    e, f = frames(spark, entities, features)
    assert joined(e, f, hot_rows=10) == {i: (299, 299.0) for i in range(300)}


def test_timestamps_with_zone(spark):
    entities, features = random_tables(1)
    e, f = frames(spark, entities, features)
    e = e.withColumn("event_timestamp", e.event_timestamp.cast("timestamp"))
    f = f.withColumn("ts", f.ts.cast("timestamp"))
    for hot_rows in (None, 10):
        assert joined(e, f, ttl=timedelta(minutes=20), hot_rows=hot_rows) == all_pairs(
            entities, features, timedelta(minutes=20)
        )


def test_null_feature_of_the_matched_row_stays_null(spark):
    e, f = frames(spark, [(0, 1, START + timedelta(hours=1))], [(1, START, 0, 1, 5.0), (1, START + timedelta(minutes=1), 0, 2, None)])
    assert joined(e, f) == {0: (2, None)}


def test_full_names_and_clashes(spark):
    e, f = frames(spark, [(0, 1, START)], [(1, START, 0, 1, 5.0)])
    out = asof.as_of_join(e, f, ["k"], "ts", ["v"], view="w", full_names=True)
    assert out.columns == ["row", "k", "event_timestamp", "w__v"]
    with pytest.raises(ValueError, match="already in the entity frame"):
        asof.as_of_join(e.withColumnRenamed("row", "v"), f, ["k"], "ts", ["v"])


def test_entity_frame(spark):
    df = spark.createDataFrame([(1, START), (2, START + timedelta(hours=1)), (2, START)], "sample_index int, ingested_at timestamp_ntz")
    rows = sorted(asof.entity_frame(df, "sample_index").collect())
    assert [tuple(r) for r in rows] == [(i, START + timedelta(hours=1, seconds=1)) for i in (1, 2)]
    rows = asof.entity_frame(df, "sample_index", datetime(2025, 1, 1), samples=[2, 9]).collect()
    assert [tuple(r) for r in rows] == [(2, datetime(2025, 1, 1))]


def test_entity_values(spark):
    df = spark.createDataFrame([(i,) for i in (3, 1, 2, 3)], "sample_index int")
    assert [r[0] for r in asof.entity_values(df, "sample_index").collect()] == [1, 2, 3]
    with pytest.raises(ValueError, match="not found"):
        asof.entity_values(df, "other")


def test_plain_join_shuffles_once(spark):
    entities, features = random_tables(1)
    e, f = frames(spark, entities, features)
    out = asof.as_of_join(e, f, ["k"], "ts", ["v"], hot_rows=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_ties_do_not_depend_on_the_partitions(spark, hot_rows):
    moments = spark.range(5).selectExpr("id AS k", "timestamp_ntz'2024-01-02' AS event_timestamp")
    rows = spark.range(400).selectExpr("id % 5 AS k", "timestamp_ntz'2024-01-01' AS ts", "id AS v")
    found = {
        tuple(sorted(map(tuple, asof.as_of_join(moments, rows.repartition(n), ["k"], "ts", ["v"], hot_rows=hot_rows).collect())))
        for n in (1, 3, 8)
    }
    assert len(found) == 1
