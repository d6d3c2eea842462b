"""Latest-value tables in batch and from a stream, and the store over them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import LatestTable, latest_per_key
from tidemark.plans.queries import QUERIES
from tidemark.plans.store import FeatureStore
from tidemark.session import new_folder
from tidemark.sources.tables import FeatureSource, write_table
from tidemark.specs import Entity, FeatureView
from tidemark.streaming.latest_stream import expiring_table, latest_changes, stream_expiring, stream_into

START = datetime(2024, 1, 1)
SCHEMA = "k long, ts timestamp_ntz, made int, v double"


def day(n):
    return START + timedelta(days=n)


@pytest.fixture
def history(spark):
    rows = [(k, day(d), m, 100.0 * k + 10 * d + m) for k in range(3) for d in range(k, 9) for m in (0, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def new_table(spark):
    return LatestTable(spark, new_folder(spark, "latest"), ["k"], "ts", created="made")


def values(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_latest_takes_the_later_creation(history):
    assert values(latest_per_key(history, ["k"], "ts", ["v"], created="made")) == {0: 81.0, 1: 181.0, 2: 281.0}


def test_incremental_equals_batch(spark, history):
    table = new_table(spark)
    for n in (1, 4, 6):
        table.materialize_incremental(history, ["v"], day(n))
    whole = new_table(spark).materialize(history, ["v"], day(0), day(6))
    assert values(table.read()) == values(whole.read()) == {0: 61.0, 1: 161.0, 2: 261.0}
    assert table.covered_until() == day(6)
    before = sorted(table.read().collect())
    table.materialize_incremental(history, ["v"], day(6))
    assert sorted(table.read().collect()) == before
    table.materialize_incremental(history, ["v"])
    assert values(table.read())[0] == 81.0


def test_each_update_writes_only_its_own_rows(spark, history):
    table = new_table(spark)
    table.materialize_incremental(history, ["v"], day(1)).materialize_incremental(history, ["v"], day(2))
    deltas = spark.read.parquet(f"{table.path}/rows").groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in deltas} == {0: 2, 1: 3}


def test_compact_keeps_the_rows(spark, history):
    table = new_table(spark)
    table.materialize_incremental(history, ["v"], day(3)).materialize_incremental(history, ["v"], day(5))
    smaller = table.compact(new_folder(spark, "compact"))
    assert sorted(smaller.read().collect()) == sorted(table.read().collect())
    assert smaller.covered_until() == day(5)


def test_folding_keeps_rows_and_bounds_runs(spark, history):
    table, plain = new_table(spark), new_table(spark)
    for n in range(9):
        for t in (table, plain):
            t.materialize_incremental(history, ["v"], day(n))
        table.fold(2)
        assert sorted(table.read().collect()) == sorted(plain.read().collect())
        assert len(table.runs()) <= 5  # at most one of each level, but for the newest
    assert len(plain.runs()) == 9 and table.covered_until() == plain.covered_until() == day(8)
    assert max(table._level(o) for o, _ in table.runs()) == 3
    table.fold(2)
    assert sorted(table._folders()) == sorted(table.runs())  # what a fold stands for has gone


def test_replayed_batch_after_a_fold(spark, history):
    table = new_table(spark)
    for n in (1, 3, 5):
        table.materialize_incremental(history, ["v"], day(n))
    before = sorted(table.read().collect())
    late = latest_per_key(history.filter(F.col("ts") <= F.lit(day(1))), ["k"], "ts", ["ts", "made", "v"], created="made")
    table.fold(3).write_batch(late, 0, day(1))  # the folded batch comes again
    assert sorted(table.read().collect()) == before
    assert sorted(table.fold(2).read().collect()) == before


def test_fold_that_was_not_noted_changes_nothing(spark, history, monkeypatch):
    table = new_table(spark)
    for n in (1, 3):
        table.materialize_incremental(history, ["v"], day(n))
    before = sorted(table.read().collect())
    write = table._write_run
    monkeypatch.setattr(table, "_write_run", lambda *a: write(*a) or (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.fold(2)
    assert sorted(table.read().collect()) == before
    monkeypatch.undo()
    assert sorted(table.fold(2).read().collect()) == before


def test_lookup_of_few_keys_reaches_the_scan(spark, history):
    table = new_table(spark).materialize(history, ["v"], day(0), day(9))
    found = table.lookup(spark.createDataFrame([(1,)], "k int"), ["v"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "PushedFilters" in x and "_bucket" in x)
    assert "EqualTo(k,1)" in scan or "In(k, [1])" in scan
    assert {r["k"]: r["v"] for r in found.collect()} == {1: 181.0}


def test_stream_with_folds(spark, history):
    arriving, table = new_folder(spark, "in"), new_table(spark)
    history.repartition(5).write.parquet(arriving)
    stream = spark.readStream.schema(history.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    stream_into(table, stream, ["v"], new_folder(spark, "check"), fold_every=2).awaitTermination()
    assert values(table.fold(2).read()) == {0: 81.0, 1: 181.0, 2: 281.0} and len(table.runs()) <= 3


def test_lookup(spark, history):
    table = new_table(spark)
    keys = spark.createDataFrame([(1,), (7,), (1,)], "k long")
    with pytest.raises(RuntimeError, match="nothing has been materialised"):
        table.lookup(keys, ["v"])
    table.materialize(history, ["v"], day(0), day(9))
    found = table.lookup(keys, ["v"], view="w", full_names=True)
    assert sorted((r["k"], r["w__v"] or -1) for r in found.collect()) == [(1, 181.0), (1, 181.0), (7, -1)]


def test_stream_equals_batch_with_late_and_replayed_rows(spark, history):
    arriving, table, checkpoint = new_folder(spark, "in"), new_table(spark), new_folder(spark, "check")
    late_first = history.withColumn("slot", F.when(F.col("ts") > F.lit(day(4)), 0).otherwise(1))
    for slot in (0, 1):
        late_first.filter(F.col("slot") == slot).drop("slot").coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(history.schema).parquet(arriving)
        stream_into(table, stream, ["v"], checkpoint).awaitTermination()
    assert values(table.read()) == {0: 81.0, 1: 181.0, 2: 281.0}
    replay = spark.readStream.schema(history.schema).parquet(arriving)
    stream_into(table, replay, ["v"], new_folder(spark, "check")).awaitTermination()
    assert values(table.read()) == {0: 81.0, 1: 181.0, 2: 281.0}


def test_stream_and_batches_do_not_overwrite_each_other(spark, history):
    arriving, table = new_folder(spark, "in"), new_table(spark)
    table.materialize(history.filter("k = 0"), ["v"], day(0), day(9))
    history.filter("k > 0").write.parquet(arriving)
    stream = spark.readStream.schema(history.schema).parquet(arriving)
    stream_into(table, stream, ["v"], new_folder(spark, "check")).awaitTermination()
    assert sorted(values(table.read())) == [0, 1, 2]
    assert table.covered_until() == day(9)


@pytest.fixture
def store(spark, history):
    path = write_table(history.withColumn("w", F.col("v") * 2), new_folder(spark, "features"))
    made = FeatureStore(spark, new_folder(spark, "online"))
    source = FeatureSource(path, "ts", created_column="made")
    entity = Entity(name="thing", join_keys=["k"])
    made.register(
        [
            FeatureView(view_name="short", source=source, features=["v"], entity=entity, ttl_days=1),
            FeatureView(view_name="long", source=source, features=["v", "w"], entity=entity),
        ]
    )
    return made


def test_store_history(spark, store):
    asked = spark.createDataFrame([(0, day(2)), (2, day(1)), (1, day(30))], "k long, event_timestamp timestamp_ntz")
    rows = store.get_features(asked, ["short:v", "long:w"]).collect()
    assert {r["k"]: (r["v"], r["w"]) for r in rows} == {0: (21.0, 42.0), 2: (None, None), 1: (None, 362.0)}
    named = store.get_features(asked, ["v"], view="long", full_names=True)
    assert named.columns == ["k", "event_timestamp", "long__v"]
    data = store.get_training_data(asked, ["v"], "w", "long")
    assert data.columns == ["k", "v", "w"]
    assert [r[0] for r in store.get_entity_values("k", "long").collect()] == [0, 1, 2]
    with pytest.raises(ValueError, match="not registered"):
        store.get_features(asked, ["v"], view="other")
    with pytest.raises(ValueError, match="names no view"):
        store.get_features(asked, ["v"])
    with pytest.raises(ValueError, match="view or a path"):
        store.get_entity_values("k")


def test_store_latest(spark, store):
    asked = spark.createDataFrame([(0,), (2,)], "k long")
    store.materialize("long", day(0), day(3))
    assert {r["k"]: r["w"] for r in store.get_online_features(asked, ["w"], "long").collect()} == {0: 62.0, 2: 462.0}
    store.materialize_incremental("long", day(5))
    assert {r["k"]: r["w"] for r in store.get_online_features(asked, ["long:w"]).collect()} == {0: 102.0, 2: 502.0}
    with pytest.raises(RuntimeError, match="online_root"):
        FeatureStore(spark).get_online_features(asked, ["w"], "long")


def test_stream_with_expiry(spark):
    """Late rows, ties, rows that repeat, null keys and times, a key that comes back; over a restart."""
    table = expiring_table(spark, new_folder(spark, "latest"), ["k"], "ts", tiebreak=["made"])
    arriving, checkpoint = new_folder(spark, "arriving"), new_folder(spark, "check")

    def arrive(*rows):
        frame = spark.createDataFrame([(*r, "extra") for r in rows], f"{SCHEMA}, expired_by string")
        frame.coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
        stream_expiring(table, stream, ["v"], checkpoint, timedelta(days=3), timedelta(days=1)).awaitTermination()
        return {r["k"]: (r["ts"], r["v"], r["expired"]) for r in table.read().collect()}

    first = arrive((1, day(0), 1, 1.0), (1, day(0), 2, 2.0), (1, day(0), 2, 2.0), (2, day(1), 0, 3.0), (2, day(0), 9, 4.0), (None, day(1), 0, None), (3, None, 0, 5.0))
    assert first == {1: (day(0), 2.0, False), 2: (day(1), 3.0, False), None: (day(1), None, False)}
    # Event time becomes day 3.5: key 1 expires; its row of day 4 then brings it back.
    second = arrive((4, day(4.5), 0, 6.0), (2, day(3.6), 0, 7.0))
    assert second[1] == (day(0), 2.0, True) and second[2] == (day(3.6), 7.0, False) and second[None] == (day(1), None, False)
    # A row behind event time changes nothing; null keys expire like others.
    third = arrive((1, day(4), 0, 8.0), (4, day(1), 0, 9.0), (4, day(5.5), 0, 10.0))
    assert third == {1: (day(4), 8.0, False), 2: (day(3.6), 7.0, False), 4: (day(5.5), 10.0, False), None: (day(1), None, True)}


def test_an_arrival_of_many_files_is_one_batch(spark):
    """Every file spans days; rows of one must not be late for what another of the same arrival has seen."""
    sf = new_folder(spark, "events")
    rows = [(u, day((0.1, 4, 29.9)[u % 3]), u, "view", 1.0, "{}") for u in range(60)]
    for start in range(0, 60, 12):
        frame = spark.createDataFrame(rows[start : start + 12], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        frame.coalesce(1).write.mode("append").parquet(f"{sf}/events.parquet")
    found = {r["user_id"]: (r["ts"], r["expired"]) for r in QUERIES["stream_expiry"](spark, sf).collect()}
    assert found == {u: (ts, u % 3 != 2) for _, ts, u, *_ in rows}


def test_expiry_needs_its_own_table_and_names(spark, history):
    with pytest.raises(ValueError, match="expiring_table"):
        stream_expiring(new_table(spark), history, ["v"], "unused", timedelta(1), timedelta(1))
    with pytest.raises(ValueError, match="row"):
        latest_changes(history.withColumnRenamed("v", "row"), ["k"], "ts", ["row"], timedelta(1), timedelta(1))
    with pytest.raises(ValueError, match="array"):
        latest_changes(history.withColumn("made", F.array("made")), ["k"], "ts", ["v"], timedelta(1), timedelta(1), "made")
