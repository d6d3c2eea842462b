"""Sources, sinks, checks and column choice."""

from datetime import date, datetime

import pytest
import synth
from pyspark.sql import functions as F

from tidemark.operators import checks, select
from tidemark.session import new_folder, shared_root, write_through
from tidemark.sources import tables


@pytest.fixture
def df(spark):
    rows = [(i, float(i), "ab"[i % 2], datetime(2024, 1, 1 + i % 3)) for i in range(30)]
    return spark.createDataFrame(rows, "sample_index long, feature_0 double, kind string, ingested_at timestamp_ntz")


def test_missing_table(spark):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, "/no/such/table")
    with pytest.raises(ValueError, match="Delta"):
        tables.read_table(spark, "/no/such/table", version=1)


def test_write_modes(spark, df):
    path = new_folder(spark, "table")
    tables.write_table(df, path)
    tables.write_table(df, path)
    assert tables.read_table(spark, path).count() == 30
    tables.write_table(df, path, mode="append")
    assert tables.read_table(spark, path).count() == 60
    with pytest.raises(ValueError, match="mode"):
        tables.write_table(df, path, mode="merge")
    with pytest.raises(ValueError, match="partition columns"):
        tables.write_table(df, path, partition_by=["nope"])


def test_partitioned_write_prunes(spark, df):
    path = tables.write_table(df, new_folder(spark, "table"), partition_by=["kind"])
    part = tables.read_table(spark, path).filter("kind = 'a'")
    assert part.count() == 15
    assert "PartitionFilters: [isnotnull(kind" in part._jdf.queryExecution().executedPlan().toString()


def test_info_and_profile(spark, df):
    path = tables.write_table(df, new_folder(spark, "table"))
    info = tables.describe_table(spark, path).first()
    assert (info["num_rows"], info["num_columns"], info["path"], info["version"]) == (30, 4, path, None)
    assert info["columns"] == "sample_index,feature_0,kind,ingested_at"
    profile = {r["column"]: r for r in tables.column_profile(df.withColumn("feature_0", F.expr("nullif(feature_0, 0)"))).collect()}
    assert profile["feature_0"]["null_count"] == 1
    assert (profile["feature_0"]["min_number"], profile["kind"]["max_text"]) == (1.0, "b")


def test_as_of_read_pushes_the_filter(spark, df):
    path = tables.write_table(df, new_folder(spark, "table"))
    moment = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    assert tables.read_as_of(spark, path, "ingested_at", moment).count() == 20
    plan = tables.read_as_of(spark, path, "ingested_at", moment, ["kind"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingested_at), LessThanOrEqual(ingested_at" in plan


def test_load_labelled(df):
    rows = df.withColumn("target", F.lit(1)).withColumn("feature_10", F.lit(0)).withColumn("feature_2", F.lit(0))
    out = tables.load_labelled(rows.drop("kind"))
    assert out.columns == ["sample_index", "feature_0", "feature_2", "feature_10", "target"]
    with pytest.raises(ValueError, match="label column"):
        tables.load_labelled(df)


def test_generated_rows_do_not_depend_on_partitions(spark):
    one = synth.synth_labelled(spark.range(500), "id", 9, 3).orderBy("sample_index").collect()
    two = synth.synth_labelled(spark.range(500).repartition(7), "id", 9, 3).orderBy("sample_index").collect()
    assert one == two
    assert {r["target"] for r in one} == {0, 1, 2}
    assert [c for c in one[0].asDict() if c.startswith("feature_")] == [f"feature_{i}" for i in range(9)]
    path = synth.create_labelled_table(spark, new_folder(spark, "synth"), 50, 4)
    assert tables.read_table(spark, path).columns == [
        "sample_index", "feature_0", "feature_1", "feature_2", "feature_3", "target", "ingested_at", "ingested_date",
    ]


def test_noise_is_standard_normal(spark):
    row = synth.synth_labelled(spark.range(20_000), "id", 8).agg(F.avg("feature_7"), F.stddev_pop("feature_7")).first()
    assert abs(row[0]) < 0.03 and abs(row[1] - 1) < 0.03


def test_schema(spark, df):
    assert select.feature_columns(df) == ["feature_0", "kind"]
    assert select.feature_references("v", ["a", "b"], "target") == ["v:a", "v:b", "v:target"]
    schema = select.feature_schema(["age", "name"], ["Int64", "String"])
    assert schema.simpleString() == "struct<age:bigint,name:string>"
    assert select.feature_schema(["a"]).simpleString() == "struct<a:double>"
    with pytest.raises(ValueError, match="2 names but 1 types"):
        select.feature_schema(["a", "b"], ["Int64"])
    with pytest.raises(ValueError, match="unknown field types"):
        select.feature_schema(["a"], ["Decimal"])


def test_checks(spark, df):
    bad = df.withColumn("feature_0", F.when(F.col("sample_index") == 3, float("inf")).otherwise(F.col("feature_0")))
    assert [r["sample_index"] for r in checks.quarantine(bad, ["feature_0"]).collect()] == [3]
    checks.require_finite(df, ["feature_0"])
    with pytest.raises(ValueError, match="non-finite"):
        checks.require_finite(bad, ["feature_0"])
    labelled = df.withColumn("y", F.lit(1))
    checks.check_training_frame(labelled, ["feature_0"], "y")
    with pytest.raises(TypeError, match="numeric"):
        checks.check_training_frame(labelled, ["kind"], "y")
    with pytest.raises(ValueError, match="empty"):
        checks.check_training_frame(labelled.limit(0), ["feature_0"], "y")
    with pytest.raises(ValueError, match="30 rows have no label"):
        checks.check_training_frame(df.withColumn("y", F.lit(None).cast("int")), ["feature_0"], "y")
    with pytest.raises(ValueError, match="not in the frame"):
        checks.check_prediction_frame(df, ["feature_1"])
    with pytest.raises(ValueError, match="more than 10 classes"):
        checks.class_list(df, "sample_index", 10)
    assert checks.class_list(df, "kind") == ["a", "b"]


def test_keep_samples(spark, df):
    assert checks.keep_samples(df, "sample_index", None).count() == 30
    assert checks.keep_samples(df, "sample_index", [1, 1, 5, 99]).count() == 2


def test_shared_folder_comes_from_the_session(spark, df):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    kept = write_through(df, "kept", "kind")
    assert kept.columns == df.columns and kept.count() == 30
    assert kept.inputFiles() and all(root in path for path in kept.inputFiles())


def test_profile_from_footers(spark, tmp_path):
    rows = [(i, i % 5 if i % 7 else None, float(i), f"t{i}", i % 2 == 0, date(2024, 1, 1 + i % 9)) for i in range(50)]
    df = spark.createDataFrame(rows, "a long, b int, c double, d string, e boolean, f date")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    before = {n: spark.conf.get(n, None) for n in tables._FOOTERS}
    found = sorted(map(tuple, tables.profile_table(spark, str(tmp_path / "t")).collect()), key=str)
    assert found == sorted(map(tuple, tables.column_profile(stored).collect()), key=str)
    assert {n: spark.conf.get(n, None) for n in tables._FOOTERS} == before
    with tables._settings(spark, tables._FOOTERS):
        plan = tables.footer_extremes(spark, str(tmp_path / "t"), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(a), MIN(a), MAX(a), COUNT(b), MIN(b), MAX(b)]" in plan


def test_profile_of_tables_that_have_no_footers_for_it(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "x"), (None, None)], "c double, d string")
    df.write.parquet(str(tmp_path / "t"))
    assert sorted(map(tuple, tables.profile_table(spark, str(tmp_path / "t")).collect())) == sorted(map(tuple, tables.column_profile(df).collect()))
    nothing = str(tmp_path / "n")
    spark.createDataFrame([(None, 1), (None, 2)], "a date, b int").write.parquet(nothing)
    assert sorted(map(tuple, tables.profile_table(spark, nothing).collect())) == sorted(map(tuple, tables.column_profile(spark.read.parquet(nothing)).collect()))
    empty = str(tmp_path / "e")
    spark.createDataFrame([], "a long, c double").write.parquet(empty)
    assert [tuple(r) for r in tables.profile_table(spark, empty).collect()] == [tuple(r) for r in tables.column_profile(spark.read.parquet(empty)).collect()]
