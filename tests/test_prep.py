"""Imputation, scaling and encoding against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import prep
from tidemark.operators.prep import FeaturePipeline
from tidemark.specs import CategoricalFeatureSpec, NumericFeatureSpec, categorical_features, numeric_features

NAN = float("nan")
VALUES = [1.0, 2.0, None, 6.0, NAN, 3.0, 2.0, -4.0]
KINDS = ["b", "a", None, "b", "c", "a", "a", "b"]


@pytest.fixture
def df(spark):
    rows = [(i, v, k) for i, (v, k) in enumerate(zip(VALUES, KINDS))]
    return spark.createDataFrame(rows, "id int, x double, kind string")


def column(frame, name):
    return [r[name] for r in frame.orderBy("id").collect()]


def known():
    return np.array([v for v in VALUES if v is not None and v == v])


def filled(value):
    return np.array([v if v is not None and v == v else value for v in VALUES])


@pytest.mark.parametrize("strategy, value", [("mean", known().mean()), ("median", np.median(known())), ("constant", -9.0)])
@pytest.mark.parametrize("scaler", ["none", "standard", "robust"])
@pytest.mark.parametrize("limit", [10**6, 2])
def test_impute_then_scale(df, strategy, value, scaler, limit):
    spec = NumericFeatureSpec(feature_name="x", imputer_strategy=strategy, imputer_fill_value=-9.0, scaler_type=scaler)
    full = filled(value)
    wanted = full
    if scaler == "standard":
        wanted = (full - full.mean()) / full.std()
    if scaler == "robust":
        wanted = (full - np.median(full)) / (np.quantile(full, 0.75) - np.quantile(full, 0.25))
    got = column(FeaturePipeline([spec], max_rows=limit).fit_transform(df), "x")
    assert got == pytest.approx(list(wanted), abs=1e-12)


def test_without_imputer_missing_stays_missing(df):
    spec = NumericFeatureSpec(feature_name="x", imputer_enabled=False)
    wanted = [(v - known().mean()) / known().std() if v is not None and v == v else None for v in VALUES]
    got = column(FeaturePipeline([spec]).fit_transform(df), "x")
    assert [g is None for g in got] == [w is None for w in wanted]
    assert [g for g in got if g is not None] == pytest.approx([w for w in wanted if w is not None])


def test_constant_column_is_not_divided_by_zero(df):
    out = FeaturePipeline(numeric_features(["c"])).fit_transform(df.withColumn("c", F.lit(3)))
    assert column(out, "c") == [0.0] * 8
    out = FeaturePipeline(numeric_features(["c"], scaler_type="robust")).fit_transform(df.withColumn("c", F.lit(3)))
    assert column(out, "c") == [0.0] * 8


def test_most_frequent_takes_the_smallest_of_equals(df):
    out = FeaturePipeline(categorical_features(["kind"], encoder_type="none")).fit_transform(df)
    assert column(out, "kind") == ["b", "a", "a", "b", "c", "a", "a", "b"]


def test_one_hot(df):
    fitted = FeaturePipeline(categorical_features(["kind"])).fit(df)
    out = fitted.transform(df)
    assert out.columns == ["kind_b", "kind_c", "id", "x"]
    assert column(out, "kind_b") == [1, 0, 0, 1, 0, 0, 0, 1]
    other = df.withColumn("kind", F.lit("never seen"))
    assert column(fitted.transform(other), "kind_b") == [0.0] * 8
    assert column(fitted.transform(other), "kind_c") == [0.0] * 8


def test_fill_value_becomes_a_category(df):
    specs = categorical_features(["kind"], imputer_strategy="constant", imputer_fill_value="_")
    assert FeaturePipeline(specs).fit(df).output_names() == ["kind_a", "kind_b", "kind_c"]
    full = df.filter("kind IS NOT NULL")
    assert FeaturePipeline(specs).fit(full).output_names() == ["kind_b", "kind_c"]


def test_columns_with_many_values(df, monkeypatch):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", 1)
    fitted = FeaturePipeline(categorical_features(["kind"])).fit(df)
    assert fitted.output_names() == ["kind_position"]
    out = fitted.transform(df)
    assert out.columns == ["kind_position", "id", "x"]
    # Missing kinds are filled with the commonest one; positions count from the second category.
    narrow = prep.category_positions(df.fillna({"kind": fitted.features[0].fill}), "kind")
    assert column(out, "kind_position") == column(narrow, "kind_position")
    assert column(fitted.transform(df.withColumn("kind", F.lit("never seen"))), "kind_position") == [None] * 8
    wide = df.withColumn("many", F.when(F.col("id") < 6, F.col("id").cast("string")).otherwise("4"))
    out = FeaturePipeline(categorical_features(["many"], encoder_type="none")).fit(wide)
    assert out.features[0].fill == "4"


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_categories_do_not_depend_on_the_rows_order(spark, parts):
    rows = spark.range(0, 3000, 1, parts).select(
        F.concat(F.lit("w"), "id").alias("wide"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("kind")
    )
    specs = [
        *categorical_features(["wide"], encoder_enabled=False),
        *categorical_features(["kind"], imputer_strategy="constant", imputer_fill_value="a_missing"),
    ]
    assert FeaturePipeline(specs).fit(rows.repartition(parts)).features[1].categories == ["a_missing", "x"]


def test_category_positions(df):
    out = prep.category_positions(df, "kind")
    assert out.columns == ["id", "x", "kind", "kind_position"]
    assert column(out, "kind_position") == [0, None, None, 0, 1, None, None, 0]


def test_rest_follows_transformed_columns(df):
    same = CategoricalFeatureSpec(feature_name="kind", imputer_enabled=False, encoder_enabled=False)
    out = FeaturePipeline([same]).fit_transform(df)
    assert out.columns == ["kind", "id", "x"]
    assert column(out, "kind") == KINDS


def test_disabled_features_pass_through(df):
    specs = [NumericFeatureSpec(feature_name="x", enabled=False), *categorical_features(["kind"])]
    assert FeaturePipeline(specs).fit(df).output_names() == ["kind_b", "kind_c"]


def test_fit_is_repeatable_and_independent_of_partitions(df):
    specs = [*numeric_features(["x"]), *categorical_features(["kind"])]
    one, two = FeaturePipeline(specs).fit(df.repartition(1)), FeaturePipeline(specs).fit(df.repartition(5))
    assert column(one.transform(df), "x") == pytest.approx(column(two.transform(df), "x"), abs=1e-12)


def test_errors(df):
    with pytest.raises(ValueError, match="at least one"):
        FeaturePipeline([])
    with pytest.raises(ValueError, match="more than once"):
        FeaturePipeline(numeric_features(["x", "x"]))
    with pytest.raises(ValueError, match="must be fitted"):
        FeaturePipeline(numeric_features(["x"])).transform(df)
    with pytest.raises(ValueError, match="none of the feature specs"), pytest.warns(UserWarning):
        FeaturePipeline(numeric_features(["y"])).fit(df)
    with pytest.warns(UserWarning, match="skipped"):
        assert FeaturePipeline(numeric_features(["x", "y"])).fit(df).output_names() == ["x"]
    with pytest.raises(ValueError, match="not in the frame"):
        FeaturePipeline(numeric_features(["x"])).fit(df).transform(df.drop("x"))
    with pytest.raises(ValueError, match="without any value"):
        FeaturePipeline(numeric_features(["n"])).fit(df.withColumn("n", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="without any value"):
        FeaturePipeline(categorical_features(["n"])).fit(df.withColumn("n", F.lit(None).cast("string")))


def dense(frame, name="features"):
    return [list(r[name].toArray()) for r in frame.orderBy("id").collect()]


@pytest.mark.parametrize("limit", [1, 1_000])
def test_vectors_mean_the_same_for_few_and_many_categories(df, monkeypatch, limit):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", 1_000)
    specs = [*categorical_features(["kind"]), *numeric_features(["x"], imputer_enabled=False, scaler_type="none")]
    wanted = [[r.kind_b, r.kind_c, r.x] for r in FeaturePipeline(specs).fit_transform(df).orderBy("id").collect()]
    monkeypatch.setattr(prep, "MAX_CATEGORIES", limit)
    fitted = FeaturePipeline(specs).fit(df)
    got = fitted.vectors(df)
    assert got.columns == ["id", "x", "kind", "features"]
    assert np.array(dense(got)) == pytest.approx(np.array([[NAN if v is None else v for v in w] for w in wanted]), nan_ok=True)
    assert sorted(map(tuple, fitted.slots().collect())) == [(0, "kind_b"), (1, "kind_c"), (2, "x")]
    unseen = df.withColumn("kind", F.lit("never seen"))
    assert [v[:2] for v in dense(fitted.vectors(unseen))] == [[0.0, 0.0]] * 8
    assert fitted.vectors(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="already"):
        fitted.vectors(got)


def test_vectors_of_a_column_with_one_category(df, monkeypatch):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", 0)
    specs = [*categorical_features(["kind"]), *numeric_features(["x"], scaler_type="none")]
    same = df.withColumn("kind", F.lit("only"))
    fitted = FeaturePipeline(specs).fit(same)
    assert [len(v) for v in dense(fitted.vectors(same))] == [1] * 8
    assert [tuple(r) for r in fitted.slots().collect()] == [(0, "x")]


def test_vectors_stay_sparse(spark):
    rows = spark.range(3_000).select("id", F.format_string("k%05d", "id").alias("kind"))
    fitted = FeaturePipeline(categorical_features(["kind"])).fit(rows)
    found = {r["id"]: r["features"] for r in fitted.vectors(rows).collect()}
    assert {v.size for v in found.values()} == {2_999}
    assert [list(found[i].indices) for i in (0, 1, 2_999)] == [[], [0], [2_998]]


def test_vectors_name_no_slot_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", 1)
    rows = spark.range(200).select("id", F.format_string("k%05d", "id").alias("kind"), F.when(F.col("id") > 0, F.col("id") - 1.0).alias("x"))
    fitted = FeaturePipeline([*categorical_features(["kind"]), *numeric_features(["x"], imputer_enabled=False, scaler_type="none")]).fit(rows)
    for stage in ("OneHotEncoderModel", "VectorAssembler"):  # both write a name for each slot into the plan
        monkeypatch.setattr(f"pyspark.ml.feature.{stage}._transform", lambda *_: pytest.fail("names every slot"))
    found = {r["id"]: r["features"] for r in fitted.vectors(rows).collect()}
    assert {v.size for v in found.values()} == {200} and {len(v.indices) for v in found.values()} == {1, 2}
    assert found[5].toArray()[[3, 4, 5, 199]].tolist() == [0.0, 1.0, 0.0, 4.0]
    assert list(found[0].indices) == [199] and np.isnan(found[0].values[0])
    narrow = spark.createDataFrame([(0, 1.0, 0.0), (1, float("nan"), float("inf")), (2, -0.5, None)], "id int, a double, b double")
    specs = numeric_features(["a", "b"], imputer_enabled=False, scaler_type="none")
    got = dense(FeaturePipeline(specs).fit(narrow).vectors(narrow))
    assert np.array(got) == pytest.approx(np.array([[1.0, 0.0], [NAN, np.inf], [-0.5, NAN]]), nan_ok=True)
