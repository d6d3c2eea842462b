"""Trees, tuning, calibration and the workflow on generated rows with a known signal."""

import math

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F
from synth import synth_labelled

from tidemark.operators import tuning
from tidemark.operators.calibrate import CalibratedPipeline, calibrate_prefit, isotonic_curve, sigmoid_curve
from tidemark.operators.metrics import roc_auc
from tidemark.operators.model import ClassifierPipeline, tree_parameters
from tidemark.operators.select import assemble
from tidemark.operators.splits import stratified_kfold
from tidemark.plans import workflow as flow
from tidemark.session import write_through
from tidemark.specs import (
    CalibrationSpec,
    ClassifierSpec,
    FeatureStoreSpec,
    GridSearchSpec,
    RandomSearchSpec,
    numeric_features,
)

NAMES = [f"feature_{i}" for i in range(6)]
SMALL = {"n_estimators": 4, "max_depth": 2}


def pipeline(**settings):
    spec = ClassifierSpec(model_name="trees", hyperparameters={**SMALL, **settings}, random_state=1)
    return ClassifierPipeline(numeric_features(NAMES), spec)


@pytest.fixture(scope="module")
def rows(spark):
    made = synth_labelled(spark.range(240), "id", 6, separation=0.6, flip=0.1)
    return write_through(made, "rows")


@pytest.fixture(scope="module")
def fitted(rows):
    return pipeline().fit(rows, "target")


def check_probabilities(scored, classes=2):
    for r in scored.select("probability", "prediction").collect():
        assert len(r["probability"]) == classes
        assert sum(r["probability"]) == pytest.approx(1.0)
        assert all(0 <= p <= 1 for p in r["probability"])
        assert r["prediction"] in range(classes)


def test_fit_and_predict(rows, fitted):
    scored = fitted.predict(rows)
    assert scored.columns == [*rows.columns, "probability", "prediction"]
    assert dict(scored.dtypes)["prediction"] == dict(rows.dtypes)["target"]
    check_probabilities(scored)
    found = {r["metric"]: r["value"] for r in fitted.evaluate(rows).collect()}
    assert set(found) == {"accuracy", "roc_auc", "f1_score"}
    majority = rows.groupBy("target").count().agg(F.max("count")).first()[0] / 240
    assert found["accuracy"] > majority and found["roc_auc"] > 0.7
    with pytest.raises(ValueError, match="empty"):
        fitted.predict(rows.limit(0))
    with pytest.raises(ValueError, match="not in the frame"):
        fitted.predict(rows.drop("feature_3"))


def test_auc_agrees_with_the_library(rows, fitted):
    scored = fitted.transform(rows).select("target", F.col("probability")[1].alias("s"))
    theirs = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="target", numBins=0).evaluate(scored)
    assert roc_auc(scored, "target", "s").first()[0] == pytest.approx(theirs, abs=1e-9)


def test_importance(fitted):
    found = fitted.importance().collect()
    assert [r["feature"] for r in found] == NAMES
    assert sum(r["importance"] for r in found) == pytest.approx(1.0)


def test_text_labels_and_three_classes(rows):
    named = rows.withColumn("target", F.when(F.col("target") == 1, "yes").otherwise("no"))
    assert pipeline().fit(named, "target").classes == ["no", "yes"]
    three = rows.withColumn("target", (F.col("target") + F.when(F.col("feature_5") > 0.8, 1).otherwise(0)).cast("long"))
    model = pipeline().fit(three, "target")
    check_probabilities(model.transform(three), 3)
    assert {r["metric"] for r in model.evaluate(three).collect()} == {"accuracy", "f1_score"}
    assert sum(r["importance"] for r in model.importance().collect()) == pytest.approx(1.0)


def test_settings_of_the_learner():
    found = tree_parameters({"n_estimators": 7, "learning_rate": 0.2, "min_samples_leaf": 3, "subsample": 0.5}, 9)
    assert found == {"maxIter": 7, "maxDepth": 3, "stepSize": 0.2, "minInstancesPerNode": 3, "subsamplingRate": 0.5, "seed": 9}
    with pytest.warns(UserWarning, match="min_samples_split"):
        tree_parameters({"min_samples_split": 5}, None)
    with pytest.raises(ValueError, match="unknown hyperparameters"):
        tree_parameters({"depth": 5}, None)
    with pytest.raises(TypeError):
        ClassifierPipeline(numeric_features(NAMES), "trees")
    with pytest.raises(ValueError, match="classifier__"):
        pipeline().with_parameters({"preprocessor__x": 1})


def test_one_class_is_an_error(rows):
    with pytest.raises(ValueError, match="two classes"):
        pipeline().fit(rows.filter("target = 1"), "target")


def test_candidates():
    grid = GridSearchSpec(tuning_name="g", param_grid={"classifier__max_depth": [1, 2], "classifier__n_estimators": [3, 4, 5]})
    assert len(tuning.candidates(grid)) == 6
    space = RandomSearchSpec(tuning_name="r", param_distributions=grid.param_grid, n_iter=4, random_state=3)
    drawn = tuning.candidates(space)
    assert len(drawn) == 4 and drawn == tuning.candidates(space)
    assert len({tuple(d.items()) for d in drawn}) == 4
    many = RandomSearchSpec(tuning_name="r", param_distributions={"classifier__n_estimators": [1, 2, 3]}, n_iter=5)
    assert len(tuning.candidates(many)) == 3
    with pytest.raises(ValueError, match="must not be empty"):
        tuning.candidates(GridSearchSpec(tuning_name="g"))


def test_grid_search(rows):
    spec = GridSearchSpec(
        tuning_name="g", param_grid={"classifier__n_estimators": [1, 4]}, n_splits=2, random_state=5,
        scoring={"acc": "accuracy", "auc": "roc_auc"}, refit_score="auc",
    )
    found = tuning.search(spec, pipeline(), rows, "target", "sample_index")
    assert found.fold_scores.count() == 2 * 2 * 2 * 2
    table = {r["candidate"]: r for r in found.cv_results().collect()}
    assert table[found.best_index]["rank"] == 1
    assert table[found.best_index]["mean_score"] == pytest.approx(found.best_score)
    assert table[0]["mean_train_score"] is not None
    assert found.summary()["tuning_type"] == "grid_search"
    assert found.best_pipeline.model_spec.hyperparameters["n_estimators"] == found.best_params["classifier__n_estimators"]
    check_probabilities(found.best_model.transform(rows))
    with pytest.raises(TypeError):
        tuning.search("grid", pipeline(), rows, "target", "sample_index")


def test_search_agrees_with_the_library(rows):
    spec = GridSearchSpec(tuning_name="g", param_grid={"classifier__n_estimators": [1, 3]}, n_splits=2, random_state=5)
    plain = ClassifierPipeline(
        numeric_features(NAMES, scaler_type="none"),
        ClassifierSpec(model_name="trees", hyperparameters=SMALL, random_state=1),
    )
    ours = [r["mean_score"] for r in tuning.search(spec, plain, rows, "target", "sample_index").cv_results().orderBy("candidate").collect()]
    folded = stratified_kfold(rows, "sample_index", "target", 2, 5, fold="f")
    data = assemble(folded, NAMES).select("features", F.col("target").cast("double").alias("label"), "f")
    trees = GBTClassifier(maxDepth=2, seed=1)
    grid = ParamGridBuilder().addGrid(trees.maxIter, [1, 3]).build()
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    theirs = CrossValidator(estimator=trees, estimatorParamMaps=grid, evaluator=accuracy, numFolds=2, foldCol="f")
    assert ours == pytest.approx(theirs.fit(data).avgMetrics, abs=1e-9)


def test_sigmoid_is_the_best_curve(spark):
    points = [(x / 40, (x * 7919 % 41) / 41 < x / 40) for x in range(41)]
    df = spark.createDataFrame(points, "s double, t boolean")
    out = sigmoid_curve(df, "s", F.col("t"))(df, "s", "q").collect()
    pos = sum(t for _, t in points)
    neg = len(points) - pos
    target = {True: (pos + 1) / (pos + 2), False: 1 / (neg + 2)}
    # At the optimum the residuals are orthogonal to the constant and to the score.
    assert sum(r["q"] - target[r["t"]] for r in out) == pytest.approx(0, abs=1e-5)
    assert sum((r["q"] - target[r["t"]]) * r["s"] for r in out) == pytest.approx(0, abs=1e-5)


def test_isotonic_rises_and_keeps_the_mean(spark):
    points = [((x * 37 % 50) / 50, (x * 7919 % 53) / 53 < (x * 37 % 50) / 50) for x in range(200)]
    df = spark.createDataFrame(points, "s double, t boolean")
    out = sorted((r["s"], r["q"], r["t"]) for r in isotonic_curve(df, "s", F.col("t"))(df, "s", "q").collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(out, out[1:]))
    assert sum(q for _, q, _ in out) == pytest.approx(sum(t for _, _, t in out))


@pytest.mark.parametrize(
    "settings, members",
    [
        ({}, 1),
        ({"method": "isotonic"}, 1),
        ({"cv_strategy": 2}, 2),
        ({"cv_strategy": "stratified_kfold", "n_splits": 2, "ensemble": False}, 1),
    ],
)
def test_calibration(rows, settings, members):
    spec = CalibrationSpec(calibration_name="c", **settings)
    model = CalibratedPipeline(pipeline(), spec, "sample_index").fit(rows, "target")
    assert model.summary()["n_calibrated_models"] == members
    scored = model.transform(rows)
    assert scored.columns == [*rows.columns, "probability", "prediction"]
    check_probabilities(scored)


def test_calibration_lowers_log_loss_of_a_bad_score(rows, fitted):
    def loss(scored):
        p = F.greatest(F.least(F.col("probability")[1], F.lit(1 - 1e-9)), F.lit(1e-9))
        return scored.agg(F.avg(-F.when(F.col("target") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]

    spec = CalibrationSpec(calibration_name="c")
    assert loss(calibrate_prefit(fitted, rows, "target", spec).transform(rows)) < loss(fitted.transform(rows))


def test_three_classes_calibrated(rows):
    three = rows.withColumn("target", (F.col("target") + F.when(F.col("feature_5") > 0.8, 1).otherwise(0)).cast("long"))
    for method in ("sigmoid", "isotonic"):
        spec = CalibrationSpec(calibration_name="c", method=method)
        check_probabilities(CalibratedPipeline(pipeline(), spec, "sample_index").fit(three, "target").transform(three), 3)


def test_cross_validation_and_holdout(rows):
    scores = flow.cross_validate(pipeline(), rows, "sample_index", "target", 3)
    found = [r["score"] for r in scores.orderBy("fold").collect()]
    assert len(found) == 3 and all(0 <= s <= 1 for s in found)
    summary = flow.score_summary(scores).first()
    mean = sum(found) / 3
    assert summary["cv_score"] == pytest.approx(mean)
    assert summary["cv_std"] == pytest.approx(math.sqrt(sum((s - mean) ** 2 for s in found) / 3))
    _, hold = flow.holdout_validate(pipeline(), rows, "sample_index", "target", 0.25)
    assert hold["train_size"] + hold["test_size"] == 240 and hold["test_size"] == 60


def run(rows, **settings):
    p = pipeline()
    return flow.run_workflow(rows, "sample_index", "target", p.prep.specs, p.model_spec, cv_folds=2, **settings)


def test_plain_workflow(rows):
    found = run(rows).to_dict()
    assert 0 <= found["cv_score"] <= 1 and found["cv_std"] >= 0 and len(found["cv_scores"]) == 2
    assert set(found["train_metrics"]) == {"accuracy", "roc_auc", "f1_score"}
    check_probabilities(found["pipeline"].transform(rows))


def test_full_workflow_from_the_store(spark, rows):
    table = rows.withColumn("ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    result = run(
        rows.limit(0),
        validation="train_test",
        tuning_spec=GridSearchSpec(tuning_name="g", param_grid={"classifier__n_estimators": [2, 4]}, n_splits=2),
        calibration_spec=CalibrationSpec(calibration_name="c", cv_strategy=2),
        feature_store_spec=FeatureStoreSpec(enabled=True),
        feature_table=table,
    )
    found = result.to_dict()
    assert found["feature_store_enabled"] and found["tuning_summary"]["best_score"] > 0
    assert found["calibration_summary"]["n_calibrated_models"] == 2
    assert found["train_size"] + found["test_size"] == 240
    summary = result.summary()
    assert summary["validation_strategy"] == "train_test" and "test_score" in summary
    assert result.metric_rows(spark).count() >= 4


def test_failures_raise_unless_told_otherwise(rows):
    broken = FeatureStoreSpec(enabled=True)
    with pytest.raises(ValueError, match="needs a feature table"):
        run(rows, validation="none", feature_store_spec=broken)
    with pytest.warns(UserWarning, match="feature store failed"):
        found = run(rows, validation="none", feature_store_spec=broken, continue_on_failure=True)
    assert found.summary()["validation_strategy"] == "none"
    with pytest.raises(ValueError, match="validation must be"):
        run(rows, validation="bootstrap")


def test_infinite_features_are_refused(rows):
    bad = rows.withColumn("feature_0", F.when(F.col("sample_index") == 1, float("inf")).otherwise(F.col("feature_0")))
    with pytest.raises(ValueError, match="non-finite"):
        run(bad, validation="none")


def test_prefit_on_the_training_rows_warns(rows):
    with pytest.warns(UserWarning, match="rows it was fitted on"):
        run(rows, validation="none", calibration_spec=CalibrationSpec(calibration_name="c"))


def test_tasks_of_the_tree_learner_hold_bounded_rows(spark, monkeypatch):
    from tidemark.operators import model

    seen, fit = [], model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, rows: seen.extend(rows.rdd.glom().map(len).collect()) or fit(self, rows))
    monkeypatch.setattr(model, "TASK_VALUES", 2_000)
    rows = spark.range(1_000, numPartitions=1).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > 6).cast("int").alias("y"))
    spec = model.ClassifierSpec(model_name="trees", hyperparameters={"n_estimators": 1, "max_depth": 1}, random_state=7)
    fitted = model.ClassifierPipeline(numeric_features(["x"]), spec).fit(rows, "y")
    assert sum(seen) == 1_000 and max(seen) <= 2 * 2_000 // (model.ROW_VALUES + 1)
    assert fitted.transform(rows).filter("prediction = y").count() == 1_000
