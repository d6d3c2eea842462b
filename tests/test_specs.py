"""Rules that settings are held to."""

import dataclasses

import pytest

from tidemark import specs as s
from tidemark.sources.tables import FeatureSource


def test_names_are_trimmed_and_not_blank():
    assert s.NumericFeatureSpec(feature_name=" x ").feature_name == "x"
    for make in (
        lambda: s.NumericFeatureSpec(feature_name="  "),
        lambda: s.ClassifierSpec(model_name=""),
        lambda: s.GridSearchSpec(tuning_name=" "),
        lambda: s.CalibrationSpec(calibration_name=""),
        lambda: s.FeatureStoreSpec(dataset_name=" "),
        lambda: s.Entity(name=""),
    ):
        with pytest.raises(ValueError, match="blank"):
            make()


def test_unknown_settings_and_changes_are_refused():
    with pytest.raises(TypeError):
        s.NumericFeatureSpec(feature_name="x", colour="red")
    with pytest.raises(dataclasses.FrozenInstanceError):
        s.NumericFeatureSpec(feature_name="x").scaler_type = "none"


@pytest.mark.parametrize(
    "make",
    [
        lambda: s.NumericFeatureSpec(feature_name="x", imputer_strategy="mode"),
        lambda: s.NumericFeatureSpec(feature_name="x", scaler_type="minmax"),
        lambda: s.NumericFeatureSpec(feature_name="x", imputer_strategy="constant"),
        lambda: s.CategoricalFeatureSpec(feature_name="x", imputer_strategy="mean"),
        lambda: s.CategoricalFeatureSpec(feature_name="x", encoder_type="target"),
        lambda: s.CategoricalFeatureSpec(feature_name="x", imputer_strategy="constant"),
        lambda: s.FeatureSelection(selection_mode="indices"),
        lambda: s.FeatureSelection(selection_mode="names"),
        lambda: s.FeatureSelection(selection_mode="best"),
        lambda: s.FeatureSelection(max_features=0),
        lambda: s.FeatureSelection(selection_mode="indices", feature_indices=[-1]),
        lambda: s.ClassifierSpec(model_name="m", algorithm="forest"),
        lambda: s.ClassifierSpec(model_name="m", evaluation_metrics=["mse"]),
        lambda: s.ClassifierSpec(model_name="m", hyperparameters={"learning_rate": 0}),
        lambda: s.ClassifierSpec(model_name="m", hyperparameters={"learning_rate": 1.5}),
        lambda: s.ClassifierSpec(model_name="m", hyperparameters={"n_estimators": 0}),
        lambda: s.ClassifierSpec(model_name="m", hyperparameters={"min_samples_split": 1}),
        lambda: s.ClassifierSpec(model_name="m", hyperparameters={"subsample": 1.1}),
        lambda: s.GridSearchSpec(tuning_name="t", n_splits=1),
        lambda: s.GridSearchSpec(tuning_name="t", cv_strategy="loo"),
        lambda: s.GridSearchSpec(tuning_name="t", scoring="mse"),
        lambda: s.GridSearchSpec(tuning_name="t", scoring=["f1", "recall"], refit_score="roc_auc"),
        lambda: s.RandomSearchSpec(tuning_name="t", n_iter=0),
        lambda: s.CalibrationSpec(calibration_name="c", method="beta"),
        lambda: s.CalibrationSpec(calibration_name="c", cv_strategy="loo"),
        lambda: s.CalibrationSpec(calibration_name="c", cv_strategy=1),
        lambda: s.FeatureStoreSpec(n_features=0),
        lambda: s.FeatureStoreSpec(n_features=1001),
        lambda: s.FeatureStoreSpec(offline_store_type="dask"),
        lambda: s.FeatureStoreSpec(online_store_type="dynamo"),
        lambda: s.Entity(join_keys=[]),
        lambda: FeatureSource("/a", " "),
        lambda: FeatureSource("/a", "ts", format="xml"),
    ],
)
def test_values_out_of_range(make):
    with pytest.raises(ValueError):
        make()


@pytest.mark.parametrize("settings", [{"n_estimators": 1.5}, {"max_depth": "3"}, {"learning_rate": "fast"}, {"subsample": None}])
def test_values_of_the_wrong_type(settings):
    with pytest.raises(TypeError):
        s.ClassifierSpec(model_name="m", hyperparameters=settings)


def test_defaults():
    assert s.ClassifierSpec(model_name="m").hyperparameters == s.BOOSTING_DEFAULTS
    grid = s.GridSearchSpec(tuning_name="t")
    assert (grid.cv_strategy, grid.n_splits, grid.scorers()) == ("stratified_kfold", 5, {"accuracy": "accuracy"})
    assert s.RandomSearchSpec(tuning_name="t").n_iter == 10
    calibration = s.CalibrationSpec(calibration_name="c")
    assert (calibration.method, calibration.cv_strategy, calibration.ensemble) == ("sigmoid", "prefit", True)
    assert s.CalibrationSpec(calibration_name="c", cv_strategy=3).folds == 3
    view = s.FeatureView(view_name="v", source=None, features=["a"])
    assert (view.ttl_days, view.entity.join_keys) == (365, ("sample_index",))
    source = FeatureSource("/data/features.parquet", "ts")
    assert (source.name, source.format) == ("features_source", "parquet")


def test_selection():
    names = [f"feature_{i}" for i in range(5)]
    assert s.FeatureSelection().pick(names) == names
    assert s.FeatureSelection(selection_mode="indices", feature_indices=[0, 2, 4, 9]).pick(names) == names[::2]
    by_name = s.FeatureSelection(selection_mode="names", feature_names=["feature_3", "x", "feature_1"])
    assert by_name.pick(names) == ["feature_3", "feature_1"]
    assert s.FeatureSelection(exclude_features=["feature_0"], max_features=2).pick(names) == names[1:3]


def test_materialize_only_with_an_online_store():
    assert not s.FeatureStoreSpec(enabled=True, materialize_online=True).should_materialize()
    assert s.FeatureStoreSpec(enabled=True, materialize_online=True, online_store_type="sqlite").should_materialize()
