"""Validation and the training workflow."""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import natural_key
from tidemark.operators.asof import entity_frame, training_set
from tidemark.operators.calibrate import CalibratedPipeline
from tidemark.operators.checks import class_list
from tidemark.operators.metrics import accuracy
from tidemark.operators.model import ClassifierPipeline, check_rows
from tidemark.operators.select import feature_columns
from tidemark.operators.splits import ordered_stratified_folds, train_test_split
from tidemark.operators.tuning import search
from tidemark.session import write_through
from tidemark.specs import CalibrationSpec, ClassifierSpec, FeatureSpec, FeatureStoreSpec, TuningSpec

STRATEGIES = ("cross_validation", "train_test", "none")


def _accuracy_of(fitted, df: DataFrame, label: str) -> float:
    return accuracy(fitted.transform(df), label, "prediction").first()[0]


def cross_validate(
    pipeline,
    df: DataFrame,
    key: str,
    label: str,
    folds: int = 5,
    parallelism: int = 4,
    stored: bool = False,
) -> DataFrame:
    """Rows (fold, score): accuracy on each unshuffled stratified fold.

    ``pipeline`` is anything with ``fit(df, label, classes)`` and ``input_columns``. The
    needed columns are written once unless ``df`` is a ``stored`` table.
    """
    classes = class_list(df, label)
    narrow = df.select(*dict.fromkeys([key, *pipeline.input_columns(df), label]))
    folded = ordered_stratified_folds(narrow, key, label, folds, "_cv")
    if not stored:
        folded = write_through(folded, "validation", "_cv")

    # Preprocessing of all training sides comes from one pass; a calibrated pipeline has folds within them.
    prep = pipeline.prep.fit_folds(folded, "_cv", folds) if isinstance(pipeline, ClassifierPipeline) else None

    def one(fold: int) -> tuple[int, float]:
        known = {"prep": prep[fold]} if prep else {}
        fitted = pipeline.fit(folded.filter(F.col("_cv") != fold), label, classes, **known)
        return fold, _accuracy_of(fitted, folded.filter(F.col("_cv") == fold), label)

    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(one, range(folds)))
    return df.sparkSession.createDataFrame(scores, "fold int, score double")


def score_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of fold scores."""
    return scores.agg(F.avg("score").alias("cv_score"), F.stddev_pop("score").alias("cv_std"))


def holdout_validate(
    pipeline,
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    refit: bool = False,
    stored: bool = False,
) -> tuple[Any, dict[str, Any]]:
    """Fit on a stratified train part and score the rest; ``refit`` fits on all rows afterwards."""
    classes = class_list(df, label)
    narrow = df.select(*dict.fromkeys([key, *pipeline.input_columns(df), label]))
    split = train_test_split(narrow, key, label, test_size, seed, "_test")
    if not stored:
        split = write_through(split, "holdout", "_test")
    train, test = split.filter("NOT _test"), split.filter("_test")
    fitted = pipeline.fit(train, label, classes)
    sizes = split.agg(F.count_if(~F.col("_test")), F.count_if("_test")).first()
    result = {
        "validation_strategy": "train_test",
        "test_score": _accuracy_of(fitted, test, label),
        "train_size": sizes[0],
        "test_size": sizes[1],
    }
    return (pipeline.fit(split, label, classes) if refit else fitted), result


@dataclass
class WorkflowResult:
    """Everything a run produced."""

    pipeline: Any
    model_spec: ClassifierSpec
    feature_specs: list[FeatureSpec]
    feature_store: dict[str, Any] = field(default_factory=dict)
    tuning_summary: dict[str, Any] | None = None
    calibration_summary: dict[str, Any] | None = None
    validation: dict[str, Any] = field(default_factory=dict)
    train_metrics: dict[str, float] = field(default_factory=dict)

    def to_dict(self) -> dict[str, Any]:
        found = {
            "pipeline": self.pipeline,
            "model_spec": self.model_spec,
            "feature_specs": self.feature_specs,
            **self.feature_store,
            **self.validation,
        }
        for name in ("tuning_summary", "calibration_summary", "train_metrics"):
            if getattr(self, name):
                found[name] = getattr(self, name)
        return found

    def summary(self) -> dict[str, Any]:
        chosen = ("validation_strategy", "cv_score", "cv_std", "test_score")
        return {
            "model_name": self.model_spec.model_name,
            "algorithm": self.model_spec.algorithm,
            **{k: v for k, v in self.validation.items() if k in chosen},
            **self.train_metrics,
        }

    def metric_rows(self, spark) -> DataFrame:
        """The numbers of the run as rows (metric, value), ready to be written."""
        rows = [(k, float(v)) for k, v in self.summary().items() if isinstance(v, (int, float))]
        return spark.createDataFrame(rows, "metric string, value double")


def feature_store_rows(
    table: DataFrame,
    spec: FeatureStoreSpec,
    key: str,
    label: str,
    ingested: str = "ingested_at",
) -> DataFrame:
    """Training rows as of one moment: the given one, or just after the newest ingest.

    Features older than ``spec.ttl_days`` at that moment are null. With full names features are
    called ``<view>__<feature>``; the label keeps its name.
    """
    features = feature_columns(table, (key, label, ingested, "ingested_date"))
    if spec.n_features is not None:
        features = sorted(features, key=natural_key)[: spec.n_features]
    entities = entity_frame(table, key, spec.timestamp, ingested, spec.sample_indices)
    naming = {"view": spec.feature_view_name, "full_names": spec.use_full_feature_names}
    rows = training_set(entities, table, [key], ingested, features, label, ttl=timedelta(days=spec.ttl_days), **naming)
    return rows.withColumnRenamed(f"{spec.feature_view_name}__{label}", label) if spec.use_full_feature_names else rows


def run_workflow(
    df: DataFrame,
    key: str,
    label: str,
    feature_specs: list[FeatureSpec],
    model_spec: ClassifierSpec,
    validation: str = "cross_validation",
    cv_folds: int = 5,
    test_size: float = 0.2,
    random_state: int = 42,
    tuning_spec: TuningSpec | None = None,
    calibration_spec: CalibrationSpec | None = None,
    feature_store_spec: FeatureStoreSpec | None = None,
    feature_table: DataFrame | None = None,
    continue_on_failure: bool = False,
    refit: bool = False,
) -> WorkflowResult:
    """Get the rows, tune, fit, calibrate and validate.

    A failing feature store, search or calibration raises; with ``continue_on_failure`` it is
    reported as a warning and the run goes on without that stage.
    """
    if validation not in STRATEGIES:
        raise ValueError(f"validation must be one of {STRATEGIES}, got {validation!r}")
    if not model_spec.enabled:
        raise ValueError(f"the model spec {model_spec.model_name!r} is disabled")

    def stage(name: str, work, otherwise):
        try:
            return work()
        except Exception as error:
            if not continue_on_failure:
                raise
            warnings.warn(f"{name} failed ({error}); going on without it", stacklevel=3)
            return otherwise

    store_info: dict[str, Any] = {}
    if feature_store_spec is not None and feature_store_spec.enabled:

        def fetch() -> DataFrame:
            if feature_table is None:
                raise ValueError("the feature store needs a feature table")
            rows = feature_store_rows(feature_table, feature_store_spec, key, label)
            store_info.update(feature_store_enabled=True, feature_view=feature_store_spec.feature_view_name)
            return rows

        df = stage("feature store", fetch, df)

    pipeline = ClassifierPipeline(feature_specs, model_spec)
    # The search, the fits and the validation all read these rows.
    rows = write_through(df.select(*dict.fromkeys([key, *pipeline.input_columns(df), label])), "training")
    prep = check_rows(rows, pipeline, label)
    classes = class_list(rows, label)
    result = WorkflowResult(pipeline, model_spec, list(feature_specs), store_info)

    fitted = None
    if tuning_spec is not None and tuning_spec.enabled:
        found = stage("tuning", lambda: search(tuning_spec, pipeline, rows, label, key, random_state, True), None)
        if found is not None:
            pipeline, fitted = found.best_pipeline, found.best_model
            result.tuning_summary = found.summary()
    fitted = fitted or pipeline.fit(rows, label, classes, prep=prep)

    trainer: Any = pipeline
    if calibration_spec is not None and calibration_spec.enabled:
        wrapped = CalibratedPipeline(pipeline, calibration_spec, key, random_state, stored=True)
        if calibration_spec.cv_strategy == "prefit":
            warnings.warn("the classifier is calibrated on the rows it was fitted on", stacklevel=2)
        calibrated = stage("calibration", lambda: wrapped.fit(rows, label, classes, model=fitted), None)
        if calibrated is not None:
            fitted, trainer = calibrated, wrapped
            result.calibration_summary = calibrated.summary()

    if validation == "cross_validation":
        scores = cross_validate(trainer, rows, key, label, cv_folds, stored=True)
        numbers = score_summary(scores).first()
        result.validation = {
            "validation_strategy": validation,
            "cv_score": numbers["cv_score"],
            "cv_std": numbers["cv_std"],
            "cv_scores": [r["score"] for r in scores.orderBy("fold").collect()],
        }
    elif validation == "train_test":
        fitted, result.validation = holdout_validate(
            trainer, rows, key, label, test_size, random_state, refit, stored=True
        )
    else:
        result.validation = {"validation_strategy": "none"}

    result.pipeline = fitted
    result.train_metrics = {r["metric"]: r["value"] for r in fitted.evaluate(rows).collect()}
    return result
