"""Gradient-boosted trees on prepared rows."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions.columns import missing_as_null
from tidemark.operators.boosting import JointTrees, fit_joint
from tidemark.operators.checks import check_prediction_frame, check_training_frame, class_list, require_finite
from tidemark.operators.metrics import evaluate, evaluate_classes
from tidemark.operators.prep import FeaturePipeline, FittedFeatures
from tidemark.session import shared_root
from tidemark.specs import ClassifierSpec, FeatureSpec, check_hyperparameters

# Model settings and the parameters of the tree learner they set.
TREE_PARAMETERS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "random_state": "seed",
    "max_bins": "maxBins",
}


#: Numbers that one task of the tree learner holds, about: of each row its features and some more.
TASK_VALUES = 16_000_000
ROW_VALUES = 16


def check_known(hyperparameters: Mapping[str, Any]) -> None:
    check_hyperparameters(hyperparameters)
    unknown = sorted(set(hyperparameters) - set(TREE_PARAMETERS) - {"min_samples_split", "verbose"})
    if unknown:
        raise ValueError(f"unknown hyperparameters {unknown}")


def tree_parameters(hyperparameters: Mapping[str, Any], seed: int | None) -> dict[str, Any]:
    """The tree learner's parameters for a classifier's settings."""
    check_known(hyperparameters)
    if hyperparameters.get("min_samples_split", 2) != 2:
        warnings.warn("the tree learner has no min_samples_split; the setting has no effect", stacklevel=3)
    found = {TREE_PARAMETERS[k]: v for k, v in hyperparameters.items() if k in TREE_PARAMETERS}
    if seed is not None:
        found.setdefault("seed", seed)
    # Defaults that differ from the tree learner's own.
    return {"maxIter": 100, "maxDepth": 3, **found}


def one_vector(columns: Sequence[Column]) -> Column:
    return array_to_vector(F.array(*[c.cast("double") for c in columns]))


@dataclass
class BoostedTrees:
    """Trees of the tree learner, for two classes."""

    spec: ClassifierSpec
    features: list[str]
    classes: list
    label_type: DataType
    model: Any

    def labels(self) -> Column:
        """The classes as an array of the label's type."""
        return F.array(*[F.lit(c).cast(self.label_type) for c in self.classes])

    def score(self, df: DataFrame, vector: Column, probability: str, prediction: str) -> DataFrame:
        """Add the class probabilities (in the order of ``classes``) and the predicted class."""
        model = self.model.copy()
        model.setFeaturesCol("_x").setPredictionCol("_y").setRawPredictionCol("_r").setProbabilityCol("_p")
        out = model.transform(df.withColumn("_x", vector))
        best = F.element_at(self.labels(), F.col("_y").cast("int") + 1)
        return out.withColumn(probability, vector_to_array("_p")).withColumn(prediction, best).drop("_x", "_y", "_r", "_p")

    def first(self, rounds: int) -> BoostedTrees:
        """The model as it was after so many rounds; it scores, but knows no importances."""
        gateway = self.model._java_obj
        trees, weights = list(gateway.trees())[:rounds], list(gateway.treeWeights())[:rounds]
        context = SparkSession.active().sparkContext
        jvm, make = context._jvm, context._gateway.new_array
        own, shares = make(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees)), make(jvm.double, len(weights))
        for i, (tree, weight) in enumerate(zip(trees, weights)):
            own[i], shares[i] = tree, weight
        made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{self.model.uid}-{rounds}", own, shares)
        return replace(self, model=GBTClassificationModel(made))

    def importance(self) -> DataFrame:
        """Rows (feature, importance); the importances add up to one."""
        found = self.model.featureImportances
        rows = [(name, float(found[i])) for i, name in enumerate(self.features)]
        return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def fit_trees(
    df: DataFrame, vector: Column, label: str, features: Sequence[str], spec: ClassifierSpec, classes: list, places: Mapping[int, int] = {}
) -> BoostedTrees | JointTrees:
    """Two classes go to Spark's tree learner; more, a ``min_samples_split`` or ``places`` to the joint one.

    ``places`` has the number of categories of each feature that is a category's place.
    """
    if len(classes) < 2:
        raise ValueError("at least two classes are needed")
    shared_root(df.sparkSession)  # the learner cuts its lineage there
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    kind = df.schema[label].dataType
    if places or len(classes) > 2 or spec.hyperparameters.get("min_samples_split", 2) > 2:
        check_known(spec.hyperparameters)
        return fit_joint(df, vector, index, kind, features, spec, classes, spec.hyperparameters, places)
    width = {"ml_attr": {"num_attrs": len(features)}}  # else the learner looks at a row, for which it deals out all of them
    rows = df.select(vector.alias("features", metadata=width), index.cast("double").alias("label"))
    rows = _dealt(rows, ROW_VALUES + len(features))
    trees = GBTClassifier(checkpointInterval=10, **tree_parameters(spec.hyperparameters, spec.random_state))
    return BoostedTrees(spec, list(features), classes, kind, trees.fit(rows))


def _dealt(rows: DataFrame, values: int) -> DataFrame:
    """The rows in partitions of about TASK_VALUES numbers at most, if one holds more.

    The learner keeps rows in the partitions that it gets, and files hold very many narrow rows.
    """
    counts = rows.groupBy(F.spark_partition_id().alias("part")).count()
    largest, total = counts.agg(F.max("count"), F.sum("count")).first()
    if not largest or largest * values <= TASK_VALUES:
        return rows
    return rows.repartition(max(-(-total * values // TASK_VALUES), rows.sparkSession.sparkContext.defaultParallelism))


@dataclass
class FittedClassifier:
    """Fitted preprocessing and trees; scoring is one projection over the input rows."""

    prep: FittedFeatures
    passthrough: list[str]
    trees: BoostedTrees | JointTrees
    label: str

    @property
    def classes(self) -> list:
        return self.trees.classes

    def vector(self, df: DataFrame) -> Column:
        return _matrix(self.prep, self.passthrough, df)

    def transform(
        self, df: DataFrame, probability: str = "probability", prediction: str = "prediction"
    ) -> DataFrame:
        """All columns of the frame, with the class probabilities and the predicted class."""
        placed = self.prep.placed(df)
        scored = self.trees.score(placed, self.vector(placed), probability, prediction)
        return scored.drop(*[n for f in self.prep.wide() for n in f.output_names()])

    def predict(self, df: DataFrame) -> DataFrame:
        """``transform`` after checking that the frame has rows and every feature."""
        missing = [f.spec.feature_name for f in self.prep.features if f.spec.feature_name not in df.columns]
        if missing:
            raise ValueError(f"features not in the frame: {missing}")
        check_prediction_frame(df, self.passthrough)
        return self.transform(df)

    def first(self, rounds: int) -> FittedClassifier:
        """The classifier after so many rounds of boosting, without a further fit."""
        return replace(self, trees=self.trees.first(rounds))

    def importance(self) -> DataFrame:
        return self.trees.importance()

    def evaluate(self, df: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
        return evaluate_scored(
            self.transform(df), self.label, self.classes, metrics or self.trees.spec.evaluation_metrics
        )


def evaluate_scored(
    scored: DataFrame,
    label: str,
    classes: list,
    metrics: Sequence[str],
    by: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Metric rows of a frame with ``probability`` and ``prediction`` columns."""
    if len(classes) == 2:
        narrow = scored.select(*by, label, "prediction", F.col("probability")[1].alias("_score"))
        return evaluate(
            narrow, label, "prediction", "_score", metrics, positive=classes[1], by=by, rows=rows
        )
    return evaluate_classes(scored, label, "prediction", metrics, by)


def _matrix(prep: FittedFeatures, passthrough: Sequence[str], df: DataFrame) -> Column:
    """All features of a frame with the positions of wide encoders; a position that is missing is NaN."""
    made = [F.coalesce(c, F.lit(float("nan"))) if f.positions is not None else c for f in prep.features for c in f.columns(df)]
    return one_vector([*made, *[missing_as_null(df, c) for c in passthrough]])


class ClassifierPipeline:
    """Preprocessing and trees as one unit, fitted on the same rows.

    ``passthrough`` names features that go to the trees as they are.
    """

    def __init__(
        self,
        feature_specs: Sequence[FeatureSpec],
        model_spec: ClassifierSpec,
        passthrough: Sequence[str] = (),
    ) -> None:
        if not isinstance(model_spec, ClassifierSpec):
            raise TypeError(f"model_spec must be a ClassifierSpec, got {type(model_spec).__name__}")
        self.prep = FeaturePipeline(feature_specs)
        self.model_spec = model_spec
        self.passthrough = list(passthrough)

    def with_parameters(self, parameters: Mapping[str, Any]) -> "ClassifierPipeline":
        """The same pipeline with some of the classifier's settings changed."""
        changed = {}
        for name, value in parameters.items():
            step, _, setting = name.partition("__")
            if step != "classifier" or not setting:
                raise ValueError(f"parameters are named classifier__<setting>, got {name!r}")
            changed[setting.removeprefix("model__")] = value
        merged = {**self.model_spec.hyperparameters, **changed}
        return ClassifierPipeline(
            self.prep.specs, replace(self.model_spec, hyperparameters=merged), self.passthrough
        )

    def input_columns(self, df: DataFrame) -> list[str]:
        named = [s.feature_name for s in self.prep.specs if s.enabled and s.feature_name in df.columns]
        return list(dict.fromkeys([*named, *self.passthrough]))

    def fit(
        self, df: DataFrame, label: str, classes: list | None = None, prep: FittedFeatures | None = None
    ) -> FittedClassifier:
        """Fit on a frame; fitted preprocessing and known classes can be handed in."""
        prep = prep or self.prep.fit(df)
        classes = classes or class_list(df, label)
        names = [*prep.output_names(), *self.passthrough]
        wide = {n: f.width for f in prep.wide() for n in f.output_names()}
        df = prep.placed(df)
        vector = _matrix(prep, self.passthrough, df)
        places = [{i: wide[n] for i, n in enumerate(names) if n in wide}] if wide else []
        trees = fit_trees(df, vector, label, names, self.model_spec, classes, *places)
        return FittedClassifier(prep, self.passthrough, trees, label)


def check_rows(df: DataFrame, pipeline: ClassifierPipeline, label: str) -> FittedFeatures:
    """Checks before training: labelled rows, and finite features once they are imputed."""
    numeric = [s.feature_name for s in pipeline.prep.specs if s.enabled and hasattr(s, "scaler_type")]
    check_training_frame(df, [*[c for c in numeric if c in df.columns], *pipeline.passthrough], label)
    prep = pipeline.prep.fit(df)
    placed = {n for f in prep.wide() for n in f.output_names()}  # null for the first category
    require_finite(prep.transform(df), [*[n for n in prep.output_names() if n not in placed], *pipeline.passthrough])
    return prep
