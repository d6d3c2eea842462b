"""Probability calibration."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks import class_list
from tidemark.operators.model import ClassifierPipeline, FittedClassifier, evaluate_scored
from tidemark.operators.rising import RisingCurve, rising_curve
from tidemark.operators.splits import kfold, stratified_kfold
from tidemark.session import write_through
from tidemark.specs import CalibrationSpec

Curve = Callable[[DataFrame, str, str], DataFrame]


@dataclass
class SigmoidCurve:
    """Logistic function of a score."""

    slope: float
    shift: float

    def __call__(self, frame: DataFrame, column: str, output: str) -> DataFrame:
        return frame.withColumn(output, 1.0 / (1.0 + F.exp(-(F.col(column) * self.slope + self.shift))))


def sigmoid_curve(df: DataFrame, score: str, truth: Column) -> SigmoidCurve:
    """Platt's curve through (score, truth).

    Each row counts as two weighted rows, a positive and a negative one, whose weights are
    Platt's smoothed targets.
    """
    rows = df.select(F.col(score).alias("s"), truth.alias("t"))
    positives, negatives = rows.agg(F.count_if("t"), F.count_if(~F.col("t"))).first()
    target = F.when(F.col("t"), (positives + 1.0) / (positives + 2.0)).otherwise(1.0 / (negatives + 2.0))
    counted = rows.groupBy("s", "t").agg(F.count(F.lit(1)).alias("n"))
    weighted = counted.select(
        array_to_vector(F.array("s")).alias("features"),
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("label"), (F.col("n") * target).alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1.0 - target)).alias("weight")),
            )
        ),
    )
    fitted = LogisticRegression(weightCol="weight", regParam=0.0, maxIter=200, tol=1e-10).fit(weighted)
    return SigmoidCurve(float(fitted.coefficients[0]), float(fitted.intercept))


def isotonic_curve(df: DataFrame, score: str, truth: Column) -> RisingCurve:
    """Rising step curve through (score, truth), interpolated between the steps."""
    return rising_curve(df, score, truth)


CURVES = {"sigmoid": sigmoid_curve, "isotonic": isotonic_curve}


@dataclass
class CalibratedClassifier:
    """Pairs of a fitted classifier and its curves; their probabilities are averaged."""

    spec: CalibrationSpec
    members: list[tuple[FittedClassifier, list[Curve]]]
    label: str

    @property
    def classes(self) -> list:
        return self.members[0][0].classes

    def transform(
        self, df: DataFrame, probability: str = "probability", prediction: str = "prediction"
    ) -> DataFrame:
        out = df
        for i, (model, curves) in enumerate(self.members):
            out = model.transform(out, f"_raw{i}", "_ignored").drop("_ignored")
            out = _calibrated(out, f"_raw{i}", curves, f"_cal{i}").drop(f"_raw{i}")
        parts = [F.col(f"_cal{i}") for i in range(len(self.members))]
        means = [sum((p[j] for p in parts[1:]), parts[0][j]) / len(parts) for j in range(len(self.classes))]
        best = F.array_position(F.col(probability), F.array_max(F.col(probability))).cast("int")
        out = out.withColumn(probability, F.array(*means)).drop(*[f"_cal{i}" for i in range(len(parts))])
        return out.withColumn(prediction, F.element_at(self.members[0][0].trees.labels(), best))

    def predict(self, df: DataFrame) -> DataFrame:
        """``transform`` after the checks of the uncalibrated classifier: rows, and every feature."""
        self.members[0][0].predict(df)
        return self.transform(df)

    def evaluate(self, df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
        wanted = metrics or self.members[0][0].trees.spec.evaluation_metrics
        return evaluate_scored(self.transform(df), self.label, self.classes, wanted)

    def summary(self) -> dict[str, Any]:
        return {
            "calibration_name": self.spec.calibration_name,
            "calibration_type": "classifier_calibration",
            "method": self.spec.method,
            "cv_strategy": self.spec.cv_strategy,
            "ensemble": self.spec.ensemble,
            "n_calibrated_models": len(self.members),
        }


def _calibrated(df: DataFrame, raw: str, curves: list[Curve], output: str) -> DataFrame:
    """One curve calibrates the second of two classes; more classes have one each and are rescaled."""
    if len(curves) == 1:
        df = curves[0](df.withColumn("_s0", F.col(raw)[1]), "_s0", "_q0")
        return df.withColumn(output, F.array(1.0 - F.col("_q0"), F.col("_q0"))).drop("_s0", "_q0")
    for j, curve in enumerate(curves):
        df = curve(df.withColumn("_s", F.col(raw)[j]), "_s", f"_q{j}").drop("_s")
    total = sum((F.col(f"_q{j}") for j in range(1, len(curves))), F.col("_q0"))
    shares = [
        F.when(total > 0, F.col(f"_q{j}") / total).otherwise(1.0 / len(curves)) for j in range(len(curves))
    ]
    return df.withColumn(output, F.array(*shares)).drop(*[f"_q{j}" for j in range(len(curves))])


def _curves(scored: DataFrame, label: str, classes: list, method: str) -> list[Curve]:
    """``scored`` has the uncalibrated class probabilities in ``_raw``."""
    wanted = [1] if len(classes) == 2 else range(len(classes))
    narrow = scored.select(label, *[F.col("_raw")[j].alias(f"_s{j}") for j in wanted])
    return [CURVES[method](narrow, f"_s{j}", F.col(label) == F.lit(classes[j])) for j in wanted]


def calibrate_prefit(
    model: FittedClassifier, df: DataFrame, label: str, spec: CalibrationSpec
) -> CalibratedClassifier:
    """Calibrate a fitted classifier on the given rows."""
    scored = write_through(model.transform(df, "_raw", "_ignored").select(label, "_raw"), "scores")
    return CalibratedClassifier(spec, [(model, _curves(scored, label, model.classes, spec.method))], label)


class CalibratedPipeline:
    """A classifier pipeline whose probabilities are calibrated, fitted as one unit.

    ``stored`` says that the rows come from a table that is cheap to read again, so that no
    copy of them needs to be written for the folds.
    """

    def __init__(
        self,
        pipeline: ClassifierPipeline,
        spec: CalibrationSpec,
        key: str,
        seed: int = 42,
        stored: bool = False,
    ) -> None:
        if not isinstance(spec, CalibrationSpec):
            raise TypeError(f"spec must be a CalibrationSpec, got {type(spec).__name__}")
        self.pipeline = pipeline
        self.spec = spec
        self.key = key
        self.stored = stored
        self.seed = spec.random_state if spec.random_state is not None else seed

    def input_columns(self, df: DataFrame) -> list[str]:
        return self.pipeline.input_columns(df)

    def fit(
        self,
        df: DataFrame,
        label: str,
        classes: list | None = None,
        model: FittedClassifier | None = None,
        parallelism: int = 4,
    ) -> CalibratedClassifier:
        """Fit by the spec's strategy.

        "prefit" calibrates on the rows the classifier was fitted on (or on ``df`` if a fitted
        ``model`` is given). The fold strategies calibrate on rows a fold's classifier has not
        seen: one curve per fold (ensemble), or one curve over all of them for a classifier
        fitted on every row.
        """
        spec, key = self.spec, self.key
        classes = classes or class_list(df, label)
        if spec.cv_strategy == "prefit":
            return calibrate_prefit(model or self.pipeline.fit(df, label, classes), df, label, spec)
        narrow = df.select(*dict.fromkeys([key, *self.input_columns(df), label]))
        if spec.cv_strategy == "stratified_kfold":
            folded = stratified_kfold(narrow, key, label, spec.folds, self.seed, fold="_part")
        else:
            folded = kfold(narrow, key, spec.folds, self.seed, fold="_part")
        if not self.stored:
            folded = write_through(folded, "calibration", "_part")

        prep = self.pipeline.prep.fit_folds(folded, "_part", spec.folds)

        def one(fold: int) -> tuple[FittedClassifier, DataFrame, list[Curve]]:
            fitted = self.pipeline.fit(folded.filter(F.col("_part") != fold), label, classes, prep[fold])
            unseen = fitted.transform(folded.filter(F.col("_part") == fold), "_raw", "_ignored")
            scored = write_through(unseen.select(label, "_raw"), "scores")
            return fitted, scored, _curves(scored, label, classes, spec.method) if spec.ensemble else []

        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(one, range(spec.folds)))
        if spec.ensemble:
            return CalibratedClassifier(spec, [(fitted, curves) for fitted, _, curves in parts], label)
        pooled = reduce(DataFrame.unionByName, [scored for _, scored, _ in parts])
        curves = _curves(pooled, label, classes, spec.method)
        whole = model or self.pipeline.fit(folded, label, classes)
        return CalibratedClassifier(spec, [(whole, curves)], label)
