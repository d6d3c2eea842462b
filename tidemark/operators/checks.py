"""Checks on training and prediction frames (V1 to V4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import is_float, is_not_finite, is_numeric

MAX_CLASSES = 1_000


def nonfinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, nulls, nans, infinities), counted in one pass over all columns."""
    wanted, rows = [], []
    for i, c in enumerate(columns):
        value, floating = F.col(f"`{c}`"), is_float(df, c)
        nan = F.isnan(value) if floating else F.lit(False)
        infinite = F.abs(value) == float("inf") if floating else F.lit(False)
        wanted += [
            F.count_if(value.isNull()).alias(f"u{i}"),
            F.count_if(nan).alias(f"n{i}"),
            F.count_if(infinite).alias(f"i{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"u{i}").alias("nulls"),
                F.col(f"n{i}").alias("nans"),
                F.col(f"i{i}").alias("infinities"),
            )
        )
    return df.agg(*wanted).select(F.inline(F.array(*rows)))


def quarantine(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows in which any of the columns is not a finite value."""
    return df.filter(reduce(lambda a, b: a | b, [is_not_finite(df, c) for c in columns]))


def require_finite(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise if any value is null, NaN or infinite."""
    if columns and not quarantine(df, columns).select(F.lit(1)).isEmpty():
        raise ValueError(f"non-finite values (null, NaN or Inf) in {list(columns)}")


def frame_counts(df: DataFrame, label: str) -> DataFrame:
    """One row: number of rows, of missing labels and of different labels."""
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(F.col(label).isNull()).alias("null_labels"),
        F.count_distinct(F.col(label)).alias("num_labels"),
    )


def check_training_frame(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Raise unless the features are numeric and there are rows, all of them labelled."""
    _check_features(df, features)
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    row = df.agg(F.count(F.lit(1)), F.count_if(F.col(label).isNull())).first()
    if row[0] == 0:
        raise ValueError("cannot train on an empty frame")
    if row[1] > 0:
        raise ValueError(f"{row[1]} rows have no label")
    return df


def check_prediction_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Raise unless the frame has rows and every feature the model was fitted with."""
    _check_features(df, features)
    if df.select(F.lit(1)).isEmpty():
        raise ValueError("cannot predict on an empty frame")
    return df


def _check_features(df: DataFrame, features: Sequence[str]) -> None:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"features not in the frame: {missing}")
    text = [c for c in features if not is_numeric(df, c)]
    if text:
        raise TypeError(f"features must be numeric: {text}")


def label_classes(df: DataFrame, label: str) -> DataFrame:
    """The different labels in ascending order."""
    return df.filter(F.col(label).isNotNull()).select(label).distinct().orderBy(label)


def class_list(df: DataFrame, label: str, limit: int = MAX_CLASSES) -> list:
    """The labels as a list; a column with more than ``limit`` values is not a class label."""
    found = [r[0] for r in label_classes(df, label).limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{label!r} has more than {limit} classes")
    return found


def keep_samples(df: DataFrame, key: str, samples: DataFrame | Sequence | None) -> DataFrame:
    """Rows whose key is among the samples; all rows if no samples are given."""
    if samples is None:
        return df
    if not isinstance(samples, DataFrame):
        samples = df.sparkSession.createDataFrame([(s,) for s in samples], df.select(key).schema)
    return df.join(samples.select(key), key, "left_semi")
