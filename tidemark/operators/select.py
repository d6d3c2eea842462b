"""Choosing, naming and typing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import BOOKKEEPING, natural_key
from tidemark.specs import FeatureSelection

# Field type names and the Spark types they stand for.
FIELD_TYPES = {
    "Float64": T.DoubleType(),
    "Int64": T.LongType(),
    "String": T.StringType(),
    "Bool": T.BooleanType(),
}


def feature_columns(df: DataFrame, drop: Sequence[str] = BOOKKEEPING) -> list[str]:
    """Feature names in natural order, from the schema alone."""
    return sorted((c for c in df.columns if c not in drop), key=natural_key)


def select_features(df: DataFrame, selection: FeatureSelection, features: Sequence[str]) -> DataFrame:
    """Keep the selected features, in the order the selection gives."""
    return df.select(*selection.pick(list(features)))


def feature_references(view: str, features: Sequence[str], label: str | None = None) -> list[str]:
    """``view:feature`` for every feature and, if given, the label."""
    return [f"{view}:{c}" for c in [*features, *([label] if label else [])]]


def with_view_names(df: DataFrame, view: str, features: Sequence[str]) -> DataFrame:
    """Prefix the features with their view's name; other columns keep theirs."""
    return df.select(*[F.col(c).alias(f"{view}__{c}") if c in features else F.col(c) for c in df.columns])


def feature_schema(
    names: Sequence[str], types: Sequence[str] | None = None, default: str = "Float64"
) -> T.StructType:
    """Fields with one type each, or all of the default type."""
    if types is not None and len(types) != len(names):
        raise ValueError(f"{len(names)} names but {len(types)} types")
    kinds = list(types) if types is not None else [default] * len(names)
    unknown = sorted(set(kinds) - set(FIELD_TYPES))
    if unknown:
        raise ValueError(f"unknown field types {unknown}")
    return T.StructType([T.StructField(n, FIELD_TYPES[k]) for n, k in zip(names, kinds)])


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Add the features as one vector; missing values become NaN in it."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep").transform(df)
