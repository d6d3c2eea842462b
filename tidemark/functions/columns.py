"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a training table that are not features.
BOOKKEEPING = ("sample_index", "target", "ingested_at", "ingested_date")

# Shuffle keys are the first 13 hex digits of an md5.
SHUFFLE_KEYS = 16**13


def natural_key(name: str) -> tuple:
    """Sort key under which ``feature_2`` comes before ``feature_10``."""
    return tuple((0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.split(r"(\d+)", name) if p)


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def missing_as_null(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null, so that both count as missing."""
    column = F.col(f"`{name}`")
    return F.nanvl(column, F.lit(None).cast(df.schema[name].dataType)) if is_float(df, name) else column


def is_not_finite(df: DataFrame, name: str) -> Column:
    """True for null, NaN and the two infinities."""
    column = F.col(f"`{name}`")
    if not is_float(df, name):
        return column.isNull()
    return column.isNull() | F.isnan(column) | (F.abs(column) == float("inf"))


def shuffle_key(seed: int, ids: Sequence[str]) -> Column:
    """A 52-bit pseudo-random number that depends only on the seed and the row's id.

    Rows keep their value however they are partitioned, and any engine with md5 can
    reproduce it.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def with_computed(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Add a costly column that is computed once per row.

    As a plain projection its expression would be copied into every filter and comparison
    that uses it; those stay above a generator.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def with_bucket(df: DataFrame, position: Column, edges: Sequence[float], output: str) -> DataFrame:
    """Add the number of the stretch between sorted edges in which a number lies."""
    if not edges:
        return df.withColumn(output, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_position", outputCol=output, handleInvalid="keep")
    return cut.transform(df.withColumn("_position", position)).drop("_position")


def bucket_of(column: Column, edges: Sequence[Column]) -> Column:
    """Number of edges at or below the value, found by halving the sorted edges."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column < edges[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(edges))
