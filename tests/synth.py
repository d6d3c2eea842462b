"""Labelled rows for trying out models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import write_table


def synth_labelled(
    ids: DataFrame,
    key: str,
    n_features: int = 20,
    n_classes: int = 2,
    seed: int = 42,
    separation: float = 1.0,
    flip: float = 0.01,
) -> DataFrame:
    """Give every id a class and features of which half tell the class apart.

    The first half of the features are normal around a centre that depends on the class, the
    next quarter are mixtures of those, the rest is noise; a share ``flip`` of the labels is
    drawn anew. Every number is derived from a hash of (id, seed, position), so the rows are
    the same however the ids are partitioned and nothing is shuffled.
    """
    if n_features < 2 or n_classes < 2:
        raise ValueError("at least two features and two classes are needed")
    informative, redundant = n_features // 2, n_features // 4

    def uniform(position: int) -> Column:
        hashed = F.xxhash64(F.col(key), F.lit(seed), F.lit(position))
        return (F.pmod(hashed, F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))

    def normal(position: int) -> Column:
        radius = F.sqrt(-2.0 * F.log(uniform(2 * position + 10)))
        return radius * F.cos(2.0 * math.pi * uniform(2 * position + 11))

    def centre(feature: int) -> Column:
        # Corners of a cube: each class has its own pattern of signs.
        sign = F.lit(0.0)
        for c in range(n_classes):
            digit = ((c * (2 * feature + 1)) // (1 + feature % 3) + feature) % n_classes
            at = separation * (2.0 * digit / (n_classes - 1) - 1.0)
            sign = F.when(F.col("_class") == c, F.lit(at)).otherwise(sign)
        return sign

    def mixture(j: int) -> Column:
        first, second = f"feature_{j % informative}", f"feature_{(j + 1) % informative}"
        return (F.col(first) * (1.0 + 0.5 * j) - F.col(second)) / (1.0 + j)

    rows = ids.select(key).withColumn("_class", F.floor(uniform(0) * n_classes).cast("long"))
    rows = rows.select(
        "*",
        *[(centre(i) + normal(i)).alias(f"feature_{i}") for i in range(informative)],
    )
    noise = range(informative + redundant, n_features)
    drawn = F.floor(uniform(2) * n_classes).cast("long")
    return rows.select(
        F.col(key).alias("sample_index"),
        *[f"feature_{i}" for i in range(informative)],
        *[mixture(j).alias(f"feature_{informative + j}") for j in range(redundant)],
        *[normal(i).alias(f"feature_{i}") for i in noise],
        F.when(uniform(1) < flip, drawn).otherwise(F.col("_class")).alias("target"),
    )


def create_labelled_table(
    spark: SparkSession,
    path: str,
    n_samples: int = 1000,
    n_features: int = 20,
    n_classes: int = 2,
    seed: int = 42,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
) -> str:
    """Write a generated table with ingest columns; returns its path."""
    rows = synth_labelled(spark.range(n_samples), "id", n_features, n_classes, seed)
    rows = rows.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
    rows = rows.withColumn("ingested_date", F.to_date("ingested_at"))
    return write_table(rows, path, mode, partition_by)
