"""Approximate quantiles for cutting data into pieces of about equal size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRID = 1_000
GROUPS = 256


def spread_quantiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles of a column as an array ``p``, one row per group of ``by``.

    The sketches of the input partitions are first merged into GROUPS groups side by side;
    each yields a grid of GRID quantiles, and one small aggregate joins the grids. A single
    aggregate would pass the sketches of all partitions through one task.
    """
    grid = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    part = (F.spark_partition_id() % GROUPS).alias("_part")
    sketches = df.groupBy(*by, part).agg(
        F.count(value).alias("_n"), F.percentile_approx(value, grid, F.lit(4 * GRID)).alias("_grid")
    )
    points = sketches.select(*by, "_n", F.explode("_grid").alias("_v"))
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    if isinstance(df.schema[value].dataType, T.NumericType):
        joined = F.percentile("_v", wanted, F.col("_n"))
    else:  # weights are for numbers only; without them the pieces are a little less even
        joined = F.percentile_approx("_v", wanted, F.lit(10_000))
    return points.groupBy(*by).agg(joined.alias("p"))
