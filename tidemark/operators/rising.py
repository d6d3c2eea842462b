"""Rising step curves through (score, truth): isotonic regression by pooling blocks in parallel.

Adjacent blocks of scores whose means do not rise are pooled, in any order, until all rise; the
result does not depend on the order. Ranges of scores are pooled side by side. Where two ranges
meet, means may still fall, so the blocks that are left (fewer each time) are dealt to ranges anew,
with other borders, until no border has a fall. The driver sees two means for each range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of_join
from tidemark.session import new_folder, write_through

#: Blocks of a range, and corners of a curve that fit into every task.
BLOCK_ROWS, MAX_CORNERS = 250_000, 100_000
BLOCKS = "low double, high double, y double, w double"


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pool the blocks of a range, which come in order."""
    low, high, y, w = [], [], [], []
    for batch in batches:
        for a, b, s, n in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "y", "w"))):
            # Means are compared as products, which are exact for counts.
            while y and y[-1] * n >= s * w[-1]:
                a, s, n = low.pop(), s + y.pop(), n + w.pop()
                high.pop()
            low.append(a), high.append(b), y.append(s), w.append(n)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()) for x in (low, high, y, w)], ["low", "high", "y", "w"])


def rising_blocks(points: DataFrame) -> DataFrame:
    """Blocks of scores (``low`` to ``high``) with rising means ``y / w``; ``points`` has ``low``, ``y``, ``w``."""
    spark = points.sparkSession
    blocks = write_through(points.select("low", F.col("low").alias("high"), "y", "w"), "score-counts")
    turn, count = 0, blocks.count()
    while True:
        # Another number of ranges puts the borders elsewhere.
        ranges = math.ceil(count / BLOCK_ROWS) + turn % 2 if count > BLOCK_ROWS else 1
        path = new_folder(spark, "blocks")
        pooled = blocks.repartitionByRange(ranges, "low").sortWithinPartitions("low").mapInArrow(_pool, BLOCKS)
        pooled.withColumn("range", F.spark_partition_id()).write.parquet(path)
        blocks = spark.read.schema(f"{BLOCKS}, range int").parquet(path)
        mean = F.col("y") / F.col("w")
        ends = blocks.groupBy("range").agg(F.min("low").alias("at"), F.min_by(mean, "low").alias("first"), F.max_by(mean, "low").alias("last"))
        ends = sorted(ends.collect(), key=lambda r: r["at"])  # a row for each range
        if all(a["last"] < b["first"] for a, b in zip(ends, ends[1:])):
            return blocks.drop("range")
        blocks, turn = blocks.drop("range"), turn + 1
        count = blocks.count()


@dataclass
class RisingCurve:
    """A curve as a written table of its corners (``s``, ``p``); small ones are also kept here.

    Between corners it is a straight line, outside of them it is level.
    """

    path: str
    corners: tuple[list[float], list[float]] | None

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> RisingCurve:
        """The curve of a written table; another job may have written it."""
        table = spark.read.schema("s double, p double").parquet(path)
        if table.count() > MAX_CORNERS:
            return cls(path, None)
        rows = sorted(map(tuple, table.collect()))  # at most MAX_CORNERS
        return cls(path, ([s for s, _ in rows], [p for _, p in rows]))

    def __call__(self, frame: DataFrame, column: str, output: str) -> DataFrame:
        """Add the curve's value at a column; null where that is null."""
        if self.corners is None:
            return self._joined(frame, column, output)
        s, p = (np.array(c) for c in self.corners)

        @F.pandas_udf("double")
        def at(x: pd.Series) -> pd.Series:
            found = np.interp(x.to_numpy(float), s, p) if len(s) else np.full(len(x), np.nan)
            return pd.Series(found).where(x.notna().to_numpy(), None)

        return frame.withColumn(output, at(F.col(column).cast("double")))

    def _joined(self, frame: DataFrame, column: str, output: str) -> DataFrame:
        """The corners around each value, by a join as of the score from either side."""
        corners = frame.sparkSession.read.schema("s double, p double").parquet(self.path)
        rows = frame.withColumn("_k", F.lit(0)).withColumn("_x", F.col(column).cast("double")).withColumn("_minus", -F.col("_x"))
        for sign, at, names in ((1, "_x", ("_s0", "_p0")), (-1, "_minus", ("_s1", "_p1"))):
            side = corners.select(F.lit(0).alias("_k"), (F.col("s") * sign).alias("_at"), F.col("s").alias(names[0]), F.col("p").alias(names[1]))
            rows = as_of_join(rows, side, ["_k"], "_at", names, entity_timestamp=at)
        s0, p0, s1, p1, x = (F.col(c) for c in ("_s0", "_p0", "_s1", "_p1", "_x"))
        between = p0 + (p1 - p0) * (x - s0) / (s1 - s0)
        value = F.when(x.isNull(), None).when(p0.isNull(), p1).when(p1.isNull() | (s0 == s1), p0).otherwise(between)
        return rows.withColumn(output, value).drop("_k", "_x", "_minus", "_s0", "_p0", "_s1", "_p1")


def rising_curve(df: DataFrame, score: str, truth: Column) -> RisingCurve:
    """Isotonic regression of ``truth`` on a score; rows are counted for each score first."""
    own = F.col(score).cast("double")
    points = df.select(own.alias("low"), truth.alias("t")).filter("low IS NOT NULL").groupBy("low")
    blocks = rising_blocks(points.agg(F.count_if("t").cast("double").alias("y"), F.count(F.lit(1)).cast("double").alias("w")))
    mean = F.col("y") / F.col("w")
    low, high = (F.struct(F.col(c).alias("s"), mean.alias("p")) for c in ("low", "high"))
    corners = blocks.select(F.inline(F.when(F.col("low") == F.col("high"), F.array(low)).otherwise(F.array(low, high))))
    path = new_folder(df.sparkSession, "curve")
    corners.write.parquet(path)
    return RisingCurve.read(df.sparkSession, path)
