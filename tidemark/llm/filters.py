"""Bitmaps of fixed size that spare rows a shuffle.

A bitmap tells rows that certainly do not take part in a join; what it lets through still goes
through the join. It is broadcast, and has one size whatever the data: with many more ids than
bits it lets everything through, and the join alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 1 MB.
FILTER_BITS = 1 << 23


def bitmap(bits_of: DataFrame, bit: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap with all given bits set; its size does not depend on their number."""
    mask = F.bit_or(F.expr(f"shiftleft(1L, CAST({bit} & 63 AS INT))"))
    packed = bits_of.groupBy(F.shiftright(bit, 6).alias("at")).agg(mask.alias("mask"))
    found = np.zeros(bits >> 6, np.int64)
    for row in packed.toPandas().itertuples(index=False):  # at most bits / 64 rows
        found[row.at] = row.mask
    return found


def id_filter(ids: DataFrame, name: str, bits: int = FILTER_BITS) -> np.ndarray:
    return bitmap(ids.select(F.pmod(F.xxhash64(name), F.lit(bits)).alias("bit")), "bit", bits)


def in_filter(rows: DataFrame, name: str, bitmap: np.ndarray) -> DataFrame:
    """Rows whose id may be in the bitmap; others certainly are not."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    bits = len(bitmap) << 6
    columns = rows.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("__bit").to_numpy()
            yes = shared.value[bit >> 6] >> (bit & 63) & 1
            yield batch.select(columns).filter(pa.array(yes.astype(bool)))

    return rows.withColumn("__bit", F.pmod(F.xxhash64(name), F.lit(bits))).mapInArrow(keep, rows.schema)
