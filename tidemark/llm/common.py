"""What the corpus operators share: stored intermediate tables, column checks, word splitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import new_folder

#: One Arrow batch is worked on in slices of about so many bytes of text.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch: texts are wide, and JVM and Python each hold a batch or two.
BATCH_ROWS = "1000"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back.

    The rows are computed once, later jobs have no lineage to repeat when an executor is lost.
    """
    _small_batches(df.sparkSession)
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``BATCH_ROWS`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, *frames: DataFrame) -> str:
    """A working name that is no column of the frames."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme; one without is on Spark's default file system, not on a task's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified folder (local or mounted disk, HDFS, S3, GCS) and the path in it."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each holds about ``size`` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit hashes (fixed values: the two multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_ids(offsets: np.ndarray) -> np.ndarray:
    """For offsets of consecutive lists, the list each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
