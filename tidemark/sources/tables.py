"""Reading, writing and describing tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import BOOKKEEPING, is_numeric, missing_as_null, natural_key
from tidemark.operators.latest import latest_per_key

FORMATS = ("parquet", "delta")


@dataclass(frozen=True)
class FeatureSource:
    """Where a feature table lies and which columns carry its times."""

    path: str
    timestamp_column: str
    created_column: str | None = None
    name: str | None = None
    description: str | None = None
    format: str = "parquet"

    def __post_init__(self) -> None:
        if not str(self.path).strip():
            raise ValueError("path cannot be blank")
        if not self.timestamp_column.strip():
            raise ValueError("timestamp_column cannot be blank")
        if self.format not in FORMATS:
            raise ValueError(f"format must be one of {FORMATS}, got {self.format!r}")
        if self.name is None:
            stem = str(self.path).rstrip("/").rsplit("/", 1)[-1]
            stem = stem.rsplit(".", 1)[0] if "." in stem[1:] else stem
            object.__setattr__(self, "name", f"{stem}_source")
        if self.description is None:
            object.__setattr__(self, "description", f"{self.format} table at {self.path}")

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, self.format)


def read_table(
    spark: SparkSession, path: str, format: str = "parquet", version: int | None = None
) -> DataFrame:
    """The current table, or one earlier version when the format keeps versions (Delta)."""
    reader = spark.read.format(format)
    if version is not None:
        if format != "delta":
            raise ValueError("versions need the Delta format; use read_as_of for other tables")
        reader = reader.option("versionAsOf", version)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table not found at {path}") from error
        raise


def read_as_of(
    spark: SparkSession,
    path: str,
    timestamp_column: str,
    as_of: Column,
    keys: Sequence[str] = (),
    format: str = "parquet",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The table as it stood at a moment: rows ingested by then, the newest row of each key.

    The time filter is pushed into the scan and prunes partitions if the table is partitioned
    by it. Without keys all rows ingested by then are returned.
    """
    known = read_table(spark, path, format).filter(F.col(timestamp_column) <= as_of)
    if not keys:
        return known
    rest = [c for c in known.columns if c not in keys]
    return latest_per_key(known, keys, timestamp_column, rest, tiebreak=tiebreak).select(known.columns)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    format: str = "parquet",
) -> str:
    """Write a table in one job; returns its path.

    When partition columns are given the rows are first shuffled by them, so that each task
    holds few partitions; AQE splits the partitions that are too large, so one hot value does
    not end up in one task.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")
    unknown = [c for c in partition_by if c not in df.columns]
    if unknown:
        raise ValueError(f"partition columns not in the frame: {unknown}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def table_info(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, the column names and the schema."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        "num_rows",
        F.lit(len(df.columns)).alias("num_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def describe_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """``table_info`` of a stored table with its path and, for Delta, its latest version."""
    info = table_info(read_table(spark, path, format)).withColumn("path", F.lit(path))
    version = None
    if format == "delta":
        history = spark.sql(f"DESCRIBE HISTORY delta.`{path}`")
        version = history.agg(F.max("version")).first()[0]
    return info.withColumn("version", F.lit(version).cast("long"))


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: records, missing values, smallest and largest value.

    One aggregate over the table whatever its width. Numbers are reported as doubles, and all
    but floating point ones also exactly, as text; other values as text. Lists, maps and structs
    have counts only.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wanted = [F.count(F.lit(1)).alias("n")]
    for i, (c, kind) in enumerate(kinds.items()):
        if isinstance(kind, nested):
            wanted.append(F.count(F.col(f"`{c}`")).alias(f"k{i}"))
            continue
        value = missing_as_null(df, c)
        wanted += [F.count(value).alias(f"k{i}"), F.min(value).alias(f"a{i}"), F.max(value).alias(f"z{i}")]
    rows = []
    for i, (c, kind) in enumerate(kinds.items()):
        number = not isinstance(kind, nested) and is_numeric(df, c)
        text = not isinstance(kind, (*nested, T.FloatType, T.DoubleType))

        def extreme(name: str, yes: bool, to: str):
            return F.col(name).cast(to) if yes else F.lit(None).cast(to)

        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col("n").alias("num_records"),
                (F.col("n") - F.col(f"k{i}")).alias("null_count"),
                extreme(f"a{i}", number, "double").alias("min_number"),
                extreme(f"z{i}", number, "double").alias("max_number"),
                extreme(f"a{i}", text, "string").alias("min_text"),
                extreme(f"z{i}", text, "string").alias("max_text"),
            )
        )
    return df.agg(*wanted).select(F.inline(F.array(*rows)))


#: Kinds whose counts and extremes stand in the footers of Parquet files (for floating point numbers NaN is missing there).
IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Change session settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def footer_extremes(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row of counts and extremes whose aggregate is pushed into the footers of Parquet files.

    It must be planned and run under the settings in ``_FOOTERS``.
    """
    df = spark.read.parquet(path)
    wanted = [f(F.col(f"`{c}`")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("k", F.count), ("a", F.min), ("z", F.max))]
    return df.agg(F.count(F.lit(1)).alias("n"), *wanted)


def profile_table(spark: SparkSession, path: str) -> DataFrame:
    """``column_profile`` of a stored Parquet table that reads as little of it as it can.

    Whole numbers, dates and booleans are profiled from the files' footers, other columns by one
    scan of these only. Tables whose footers do not have what is needed are scanned.
    """
    df = read_table(spark, path)
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, IN_FOOTERS) and "." not in f.name]
    row = None
    if plain:
        try:
            with _settings(spark, _FOOTERS):
                row = footer_extremes(spark, path, plain).first()  # one row for the whole table
        except (PySparkException, Py4JJavaError) as error:  # a column without a value has no extremes there
            if "aggregatePushdown" not in str(error):
                raise
    if row is None or row["n"] is None:
        return column_profile(df)
    rows = []
    for i, c in enumerate(plain):
        low, high = row[f"a{i}"], row[f"z{i}"]
        number = is_numeric(df, c)
        text = [None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in (low, high)]
        numbers = [float(v) if number and v is not None else None for v in (low, high)]
        rows.append((c, row["n"], row["n"] - row[f"k{i}"], *numbers, *text))
    kinds = "`column` string, num_records long, null_count long, min_number double, max_number double, min_text string, max_text string"
    known = spark.createDataFrame(rows, kinds)
    rest = [f"`{c}`" for c in df.columns if c not in plain]
    return known.unionByName(column_profile(df.select(*rest))) if rest else known


def load_labelled(
    df: DataFrame, key: str = "sample_index", label: str = "target", drop: Sequence[str] = BOOKKEEPING
) -> DataFrame:
    """Training frame: the key, the features in natural order, and the label.

    Features and label stay columns of one row, so they cannot get out of step.
    """
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    kept = sorted((c for c in df.columns if c not in (*drop, key, label)), key=natural_key)
    return df.select(key, *kept, label)
