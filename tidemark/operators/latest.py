"""Latest row per key, and the table that keeps it (L1, L2, L4)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every run is written in parts by key hash, so that a lookup reads the parts of its keys only.
BUCKET, BUCKETS = "_bucket", 16
#: Runs of one level that are folded into one of the next, and keys up to which a lookup filters the scan.
FAN, FEW_KEYS = 8, 1_000
LEVEL = "_level"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    timestamp: str,
    columns: Sequence[str],
    created: str | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The newest row of each key; equal times go to the later creation, then the tiebreak.

    What is still tied goes by a hash of the row's values, not by arrival.

    A plain aggregate: each task first reduces its own rows to one per key, so a key that
    holds much of the table sends one row per task through the shuffle.
    """
    own = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(columns)])))
    order = [timestamp, *([created] if created else []), *tiebreak]
    picked = F.max_by(F.struct(*columns), F.struct(*order, own.alias("_own"))).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")


def materialize(
    df: DataFrame,
    keys: Sequence[str],
    timestamp: str,
    columns: Sequence[str],
    start: datetime | Column,
    end: datetime | Column,
    created: str | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Latest row per key among the rows with ``start <= timestamp <= end``."""
    window = df.filter(F.col(timestamp).between(_moment(start), _moment(end)))
    kept = list(dict.fromkeys([timestamp, *([created] if created else []), *tiebreak, *columns]))
    return latest_per_key(window, keys, timestamp, kept, created, tiebreak)


def _moment(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


class LatestTable:
    """Latest features per key, stored as runs in levels.

    Each materialisation writes only its own reduced rows, to ``rows/origin=<o>/batch=<n>``;
    reading reduces the runs to one row per key. So an update costs as much as the update is
    large, not as the table is. ``fold`` keeps the runs few: ``FAN`` runs of a level become one of
    the next, in place, and ``folds`` notes which runs that stands for. ``compact`` writes all rows
    as the first run of a new table. Rows of a part are sorted by key and have Bloom filters, so a
    lookup of few keys reads about a row group of each run. A batch
    that is run again replaces its own folder, which makes retries harmless; batches of
    different origins (this class, or a stream by its name) do not meet. ``log`` holds one
    row per finished batch: the moment up to which it covered the source.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        timestamp: str,
        created: str | None = None,
        tiebreak: Sequence[str] = (),
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.timestamp = timestamp
        self.created = created
        self.tiebreak = list(tiebreak)

    def materialize(
        self, df: DataFrame, columns: Sequence[str], start: datetime, end: datetime
    ) -> "LatestTable":
        """Add the rows of ``[start, end]`` to the table."""
        return self._add(df, columns, start, end, self._progress()[0])

    def materialize_incremental(
        self, df: DataFrame, columns: Sequence[str], end: datetime | None = None
    ) -> "LatestTable":
        """Add the rows after the last covered moment, up to ``end`` (default: now, UTC)."""
        if end is None:
            now = "CAST(to_utc_timestamp(now(), current_timezone()) AS TIMESTAMP_NTZ)"
            end = self.spark.sql(f"SELECT {now}").first()[0]
        last, covered = self._progress()
        if covered is not None:
            if end <= covered:
                return self
            df = df.filter(F.col(self.timestamp) > _moment(covered))
        return self._add(df, columns, datetime(1, 1, 1), end, last)

    def _add(self, df, columns, start, end, last: int | None) -> "LatestTable":
        order = (self.created, self.tiebreak)
        reduced = materialize(df, self.keys, self.timestamp, columns, start, end, *order)
        return self.write_batch(reduced, 0 if last is None else last + 1, end)

    def write_batch(
        self, reduced: DataFrame, batch: int, end: datetime | None = None, origin: str = "batch"
    ) -> "LatestTable":
        """Store one reduced delta under its number, then note it in the log."""
        place = f"origin={origin}/batch={batch}"
        self._write_run(reduced, place)
        covered = F.lit(None).cast("timestamp_ntz") if end is None else _moment(end)
        self.spark.range(0, 1, 1, 1).select(covered.alias("covered_until")).write.mode("overwrite").parquet(f"{self.path}/log/{place}")
        return self

    def _write_run(self, reduced: DataFrame, place: str) -> None:
        dealt = reduced.withColumn(BUCKET, self._bucket()).repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        writer = dealt.write.mode("overwrite").partitionBy(BUCKET)
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{self.path}/rows/{place}")

    def runs(self) -> list[tuple[str, int]]:
        """The runs (origin, batch) that hold the table, without those that a fold stands for."""
        gone = set(self._folded())
        return [r for r in self._folders() if r not in gone]

    def _folders(self) -> list[tuple[str, int]]:
        """Runs that are in the table's folder, the finished ones only."""
        found, root = [], self._file_system()[1](f"{self.path}/rows")
        files = self._file_system()[0]
        if not files.exists(root):
            return []
        for origin in files.listStatus(root):
            if not origin.isDirectory():
                continue
            for batch in files.listStatus(origin.getPath()):
                name = batch.getPath().getName()
                done = files.exists(self._file_system()[1](f"{batch.getPath().toString()}/_SUCCESS"))
                if name.startswith("batch=") and done:
                    found.append((origin.getPath().getName().removeprefix("origin="), int(name.removeprefix("batch="))))
        return sorted(found)

    def _file_system(self):
        """The table's file system, and its paths from text."""
        make = self.spark._jvm.org.apache.hadoop.fs.Path
        return make(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), make

    def _folded(self) -> list[tuple[str, int]]:
        """Runs that are still there, but for which a run of a higher level stands."""
        noted, there = self._read("folds"), self._folders()
        if noted is None:
            return []
        asked = self.spark.createDataFrame(there, "origin string, batch int") if there else None
        return [] if asked is None else sorted(tuple(r) for r in noted.join(asked, ["origin", "batch"], "left_semi").select("origin", "batch").distinct().collect())

    def fold(self, fan: int = FAN) -> "LatestTable":
        """Merge ``fan`` or more runs of a level into one of the next, in place.

        The new run is written before it is noted what it stands for; until then rows are read
        twice, which changes nothing, since only the latest counts. Runs go from the folder a fold
        later, when no reader lists them any more. One fold runs at a time.
        """
        files, make = self._file_system()
        for origin, batch in self._folded():
            files.delete(make(f"{self.path}/rows/origin={origin}/batch={batch}"), True)
        level = 0
        while True:
            runs = self.runs()
            own = [r for r in runs if self._level(r[0]) == level]
            if not any(self._level(o) >= level for o, _ in runs):
                return self
            if len(own) >= fan:
                number = 1 + max((b for o, b in [*self._folders(), *self._noted()] if o == f"{LEVEL}{level + 1}"), default=-1)
                rows = self._rows(own)
                columns = [c for c in rows.columns if c not in (*self.keys, "origin", "batch", BUCKET)]
                reduced = latest_per_key(rows, self.keys, self.timestamp, columns, self.created, self.tiebreak)
                self._write_run(reduced, f"origin={LEVEL}{level + 1}/batch={number}")
                note = self.spark.createDataFrame(own, "origin string, batch int").coalesce(1)
                note.write.mode("overwrite").parquet(f"{self.path}/folds/into={level + 1}-{number}")
            level += 1

    def _noted(self) -> list[tuple[str, int]]:
        """Runs of higher levels that have been folded further; their numbers are not used again."""
        noted = self._read("folds")
        return [] if noted is None else [tuple(r) for r in noted.filter(F.col("origin").startswith(LEVEL)).select("origin", "batch").collect()]

    @staticmethod
    def _level(origin: str) -> int:
        return int(origin.removeprefix(LEVEL)) if origin.startswith(LEVEL) else 0

    def _rows(self, runs: Sequence[tuple[str, int]]) -> DataFrame | None:
        """Stored rows of some runs; others are pruned by their folders' names."""
        rows = self._read("rows")
        if rows is None or not runs:
            return rows
        by_origin: dict[str, list[int]] = {}
        for origin, batch in runs:
            by_origin.setdefault(origin, []).append(batch)
        inside = F.lit(False)
        for origin, batches in by_origin.items():
            inside = inside | ((F.col("origin") == origin) & F.col("batch").isin(batches))
        return rows.filter(inside)

    def _bucket(self) -> Column:
        """Part of the table a key is in; keys are compared as text, so an int finds a stored long."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(BUCKETS)).cast("int")

    def covered_until(self) -> datetime | None:
        """End of the newest window that has been materialised from the source table."""
        return self._progress()[1]

    def read(self, only: DataFrame | None = None) -> DataFrame:
        """One row per key: the latest. ``only`` restricts to some keys before reducing."""
        runs = self.runs()
        rows = self._rows(runs) if runs else None
        if rows is None:
            raise RuntimeError(f"nothing has been materialised at {self.path}")
        columns = [c for c in rows.columns if c not in (*self.keys, "origin", "batch", BUCKET)]
        if only is not None:
            asked = [r[0] for r in only.select(self._bucket()).distinct().collect()]  # at most BUCKETS
            rows = rows.filter(F.col(BUCKET).isin(asked))
            few = only.select(*self.keys).distinct().limit(FEW_KEYS + 1).collect()
            if len(few) <= FEW_KEYS:  # reaches the scan, which skips row groups by their ranges and Bloom filters
                for i, key in enumerate(self.keys):
                    rows = rows.filter(F.col(key).isin(sorted({r[i] for r in few if r[i] is not None})))
            rows = rows.join(only.select(*self.keys), self.keys, "left_semi")
        return latest_per_key(rows, self.keys, self.timestamp, columns, self.created, self.tiebreak)

    def lookup(
        self,
        keys: DataFrame,
        columns: Sequence[str],
        view: str | None = None,
        full_names: bool = False,
    ) -> DataFrame:
        """Latest features of the given keys, in one join; unknown keys get nulls."""
        prefix = f"{view}__" if full_names and view else ""
        latest = self.read(only=keys).select(*self.keys, *[F.col(c).alias(prefix + c) for c in columns])
        return keys.join(latest, self.keys, "left")

    def compact(self, path: str) -> "LatestTable":
        """Write the current rows as the first delta of a new table at ``path``."""
        fresh = LatestTable(self.spark, path, self.keys, self.timestamp, self.created, self.tiebreak)
        return fresh.write_batch(self.read(), 0, self.covered_until())

    def _progress(self) -> tuple[int | None, datetime | None]:
        """Number of the last batch and the moment up to which the source has been read."""
        log = self._read("log")
        if log is None:
            return None, None
        return tuple(log.filter("origin = 'batch'").agg(F.max("batch"), F.max("covered_until")).first())

    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
