"""Keeping the latest table up to date from a stream (L3), with and without expiry."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.operators.latest import LatestTable, latest_per_key

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times inside a row's JSON keep their microseconds.
FORMATS = {f: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for f in ("timestampFormat", "timestampNTZFormat")}
EXPIRED = "expired"


def stream_into(
    table: LatestTable,
    stream: DataFrame,
    columns: Sequence[str],
    checkpoint: str,
    trigger: dict | None = None,
    name: str = "stream",
    fold_every: int | None = None,
) -> StreamingQuery:
    """Reduce every micro-batch to one row per key and add it as a delta of the table.

    The delta is named after the stream and the batch id, so a batch replayed after a failure
    replaces what it wrote before and the result is as if it ran once. No state is kept in
    memory, and rows that arrive late lose by their event time when the table is read. With
    ``fold_every`` the table's runs are folded after every so many batches.
    """
    order = list(dict.fromkeys([table.timestamp, *([table.created] if table.created else []), *table.tiebreak]))
    kept = list(dict.fromkeys([*order, *columns]))

    def add(batch: DataFrame, batch_id: int) -> None:
        reduced = latest_per_key(batch, table.keys, table.timestamp, kept, table.created, table.tiebreak)
        table.write_batch(reduced, batch_id, origin=name)
        if fold_every and batch_id % fold_every == fold_every - 1:
            table.fold()

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _rank(values: Sequence) -> tuple:
    """Sorts like Spark's structs: nulls before all values."""
    return tuple((v is not None, v) for v in values)


class _Latest(StatefulProcessor):
    """One row of state for each key: its newest row, and a timer for the moment that expires."""

    def __init__(self, order: T.StructType, keys: list[str], life: int) -> None:
        self.order, self.keys, self.life = order, keys, life

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", T.StructType([*self.order.fields, T.StructField("row", T.StringType())]))

    def _expiry(self, kept: tuple) -> int:
        """Milliseconds, rounded up, at which a row has outlived its lifetime."""
        return -(-(kept[0] + self.life) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = [*self.order.names, "row"]
        best = max((tuple(r[n] for n in names) for r in rows), key=lambda r: _rank(r[:-1]))
        old = self.newest.get()  # one call to the state where asking first would be two
        if old is not None and _rank(old[:-1]) >= _rank(best[:-1]):
            return
        if old is not None:
            self.handle.deleteTimer(self._expiry(old))
        self.newest.update(best)
        self.handle.registerTimer(self._expiry(best))
        yield Row(**dict(zip(self.keys, key)), at=best[0], row=best[-1], expired=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self.newest.get()
        if kept is None or self._expiry(kept) > expiredTimerInfo.getExpiryTimeInMs():
            return
        self.newest.clear()
        yield Row(**dict(zip(self.keys, key)), at=kept[0], row=kept[-1], expired=True)

    def close(self) -> None:
        pass


def latest_changes(
    stream: DataFrame,
    keys: Sequence[str],
    timestamp: str,
    columns: Sequence[str],
    ttl: timedelta,
    late: timedelta,
    created: str | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """What changes in the latest row of each key: keys, timestamp, columns and ``expired``.

    A key's row is given with ``expired`` false when it becomes the newest one, and once more with
    ``expired`` true when event time (the newest seen, less ``late``) has passed its time and
    ``ttl`` without a newer one; its state is then dropped, so state is as large as the keys that
    are alive. Rows behind event time are left out, as are rows without a time; rows that
    arrive out of order before that lose by their time. Null keys are a key.

    Tasks first reduce each batch of their own rows to one a key, so a key with much of the stream
    sends few rows through the shuffle; the state then sees one row at a time.
    """
    orders = [c for c in [*([created] if created else []), *tiebreak]]
    kept = list(dict.fromkeys([*orders, *columns]))
    clash = {"at", "row", "own", EXPIRED, "time"} & {*keys, *columns}
    if clash:
        raise ValueError(f"columns named like the changes' own: {sorted(clash)}")
    whole = F.to_json(F.struct(*kept), FORMATS) if kept else F.lit("{}")
    ranks = [_comparable(stream, c).alias(f"order_{i}") for i, c in enumerate(orders)]
    at = F.unix_micros(F.col(timestamp).cast("timestamp"))
    narrow = stream.filter(F.col(timestamp).isNotNull()).select(*keys, at.alias("at"), *ranks, F.xxhash64(whole).alias("own"), whole.alias("row"))
    sorts = [f.name for f in narrow.schema if f.name not in (*keys, "row")]
    names, kinds = list(keys), narrow.schema

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(sorts, kind="stable", na_position="first").drop_duplicates(names, keep="last")

    combined = narrow.mapInPandas(combine, kinds).withColumn("time", F.timestamp_micros("at"))
    timed = combined.withWatermark("time", f"{late // timedelta(milliseconds=1)} milliseconds")
    order = T.StructType([T.StructField(n, kinds[n].dataType) for n in sorts])
    out = T.StructType([*[kinds[k] for k in keys], T.StructField("at", T.LongType()), T.StructField("row", T.StringType()), T.StructField(EXPIRED, T.BooleanType())])
    processor = _Latest(order, names, ttl // timedelta(microseconds=1))
    changed = timed.groupBy(*keys).transformWithState(processor, out, "update", "eventTime")
    parsed = F.from_json("row", T.StructType([stream.schema[c] for c in kept]), FORMATS) if kept else F.lit(None)
    moment = F.timestamp_micros("at").cast(stream.schema[timestamp].dataType).alias(timestamp)
    return changed.select(*keys, moment, parsed.alias("row"), EXPIRED).select(*keys, timestamp, *([f"row.`{c}`" for c in kept if c != timestamp]), EXPIRED)


def _comparable(df: DataFrame, name: str):
    """A column as a number or text that sorts like it."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, (T.BooleanType, T.IntegralType)):
        return value.cast("long")
    if isinstance(kind, (T.DoubleType, T.FloatType, T.StringType)):
        return value
    raise ValueError(f"rows cannot be told apart in a stream by {name!r} of type {kind.simpleString()}")


def expiring_table(spark, path: str, keys: Sequence[str], timestamp: str, created: str | None = None, tiebreak: Sequence[str] = ()) -> LatestTable:
    """A latest table for ``stream_expiring``: of equal rows, the expired one counts."""
    return LatestTable(spark, path, keys, timestamp, created, [*tiebreak, EXPIRED])


def stream_expiring(
    table: LatestTable,
    stream: DataFrame,
    columns: Sequence[str],
    checkpoint: str,
    ttl: timedelta,
    late: timedelta,
    trigger: dict | None = None,
    name: str = "stream",
) -> StreamingQuery:
    """Like ``stream_into``, but only changes reach the table, and rows expire by event time.

    The table holds a column ``expired``; ``table.read()`` gives expired keys with their last row,
    so the live ones are those where it is false. State is kept by RocksDB, whose files go to the
    checkpoint; a batch replayed after a failure replaces what it wrote.
    """
    if EXPIRED not in table.tiebreak:
        raise ValueError("the table must come from expiring_table")
    spark, tiebreak = stream.sparkSession, [c for c in table.tiebreak if c != EXPIRED]
    changes = latest_changes(stream, table.keys, table.timestamp, columns, ttl, late, table.created, tiebreak)
    kept = [c for c in changes.columns if c not in table.keys]

    def add(batch: DataFrame, batch_id: int) -> None:
        reduced = latest_per_key(batch, table.keys, table.timestamp, kept, table.created, table.tiebreak)
        table.write_batch(reduced, batch_id, origin=name)

    writer = changes.writeStream.foreachBatch(add).outputMode("update").option("checkpointLocation", checkpoint)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)  # a query keeps the settings it starts with
    try:
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)
