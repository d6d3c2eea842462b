"""Point-in-time joins and training sets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.checks import keep_samples
from tidemark.session import new_folder, write_through

#: Keys with more rows are walked in segments, of about so many rows at most.
HOT_ROWS = 2_000_000
#: So many segments at most, unless they would hold more rows than that.
SEGMENTS = 200


def entity_values(df: DataFrame, key: str) -> DataFrame:
    """The different values of a key, ascending."""
    if key not in df.columns:
        raise ValueError(f"entity column {key!r} not found")
    return df.select(key).distinct().orderBy(key)


def entity_frame(
    df: DataFrame,
    key: str,
    timestamp: datetime | None = None,
    ingested: str = "ingested_at",
    samples: DataFrame | Sequence | None = None,
) -> DataFrame:
    """Every id with one moment: the given one, or a second after the newest ingest.

    The moment is one value, so it becomes a literal and no join is needed.
    """
    if timestamp is None:
        timestamp = df.agg(F.max(F.col(ingested).cast("timestamp_ntz"))).first()[0]
        if timestamp is None:
            raise ValueError(f"no value in {ingested!r} to take the moment from")
        timestamp += timedelta(seconds=1)
    moment = F.lit(timestamp.isoformat(sep=" ")).cast("timestamp_ntz")
    ids = keep_samples(df.select(key), key, samples).distinct()
    return ids.select(key, moment.cast(_type_of(df, ingested)).alias("event_timestamp"))


def _type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType if column in df.columns else T.TimestampNTZType()


def as_of_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    timestamp: str,
    columns: Sequence[str],
    entity_timestamp: str = "event_timestamp",
    created: str | None = None,
    tiebreak: Sequence[str] = (),
    ttl: timedelta | None = None,
    view: str | None = None,
    full_names: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """For every entity row, the features of the newest row not after its moment.

    Entity rows without such a row, or whose newest row is older than ``ttl``, keep nulls.
    Equal feature times are resolved by ``created``, then by ``tiebreak``, then by a hash of the
    features themselves.

    Both sides are stacked and each key's rows are walked in time order, so the join costs
    one shuffle and never pairs a key's entity rows with its history. Keys with more than
    ``hot_rows`` rows are sorted over all tasks, by key, time and order, and walked in the
    segments that result; each segment hands its newest feature row to those after it.
    ``hot_rows=None`` skips the look for such keys (one aggregate over the keys' hashes).
    """
    prefix = f"{view}__" if full_names and view else ""
    names = [prefix + c for c in columns]
    taken = [n for n in names if n in entities.columns]
    if taken:
        raise ValueError(f"features already in the entity frame: {taken}; use full_names")

    order = [*([created] if created else []), *tiebreak]
    # Ties end in a hash of the features, so the answer does not depend on the rows' arrival.
    own = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(columns)])))
    right = features.select(
        *keys,
        F.col(timestamp).alias("_t"),
        F.struct(*[F.col(c) for c in order], own.alias("_")).alias("_order"),
        F.struct(F.col(timestamp).alias("_t"), *[F.col(c).alias(n) for c, n in zip(columns, names)]).alias("_f"),
    ).dropna(subset=[*keys, "_t"])
    if ttl is not None:
        # Only this stretch of the history can match; the bounds reach the feature scan.
        first, last = entities.agg(F.min(entity_timestamp), F.max(entity_timestamp)).select(
            (F.col(f"min({entity_timestamp})") - _interval(ttl)).cast("string"),
            F.col(f"max({entity_timestamp})").cast("string"),
        ).first()
        kind = _type_of(entities, entity_timestamp)
        right = right.filter(F.col("_t").between(F.lit(first).cast(kind), F.lit(last).cast(kind)))
    rest = [c for c in entities.columns if c not in (*keys, entity_timestamp)]
    left = entities.select(
        *keys, F.col(entity_timestamp).alias("_t"), F.struct(*rest, F.lit(0).alias("_")).alias("_e")
    )

    hot = _hot_hashes(left, right, keys, hot_rows)
    if hot is None:
        matched = _walk(left, right, keys)
    else:
        left, right = (side.withColumn("_h", F.xxhash64(*keys)).join(hot, "_h", "left").drop("_h") for side in (left, right))
        cold = F.col("_n").isNull()
        matched = _walk(left.filter(cold).drop("_n"), right.filter(cold).drop("_n"), keys).unionByName(
            _walk_in_segments(left.filter(~cold).drop("_n"), right.filter(~cold).drop("_n"), keys, hot_rows)
        )
    fresh = F.lit(True) if ttl is None else F.col("_f._t") >= F.col("_t") - _interval(ttl)
    place = {**{c: F.col(f"_e.`{c}`") for c in rest}, **{k: F.col(k) for k in keys}, entity_timestamp: F.col("_t")}
    return matched.select(
        *[place[c].alias(c) for c in entities.columns],
        *[F.when(fresh, F.col(f"_f.`{n}`")).alias(n) for n in names],
    )


def _interval(span: timedelta) -> Column:
    return F.make_dt_interval(
        F.lit(span.days), F.lit(0), F.lit(0), F.lit(float(span.seconds) + span.microseconds / 1e6)
    )


def _hot_hashes(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int | None) -> DataFrame | None:
    """``_h``, the key's hash, and ``_n``, its rows, for keys with more than ``hot_rows`` rows.

    No key or count comes to the driver. Keys that share a hash are treated alike, which is as
    right, only slower. The table is written, so that the planner knows its size.
    """
    if hot_rows is None:
        return None
    both = left.select(F.xxhash64(*keys).alias("_h")).unionByName(right.select(F.xxhash64(*keys).alias("_h")))
    hot = write_through(both.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows), "hot-keys")
    return None if hot.isEmpty() else hot


def _newest_so_far(window) -> Column:
    return F.last("_f", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))


def _stack(left: DataFrame, right: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Entity rows (side 1) and feature rows (side 0) in one frame."""
    entity, feature = left.schema["_e"].dataType, right.schema["_f"].dataType
    above = right.select(
        *extra, "_t", F.lit(0).alias("_side"), "_order", F.lit(None).cast(entity).alias("_e"), "_f"
    )
    below = left.select(
        *extra,
        "_t",
        F.lit(1).alias("_side"),
        F.lit(None).cast(right.schema["_order"].dataType).alias("_order"),
        "_e",
        F.lit(None).cast(feature).alias("_f"),
    )
    return above.unionByName(below)


def _walk(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy("_t", "_side", "_order")
    walked = _stack(left, right, keys).withColumn("_f", _newest_so_far(window))
    return walked.filter("_side = 1").select(*keys, "_t", "_e", "_f")


def _segment_count(rows: int, segment_rows: int) -> int:
    """Segments of ``segment_rows``; of more, up to HOT_ROWS, where there would be over SEGMENTS of them.

    The driver sorts a sample of some hundred rows for each segment to find its range, so small
    segments must not become more with the rows.
    """
    return max(1, min(-(-rows // segment_rows), max(SEGMENTS, -(-rows // HOT_ROWS))))


def _walk_in_segments(left: DataFrame, right: DataFrame, keys: Sequence[str], segment_rows: int) -> DataFrame:
    """``_walk`` as a scan in two levels, for keys too large for one task.

    The stacked rows are dealt to segments by ranges of (key, time, side, order), so a key may
    span many segments, and so may a single moment. Each segment is walked by itself. The newest
    feature row of all segments before is the last one in that order, so one small row for each
    segment is scanned, and what it hands on counts where it has the row's key. Segments are
    written, since every step must see the same ones.
    """
    # Maps have no hash; entity rows of one moment that hold one stay in one segment.
    tie = F.lit(0).cast("long") if "map<" in left.schema["_e"].dataType.simpleString() else F.xxhash64("_e")
    rows = write_through(_stack(left, right, keys).withColumn("_tie", tie), "hot-rows")
    segments = _segment_count(rows.count(), segment_rows)
    along = [*keys, "_t", "_side", "_order", "_tie"]
    dealt = rows.repartitionByRange(segments, *along).withColumn("_segment", F.spark_partition_id())
    path = new_folder(rows.sparkSession, "segments")
    dealt.write.parquet(path)
    dealt = rows.sparkSession.read.schema(dealt.schema).parquet(path)

    own = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    newest = F.max_by(F.struct(own.alias("key"), "_f"), F.struct(*keys, "_t", "_order"))
    # Segments without feature rows hand on what came before them.
    ends = dealt.filter("_side = 0").groupBy("_segment").agg(newest.alias("_last"))
    ends = dealt.select("_segment").distinct().join(ends, "_segment", "left")
    before = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(F.col("_segment").alias("_of"), F.last("_last", ignorenulls=True).over(before).alias("_handed"))
    handed = write_through(handed.filter("_handed IS NOT NULL"), "handed")

    window = Window.partitionBy("_segment", *keys).orderBy("_t", "_side", "_order")
    walked = dealt.withColumn("_f", _newest_so_far(window)).filter("_side = 1")
    joined = walked.join(handed, (F.col("_segment") == F.col("_of")) & own.eqNullSafe(F.col("_handed.key")), "left")
    return joined.select(*keys, "_t", "_e", F.coalesce("_f", "_handed._f").alias("_f"))


def training_set(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    timestamp: str,
    feature_names: Sequence[str],
    label: str,
    **options,
) -> DataFrame:
    """Keys, features and label as of each entity row's moment."""
    joined = as_of_join(entities, features, keys, timestamp, [*feature_names, label], **options)
    prefix = f"{options['view']}__" if options.get("full_names") and options.get("view") else ""
    return joined.select(*keys, *[prefix + c for c in feature_names], prefix + label)
