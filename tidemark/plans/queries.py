"""One query per operator over the given tables, each with its SQL equivalent where SQL can say it.

Missing values are put in by a rule on the row (an error event has no reading, a furniture
customer no known balance), the same in both engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import asof, calibrate, checks, latest, metrics, prep, select, splits, tuning
from tidemark.operators.calibrate import CalibratedPipeline
from tidemark.operators.model import ClassifierPipeline
from tidemark.plans import workflow as flow
from tidemark.session import new_folder, write_through
from tidemark.sources import tables
from tidemark.specs import (
    CalibrationSpec,
    ClassifierSpec,
    FeatureSelection,
    FeatureStoreSpec,
    GridSearchSpec,
    RandomSearchSpec,
    categorical_features,
    numeric_features,
)
from tidemark.streaming.latest_stream import expiring_table, stream_expiring, stream_into

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# ---------------------------------------------------------------- shared inputs


def orders_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in the shape of a training table: id, features, label and ingest columns."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_index"),
        F.col("o_totalprice").alias("feature_10"),
        F.col("o_custkey").cast("double").alias("feature_2"),
        F.month("o_orderdate").cast("double").alias("feature_1"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("long").alias("target"),
        F.col("o_orderdate").alias("ingested_at"),
        F.to_date("o_orderdate").alias("ingested_date"),
    )


ORDERS_SQL = """
orders_table AS (
  SELECT o_orderkey AS sample_index, o_totalprice AS feature_10,
         CAST(o_custkey AS DOUBLE) AS feature_2, CAST(month(o_orderdate) AS DOUBLE) AS feature_1,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS target
  FROM orders)"""


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a numeric reading that error events lack."""
    return table(spark, sf, "events").withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )


READINGS_SQL = """
readings AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"""


def balances(spark: SparkSession, sf: str) -> DataFrame:
    known = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_acctbal"))
    return table(spark, sf, "customer").select("c_custkey", known.alias("c_acctbal"), "c_mktsegment")


BALANCES_SQL = """
balances AS (
  SELECT c_custkey, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer)"""


def part_types(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type")
    )


PART_TYPES_SQL = """
part_types AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_type END AS p_type FROM part)"""


#: Signs whose share of a text is a feature, by feature number.
SIGNS = {"feature_2": "A-Z", "feature_3": "0-9", "feature_4": "!", "feature_5": "|", "feature_6": "%$#*&"}

SAMPLES_SQL = """
counted AS (
  SELECT doc_id AS sample_index, CAST(length(text) AS DOUBLE) AS feature_0,
         CAST(len(string_split(text, chr(10))) AS DOUBLE) AS feature_1, """ + ",\n         ".join(
    f"length(regexp_replace(text, '[^{signs}]', '', 'g')) / CAST(greatest(length(text), 1) AS DOUBLE) AS {name}"
    for name, signs in SIGNS.items()
) + """,
         CAST(len(string_split(text, ' ')) AS DOUBLE) AS feature_7, quality, toxic
  FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL)"""


def sample_measures(text: Column) -> list[Column]:
    """Eight measures of a text."""
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    # Whole stretches of other signs go at once, which is a third of the work.
    shares = [(F.length(F.regexp_replace(text, f"[^{signs}]+", "")) / size).alias(name) for name, signs in SIGNS.items()]
    return [
        F.length(text).cast("double").alias("feature_0"),
        F.size(F.split(text, "\n", -1)).cast("double").alias("feature_1"),
        *shares,
        F.size(F.split(text, " ", -1)).cast("double").alias("feature_7"),
    ]


def sample_target(n_classes: int) -> Column:
    return F.col("quality") if n_classes == 2 else F.when(F.col("quality") == 0, 0).otherwise(2 - F.col("toxic"))


def document_samples(spark: SparkSession, sf: str, n_classes: int = 2) -> DataFrame:
    """Labelled documents with eight measures of their text; bad, toxic and good ones for three classes.

    Texts are measured where they are read, so that a join by shuffle moves numbers only.
    """
    text = F.col("text")
    labels = table(spark, sf, "labels").dropna(subset=["quality", "toxic"])
    measured = table(spark, sf, "documents").filter(text.isNotNull()).select(F.col("doc_id").alias("sample_index"), *sample_measures(text))
    rows = measured.join(labels, F.col("sample_index") == F.col("doc_id"))
    return rows.select(*measured.columns, sample_target(n_classes).alias("target"))


def stored_samples(spark: SparkSession, sf: str, n_classes: int = 2) -> DataFrame:
    """``document_samples`` as narrow rows that are written once, so that no text is measured twice."""
    return write_through(document_samples(spark, sf, n_classes), "samples")


def measured_documents(spark: SparkSession, sf: str, n_classes: int = 2) -> DataFrame:
    """All documents in the same form, written once; ``target`` is null where there is no label."""
    labels = table(spark, sf, "labels").dropna(subset=["quality", "toxic"])
    text = F.coalesce("text", F.lit(""))
    measured = table(spark, sf, "documents").select(F.col("doc_id").alias("sample_index"), *sample_measures(text))
    rows = measured.join(labels, F.col("sample_index") == F.col("doc_id"), "left")
    target = F.when(F.col("quality").isNotNull(), sample_target(n_classes)).alias("target")
    return write_through(rows.select(*measured.columns, target), "samples")


def sample_pipeline(n_features: int = 8, **hyperparameters) -> ClassifierPipeline:
    settings = {"n_estimators": 5, "max_depth": 3, **hyperparameters}
    return ClassifierPipeline(
        numeric_features([f"feature_{i}" for i in range(n_features)]),
        ClassifierSpec(model_name="trees", hyperparameters=settings, random_state=7),
    )


def returned_items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the label "was returned" and a day number."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01")).cast("double").alias("ship_day"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )


RETURNED_SQL = """
returned_items AS (
  SELECT l_discount, l_extendedprice, l_tax,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS called
  FROM lineitem)"""


def called_items(spark: SparkSession, sf: str) -> DataFrame:
    """Returned items with a rule's call: a high discount predicts a return."""
    called = F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)
    return returned_items(spark, sf).withColumn("called", called)


# ---------------------------------------------------------------- sources and sinks


@query("SELECT * FROM orders")
def read_table(spark, sf):
    return table(spark, sf, "orders")


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00') WHERE rn = 1""")
def read_as_of(spark, sf):
    return tables.read_as_of(
        spark, f"{sf}/events.parquet", "ts", ntz("2024-01-15 12:00:00"), ["user_id"], tiebreak=["event_id"]
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def write_roundtrip(spark, sf):
    path = new_folder(spark, "orders")
    tables.write_table(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    return tables.read_table(spark, path)


@query("""
SELECT count(*) AS num_rows, CAST(6 AS INTEGER) AS num_columns,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
       'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>' AS schema
FROM orders""")
def table_info(spark, sf):
    return tables.table_info(table(spark, sf, "orders"))


@query(f"""WITH {BALANCES_SQL}
SELECT 'c_custkey' AS "column", count(*) AS num_records, count(*) - count(c_custkey) AS null_count,
       CAST(min(c_custkey) AS DOUBLE) AS min_number, CAST(max(c_custkey) AS DOUBLE) AS max_number,
       CAST(min(c_custkey) AS VARCHAR) AS min_text, CAST(max(c_custkey) AS VARCHAR) AS max_text FROM balances
UNION ALL
SELECT 'c_acctbal', count(*), count(*) - count(c_acctbal), min(c_acctbal), max(c_acctbal), NULL, NULL FROM balances
UNION ALL
SELECT 'c_mktsegment', count(*), count(*) - count(c_mktsegment), NULL, NULL, min(c_mktsegment), max(c_mktsegment)
FROM balances""")
def column_profile(spark, sf):
    return tables.column_profile(balances(spark, sf))


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS num_records, count(*) - count({c}) AS null_count,
  {f"CAST(min({c}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"} AS min_number, {f"CAST(max({c}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"} AS max_number,
  {f"CAST(min({c}) AS VARCHAR)" if text else "CAST(NULL AS VARCHAR)"} AS min_text, {f"CAST(max({c}) AS VARCHAR)" if text else "CAST(NULL AS VARCHAR)"} AS max_text FROM lineitem"""
    for c, number, text in (
        ("l_orderkey", True, True), ("l_partkey", True, True), ("l_suppkey", True, True), ("l_linenumber", True, True),
        ("l_quantity", True, False), ("l_extendedprice", True, False), ("l_discount", True, False), ("l_tax", True, False),
        ("l_returnflag", False, True), ("l_linestatus", False, True), ("l_shipdate", False, True))))
def table_profile(spark, sf):
    """Keys are profiled from the files' footers, other columns by a scan."""
    return tables.profile_table(spark, f"{sf}/lineitem.parquet")


@query("""WITH wide AS (SELECT vec_id + 9007199254740993 AS big, embedding, label FROM embeddings)
SELECT 'big' AS "column", count(*) AS num_records, count(*) - count(big) AS null_count,
       CAST(min(big) AS DOUBLE) AS min_number, CAST(max(big) AS DOUBLE) AS max_number,
       CAST(min(big) AS VARCHAR) AS min_text, CAST(max(big) AS VARCHAR) AS max_text FROM wide
UNION ALL
SELECT 'embedding', count(*), count(*) - count(embedding), NULL, NULL, NULL, NULL FROM wide
UNION ALL
SELECT 'label', count(*), count(*) - count(label), CAST(min(label) AS DOUBLE), CAST(max(label) AS DOUBLE),
       CAST(min(label) AS VARCHAR), CAST(max(label) AS VARCHAR) FROM wide""")
def column_profile_nested(spark, sf):
    """Lists have counts only; whole numbers beyond 2**53 are exact as text."""
    df = table(spark, sf, "embeddings")
    return tables.column_profile(df.select((F.col("vec_id") + 9007199254740993).alias("big"), "embedding", "label"))


@query(f"WITH {ORDERS_SQL} SELECT sample_index, feature_1, feature_2, feature_10, target FROM orders_table")
def load_labelled(spark, sf):
    return tables.load_labelled(orders_table(spark, sf))


@query(f"WITH {SAMPLES_SQL} SELECT * EXCLUDE (quality, toxic), quality AS target FROM counted")
def labelled_documents(spark, sf):
    return document_samples(spark, sf)


# ---------------------------------------------------------------- columns


@query(f"WITH {ORDERS_SQL} SELECT feature_1, feature_2, feature_10 FROM orders_table")
def feature_columns(spark, sf):
    df = orders_table(spark, sf)
    return df.select(*select.feature_columns(df))


@query(f"WITH {ORDERS_SQL} SELECT feature_10 FROM orders_table")
def select_features(spark, sf):
    df = orders_table(spark, sf)
    chosen = FeatureSelection(
        selection_mode="indices", feature_indices=[2, 0, 9], exclude_features=["feature_2"], max_features=1
    )
    return select.select_features(df, chosen, select.feature_columns(df))


@query(f"""WITH {ORDERS_SQL}
SELECT sample_index, feature_1 AS orders_view__feature_1, feature_2 AS orders_view__feature_2,
       feature_10 AS orders_view__feature_10 FROM orders_table""")
def feature_refs(spark, sf):
    df = orders_table(spark, sf)
    features = select.feature_columns(df)
    return select.with_view_names(df.select("sample_index", *features), "orders_view", features)


@query("""
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, c_mktsegment FROM customer""")
def cast_schema(spark, sf):
    names = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]
    schema = select.feature_schema(names, ["Float64", "Int64", "Int64", "String"])
    return select.apply_schema(table(spark, sf, "customer"), schema)


@query("""
SELECT l_orderkey, l_linenumber, l_quantity AS x0, l_extendedprice AS x1, l_discount AS x2, l_tax AS x3
FROM lineitem""")
def assemble(spark, sf):
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = select.assemble(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *features), features)
    values = vector_to_array("features")
    return rows.select("l_orderkey", "l_linenumber", *[values[i].alias(f"x{i}") for i in range(4)])


@query("""
SELECT round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
       c_mktsegment, c_custkey, c_nationkey FROM customer""")
def column_transform(spark, sf):
    df = table(spark, sf, "customer").drop("c_name")
    same = categorical_features(["c_mktsegment"], imputer_enabled=False, encoder_enabled=False)
    return rounded(prep.FeaturePipeline([*numeric_features(["c_acctbal"]), *same]).fit_transform(df), "c_acctbal")


# ---------------------------------------------------------------- checks


@query("""
SELECT 'l_discount' AS "column", count(*) FILTER (l_returnflag = 'A') AS nulls,
       count(*) FILTER (l_returnflag <> 'A' AND l_discount = 0) AS nans, CAST(0 AS BIGINT) AS infinities FROM lineitem
UNION ALL
SELECT 'l_tax', 0, 0, count(*) FILTER (l_tax = 0) FROM lineitem""")
def nonfinite_counts(spark, sf):
    return checks.nonfinite_counts(_blemished(spark, sf), ["l_discount", "l_tax"])


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A' OR l_discount = 0 OR l_tax = 0""")
def quarantine(spark, sf):
    rows = checks.quarantine(_blemished(spark, sf), ["l_discount", "l_tax"])
    return rows.select("l_orderkey", "l_linenumber")


def _blemished(spark, sf):
    discount = F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "A", discount).alias("l_discount"),
        F.when(F.col("l_tax") == 0, float("-inf")).otherwise(F.col("l_tax")).alias("l_tax"),
    )


@query("""
SELECT count(*) AS num_rows, count(*) - count(quality) AS null_labels, count(DISTINCT quality) AS num_labels
FROM documents LEFT JOIN labels USING (doc_id)""")
def frame_checks(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return checks.frame_counts(docs.join(table(spark, sf, "labels"), "doc_id", "left"), "quality")


@query("SELECT DISTINCT o_orderpriority FROM orders")
def label_classes(spark, sf):
    return checks.label_classes(table(spark, sf, "orders"), "o_orderpriority")


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def sample_filter(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return checks.keep_samples(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", returned)


# ---------------------------------------------------------------- point-in-time joins


@query("SELECT DISTINCT user_id FROM events")
def entity_values(spark, sf):
    return asof.entity_values(table(spark, sf, "events"), "user_id")


@query("""
SELECT DISTINCT user_id, (SELECT max(ts) FROM events) + INTERVAL 1 SECOND AS event_timestamp FROM events""")
def entity_frame(spark, sf):
    return asof.entity_frame(table(spark, sf, "events"), "user_id", ingested="ts")


def purchases(events: DataFrame) -> DataFrame:
    bought = events.filter("event_type = 'purchase'")
    return bought.select("event_id", "user_id", F.col("ts").alias("event_timestamp"))


def other_events(events: DataFrame) -> DataFrame:
    return events.filter("event_type <> 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("last_id"), F.col("event_type").alias("last_type"), "value"
    )


def pit_sql(extra: str = "", valid: str = "TRUE") -> str:
    return f"""WITH {READINGS_SQL},
bought AS (SELECT event_id, user_id, ts AS event_timestamp FROM readings WHERE event_type = 'purchase'),
other AS (SELECT * FROM (
  SELECT user_id, ts, event_id AS last_id, event_type AS last_type, value,
         row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
  FROM readings WHERE event_type <> 'purchase') WHERE rn = 1)
SELECT b.event_id, b.user_id, b.event_timestamp,
       CASE WHEN {valid} THEN o.last_id END AS last_id, CASE WHEN {valid} THEN o.last_type END AS last_type,
       CASE WHEN {valid} THEN o.value END AS value {extra}
FROM bought b ASOF LEFT JOIN other o ON b.user_id = o.user_id AND b.event_timestamp >= o.ts"""


OTHER = ["last_id", "last_type", "value"]


@query(pit_sql())
def pit_join(spark, sf):
    events = readings(spark, sf)
    return asof.as_of_join(purchases(events), other_events(events), ["user_id"], "ts", OTHER, tiebreak=["last_id"])


@query(pit_sql(valid="o.ts >= b.event_timestamp - INTERVAL 9 HOUR"))
def pit_join_ttl(spark, sf):
    events = readings(spark, sf)
    return asof.as_of_join(
        purchases(events), other_events(events), ["user_id"], "ts", OTHER, tiebreak=["last_id"], ttl=timedelta(hours=9)
    )


@query(f"""WITH {READINGS_SQL},
bought AS (SELECT event_id, user_id, ts AS event_timestamp FROM readings WHERE event_type = 'purchase'),
other AS (SELECT * FROM (
  SELECT user_id, date_trunc('day', ts) AS day, event_id AS last_id, event_type AS last_type, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) AS rn
  FROM readings WHERE event_type <> 'purchase') WHERE rn = 1)
SELECT b.event_id, b.user_id, b.event_timestamp, o.last_id, o.last_type, o.value
FROM bought b ASOF LEFT JOIN other o ON b.user_id = o.user_id AND b.event_timestamp >= o.day""")
def pit_join_created(spark, sf):
    events = readings(spark, sf)
    daily = other_events(events).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return asof.as_of_join(
        purchases(events), daily, ["user_id"], "day", OTHER, created="ts", tiebreak=["last_id"]
    )


@query(f"""WITH {READINGS_SQL},
moments AS (SELECT event_id, user_id, event_type, ts - INTERVAL 1 DAY AS event_timestamp FROM readings),
known AS (SELECT * FROM (
  SELECT user_id, event_type, ts, event_id AS last_id, value,
         row_number() OVER (PARTITION BY user_id, event_type, ts ORDER BY event_id DESC) AS rn
  FROM readings) WHERE rn = 1)
SELECT m.event_id, m.user_id, m.event_type, m.event_timestamp, k.last_id, k.value
FROM moments m ASOF LEFT JOIN known k
  ON m.user_id = k.user_id AND m.event_type = k.event_type AND m.event_timestamp >= k.ts""")
def pit_join_composite(spark, sf):
    events = readings(spark, sf)
    moments = events.select(
        "event_id", "user_id", "event_type", (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("event_timestamp")
    )
    known = events.select("user_id", "event_type", "ts", F.col("event_id").alias("last_id"), "value")
    return asof.as_of_join(moments, known, ["user_id", "event_type"], "ts", ["last_id", "value"], tiebreak=["last_id"])


def one_busy_user(df: DataFrame) -> DataFrame:
    """Hand the views and clicks and every second's worth of purchases to one user."""
    busy = F.col("event_type").isin("view", "click") | (F.second("ts") < 30)
    return df.withColumn("user_id", F.when(busy, 0).otherwise(F.col("user_id")))


@query(pit_sql().replace(
    "SELECT event_id, ts, user_id, event_type,\n         CASE",
    """SELECT event_id, ts, event_type,
         CASE WHEN event_type IN ('view', 'click') OR second(ts) < 30 THEN 0 ELSE user_id END AS user_id,
         CASE"""))
def pit_join_hot_key(spark, sf):
    """The same join when one key holds most of the rows, which are then walked in segments."""
    events = one_busy_user(readings(spark, sf))
    return asof.as_of_join(
        purchases(events), other_events(events), ["user_id"], "ts", OTHER, tiebreak=["last_id"], hot_rows=500
    )


@query("""WITH
rows_ AS (
  SELECT event_id, event_type, value, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS user_id,
         TIMESTAMP '2024-01-15 12:00:00' + to_microseconds(event_id * 7919 % 1000000) AS ts
  FROM events),
known AS (SELECT * FROM (
  SELECT user_id, ts, event_id AS last_id, value, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
  FROM rows_ WHERE event_type <> 'purchase') WHERE rn = 1)
SELECT r.event_id, r.user_id, r.ts AS event_timestamp, k.last_id, k.value
FROM rows_ r ASOF LEFT JOIN known k ON r.user_id = k.user_id AND r.ts >= k.ts
WHERE r.event_type = 'purchase'""")
def pit_join_one_second(spark, sf):
    """All rows belong to two keys and lie within one second."""
    later = F.expr("make_dt_interval(0, 0, 0, CAST(CAST(event_id * 7919 % 1000000 AS DECIMAL(18, 6)) / 1000000 AS DECIMAL(18, 6)))")
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.when(F.col("event_id") % 5 == 0, 1).otherwise(0).alias("user_id"),
        (F.expr("timestamp_ntz'2024-01-15 12:00:00'") + later).alias("ts"),
    )
    known = other_events(rows).drop("last_type")
    return asof.as_of_join(purchases(rows), known, ["user_id"], "ts", ["last_id", "value"], tiebreak=["last_id"], hot_rows=500)


@query("""WITH
samples AS (
  SELECT event_id, user_id, ts AS event_timestamp FROM events WHERE event_type = 'purchase'),
known AS (SELECT * FROM (
  SELECT user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS target,
         row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
  FROM events WHERE event_type <> 'purchase') WHERE rn = 1),
joined AS (
  SELECT s.user_id, CASE WHEN k.ts >= s.event_timestamp - INTERVAL 10 DAY THEN k.value END AS value,
         CASE WHEN k.ts >= s.event_timestamp - INTERVAL 10 DAY THEN k.k END AS k,
         CASE WHEN k.ts >= s.event_timestamp - INTERVAL 10 DAY THEN k.target END AS target
  FROM samples s ASOF LEFT JOIN known k ON s.user_id = k.user_id AND s.event_timestamp >= k.ts),
filled AS (
  SELECT user_id, coalesce(value, avg(value) OVER ()) AS value, coalesce(k, avg(k) OVER ()) AS k, target FROM joined)
SELECT round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS value,
       round((k - avg(k) OVER ()) / stddev_pop(k) OVER (), 6) AS k, user_id, target FROM filled""")
def training_set(spark, sf):
    """Flagship: a training set as of each purchase, imputed and scaled."""
    events = table(spark, sf, "events")
    known = events.filter("event_type <> 'purchase'").select(
        "user_id",
        "ts",
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("k"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("target"),
    )
    samples = purchases(events)
    rows = asof.training_set(
        samples, known, ["user_id"], "ts", ["value", "k"], "target", tiebreak=["event_id"], ttl=timedelta(days=10)
    )
    rows = write_through(rows, "training")  # fitting and transforming read the joined rows
    return rounded(prep.FeaturePipeline(numeric_features(["value", "k"])).fit_transform(rows), "value", "k")


# ---------------------------------------------------------------- latest values


LATEST = ["event_id", "event_type", "value"]


def latest_sql(where: str) -> str:
    return f"""
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE {where}) WHERE rn = 1"""


@query(latest_sql("ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"))
def materialize(spark, sf):
    return latest.materialize(
        table(spark, sf, "events"), ["user_id"], "ts", LATEST, datetime(2024, 1, 5), datetime(2024, 1, 20),
        tiebreak=["event_id"],
    )


def latest_events(spark: SparkSession) -> latest.LatestTable:
    return latest.LatestTable(spark, new_folder(spark, "latest"), ["user_id"], "ts", tiebreak=["event_id"])


@query(latest_sql("ts <= TIMESTAMP '2024-01-28'"))
def materialize_incremental(spark, sf):
    events, kept = table(spark, sf, "events"), latest_events(spark)
    for day in (10, 20, 28):
        kept.materialize_incremental(events, LATEST, datetime(2024, 1, day))
    return kept.read()


@query(latest_sql("TRUE"))
def stream_materialize(spark, sf):
    events, kept, arriving = table(spark, sf, "events"), latest_events(spark), new_folder(spark, "arriving")
    events.repartition(4).write.parquet(arriving)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    stream_into(kept, stream, LATEST, new_folder(spark, "stream")).awaitTermination()
    return kept.read()


@query(latest_sql("TRUE"))
def stream_materialize_folded(spark, sf):
    """A stream of eight batches whose runs are folded in place between batches."""
    events, kept, arriving = table(spark, sf, "events"), latest_events(spark), new_folder(spark, "arriving")
    events.repartition(8).write.parquet(arriving)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    stream_into(kept, stream, LATEST, new_folder(spark, "stream"), fold_every=3).awaitTermination()
    return kept.fold(2).read()


@query("""
SELECT user_id, ts, event_id, event_type, value,
       ts + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR AS expired FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_expiry(spark, sf):
    """Events that arrive up to 20 hours late, in six batches; users without news for six hours expire."""
    events, arriving, checkpoint = table(spark, sf, "events"), new_folder(spark, "arriving"), new_folder(spark, "stream")
    hours = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000) + F.pmod(F.xxhash64("event_id"), F.lit(20))
    first, last = events.select(F.min(hours), F.max(hours)).first() if not events.isEmpty() else (0, 0)
    step = (last - first) // 6 + 1
    kept = expiring_table(spark, new_folder(spark, "latest"), ["user_id"], "ts", tiebreak=["event_id"])
    for part in range(6):  # all that has arrived is one batch, in however many files
        events.filter(F.floor((hours - first) / step) == part).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(events.schema).parquet(arriving)
        stream_expiring(kept, stream, LATEST, checkpoint, timedelta(hours=6), timedelta(hours=24)).awaitTermination()
    return kept.read()


@query("""
SELECT c.c_custkey AS user_id, l.event_type, l.value FROM customer c LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                 FROM events) WHERE rn = 1) l ON l.user_id = c.c_custkey""")
def online_lookup(spark, sf):
    kept = latest_events(spark)
    kept.materialize(table(spark, sf, "events"), LATEST, datetime(2024, 1, 1), datetime(2024, 2, 1))
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return kept.lookup(asked, ["event_type", "value"])


# ---------------------------------------------------------------- preprocessing


PLAIN = {"scaler_type": "none"}


def transformed(df: DataFrame, specs, *names: str) -> DataFrame:
    return rounded(prep.FeaturePipeline(specs).fit_transform(df), *names)


@query(f"""WITH {READINGS_SQL}
SELECT event_id, round(coalesce(value, avg(value) OVER ()), 6) AS value FROM readings""")
def impute_mean(spark, sf):
    df = readings(spark, sf).select("event_id", "value")
    return transformed(df, numeric_features(["value"], **PLAIN), "value")


@query(f"""WITH {READINGS_SQL}
SELECT event_id, round(coalesce(value, (SELECT median(value) FROM readings)), 6) AS value FROM readings""")
def impute_median(spark, sf):
    df = readings(spark, sf).select("event_id", "value")
    return transformed(df, numeric_features(["value"], imputer_strategy="median", **PLAIN), "value")


@query(f"WITH {READINGS_SQL} SELECT event_id, coalesce(value, -1.0) AS value FROM readings")
def impute_const(spark, sf):
    specs = numeric_features(["value"], imputer_strategy="constant", imputer_fill_value=-1.0, **PLAIN)
    return prep.FeaturePipeline(specs).fit_transform(readings(spark, sf).select("event_id", "value"))


@query(f"""WITH {PART_TYPES_SQL}
SELECT p_partkey, coalesce(p_type, (
  SELECT p_type FROM part_types WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1)) AS p_type
FROM part_types""")
def impute_mode(spark, sf):
    specs = categorical_features(["p_type"], encoder_type="none")
    return prep.FeaturePipeline(specs).fit_transform(part_types(spark, sf))


@query(f"WITH {PART_TYPES_SQL} SELECT p_partkey, coalesce(p_type, 'unknown') AS p_type FROM part_types")
def impute_const_str(spark, sf):
    specs = categorical_features(
        ["p_type"], imputer_strategy="constant", imputer_fill_value="unknown", encoder_type="none"
    )
    return prep.FeaturePipeline(specs).fit_transform(part_types(spark, sf))


ITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in ITEM_NUMBERS
) + " FROM lineitem")
def scale_standard(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *ITEM_NUMBERS)
    return transformed(df, numeric_features(ITEM_NUMBERS), *ITEM_NUMBERS)


@query("""WITH q AS (
  SELECT quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS a, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS b
  FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - a[2]) / (a[3] - a[1]), 6) AS l_quantity,
       round((l_extendedprice - b[2]) / (b[3] - b[1]), 6) AS l_extendedprice FROM lineitem, q""")
def scale_robust(spark, sf):
    names = ["l_quantity", "l_extendedprice"]
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *names)
    return transformed(df, numeric_features(names, scaler_type="robust"), *names)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"c_mktsegment_{s}\"" for s in SEGMENTS
) + " FROM customer")
def one_hot(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prep.FeaturePipeline(categorical_features(["c_mktsegment"])).fit_transform(df)


@query("""WITH kinds AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
         md5(CAST(o_orderkey AS VARCHAR)) AS code, md5(CAST(o_custkey AS VARCHAR)) AS buyer FROM orders),
filled AS (SELECT o_orderkey, code, buyer, coalesce(priority, '0-NONE') AS priority FROM kinds),
places AS (SELECT code, row_number() OVER (ORDER BY code) - 2 AS place FROM filled),
top AS (SELECT buyer FROM filled GROUP BY 1 ORDER BY count(*) DESC, buyer LIMIT 1)
SELECT o_orderkey, buyer, CASE WHEN place >= 0 THEN place END AS code_position,
       """ + ", ".join(f"CASE WHEN priority = '{p}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"priority_{p}\"" for p in PRIORITIES) + """
FROM filled JOIN places USING (code)""")
def one_hot_wide(spark, sf):
    """A column with a category for each row, one with few and a constant fill, one without encoder."""
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("code"),
        F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("buyer"),
    )
    specs = [
        *categorical_features(["code"]),
        *categorical_features(["priority"], imputer_strategy="constant", imputer_fill_value="0-NONE"),
        *categorical_features(["buyer"], encoder_enabled=False),
    ]
    return prep.FeaturePipeline(specs).fit_transform(df)


def coded_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a number, a category of few values and one with a value for each row."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("code"),
    )


@query("""WITH kinds AS (
  SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
         md5(CAST(o_orderkey AS VARCHAR)) AS code FROM orders),
filled AS (SELECT * REPLACE (coalesce(priority, '0-NONE') AS priority) FROM kinds),
named AS (
  SELECT o_orderkey, 'o_totalprice' AS name, o_totalprice AS value FROM filled WHERE o_totalprice <> 0
  UNION ALL SELECT o_orderkey, 'code_' || code, 1.0 FROM filled WHERE code > (SELECT min(code) FROM filled)
  UNION ALL SELECT o_orderkey, 'priority_' || priority, 1.0 FROM filled WHERE priority > (SELECT min(priority) FROM filled))
SELECT o_orderkey, name, CAST(value AS DOUBLE) AS value,
       (SELECT count(DISTINCT code) - 1 + count(DISTINCT priority) FROM filled) AS slots FROM named""")
def one_hot_vector(spark, sf):
    """One sparse vector for a number, few categories and very many; its slots by their names."""
    specs = [
        *categorical_features(["code"]),
        *numeric_features(["o_totalprice"], **PLAIN),
        *categorical_features(["priority"], imputer_strategy="constant", imputer_fill_value="0-NONE"),
    ]
    df = coded_orders(spark, sf)
    fitted = prep.FeaturePipeline(specs).fit(df)
    # A vector's JSON lists its size, places and values without spreading them out.
    parts = F.from_json(F.to_json(F.struct("features")), "features struct<type: int, size: int, indices: array<int>, values: array<double>>")["features"]
    sparse = fitted.vectors(df).select("o_orderkey", parts.alias("v"))
    places = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
    cells = sparse.select("o_orderkey", F.coalesce("v.size", F.size("v.values")).cast("long").alias("slots"), F.explode(F.arrays_zip(places.alias("slot"), F.col("v.values").alias("value"))).alias("c"))
    cells = cells.filter("c.value <> 0").select("o_orderkey", "slots", F.col("c.slot").cast("long").alias("slot"), "c.value")
    return cells.join(fitted.slots(), "slot").select("o_orderkey", "name", "value", "slots")


@query("""WITH s AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS buyer, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y FROM orders),
t AS (SELECT count(*) AS n, avg(y) AS p FROM s),
kinds AS (SELECT buyer, CAST(count(*) AS DOUBLE) AS k, sum(y) AS f FROM s GROUP BY buyer),
gains AS (
  SELECT buyer, k, f - k * p AS r, n, p, k * (n - k) / n * power((f - k * p) / k + (f - k * p) / (n - k), 2) AS gain
  FROM kinds, t WHERE buyer > (SELECT min(buyer) FROM s)),
best AS (SELECT * FROM gains WHERE gain >= (SELECT max(gain) FROM gains) * (1 - 1e-9) ORDER BY buyer LIMIT 1),
scored AS (
  SELECT o_orderkey, 1 / (1 + exp(-(ln(p / (1 - p)) + 0.5 * CASE WHEN s.buyer = b.buyer THEN r / k ELSE -r / (n - k) END / (p * (1 - p))))) AS q
  FROM s, best b)
SELECT o_orderkey, round(q, 6) AS probability, CAST(CASE WHEN q > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction FROM scored""")
def gbt_wide_category(spark, sf):
    """A tree that parts one of very many categories from the others, as a tree on one-hot columns does."""
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("buyer"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("long").alias("target"),
    )
    settings = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.5, "min_samples_split": 3}
    spec = ClassifierSpec(model_name="trees", hyperparameters=settings, random_state=7)
    model = ClassifierPipeline(categorical_features(["buyer"]), spec).fit(df, "target")
    scored = model.transform(df)
    return scored.select("o_orderkey", F.round(F.col("probability")[1], 6).alias("probability"), "prediction")


@query("""WITH named AS (SELECT p_partkey, p_name FROM part),
places AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 2 AS place FROM (SELECT DISTINCT p_name FROM part))
SELECT p_partkey, p_name, CASE WHEN place >= 0 THEN place END AS p_name_position
FROM named LEFT JOIN places USING (p_name)""")
def one_hot_positions(spark, sf):
    return prep.category_positions(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name")


@query(f"""WITH {BALANCES_SQL},
filled AS (
  SELECT c_custkey, coalesce(c_acctbal, (SELECT median(c_acctbal) FROM balances)) AS c_acctbal, c_mktsegment
  FROM balances)
SELECT c_custkey, c_mktsegment,
       round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal FROM filled""")
def prep_chain(spark, sf):
    return transformed(
        balances(spark, sf), numeric_features(["c_acctbal"], imputer_strategy="median"), "c_acctbal"
    )


@query("""WITH s AS (
  SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice
FROM orders, s WHERE o_orderdate >= TIMESTAMP '1996-01-01'""")
def fit_transform_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    before = F.col("o_orderdate") < ntz("1996-01-01")
    fitted = prep.FeaturePipeline(numeric_features(["o_totalprice"])).fit(df.filter(before))
    return rounded(fitted.transform(df.filter(~before)).drop("o_orderdate"), "o_totalprice")


@query(f"""WITH {BALANCES_SQL},
kinds AS (
  SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM balances),
top AS (SELECT segment FROM kinds WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, segment LIMIT 1),
filled AS (
  SELECT c_custkey, coalesce(c_acctbal, avg(c_acctbal) OVER ()) AS c_acctbal,
         coalesce(segment, (SELECT segment FROM top)) AS segment FROM kinds)
SELECT round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
       CASE WHEN segment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "segment_BUILDING",
       CASE WHEN segment = 'HOUSEHOLD' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "segment_HOUSEHOLD",
       CASE WHEN segment = 'MACHINERY' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "segment_MACHINERY",
       c_custkey FROM filled""")
def preprocess(spark, sf):
    df = balances(spark, sf).select(
        "c_custkey", "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    )
    return transformed(df, [*numeric_features(["c_acctbal"]), *categorical_features(["segment"])], "c_acctbal")


# ---------------------------------------------------------------- splits


@query("""WITH r AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5('42:' || o_orderkey), 1, 13), o_orderkey) - 1 AS r,
         count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
                             ELSE (r - n % 5) // (n // 5) END AS INTEGER) AS fold FROM r""")
def kfold(spark, sf):
    return splits.kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)


def spread_sql(order: str, before: str = "") -> str:
    """Deal the label-sorted rows to five folds, then hand each label's folds out in order."""
    return f"""WITH {before}first AS (SELECT o_orderstatus, min(o_orderkey) AS f FROM orders GROUP BY 1),
dealt AS (
  SELECT o_orderstatus, (row_number() OVER (ORDER BY f, o_orderkey) - 1) % 5 AS fold
  FROM orders JOIN first USING (o_orderstatus)),
places AS (SELECT o_orderstatus, fold, row_number() OVER (PARTITION BY o_orderstatus ORDER BY fold) AS r FROM dealt),
ranked AS (
  SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {order}) AS r FROM orders)
SELECT o_orderkey, o_orderstatus, CAST(fold AS INTEGER) AS fold FROM ranked JOIN places USING (o_orderstatus, r)"""


HASH_ORDER = "substr(md5('42:' || o_orderkey), 1, 13), o_orderkey"


@query(spread_sql(HASH_ORDER))
def stratified_kfold(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_kfold(df, "o_orderkey", "o_orderstatus", 5)


@query(spread_sql("o_orderkey"))
def ordered_stratified_folds(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splits.ordered_stratified_folds(df, "o_orderkey", "o_orderstatus", 5)


@query(spread_sql("o_orderkey", """orders AS (
  SELECT md5(CAST(o.o_orderkey AS VARCHAR)) AS o_orderkey, o.o_orderstatus FROM main.orders o),
"""))
def ordered_folds_text(spark, sf):
    """Ids that are text, with far more rows than are sorted in one task."""
    key = F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("o_orderkey")
    df = table(spark, sf, "orders").select(key, "o_orderstatus")
    return splits.ordered_stratified_folds(df, "o_orderkey", "o_orderstatus", 5, max_rows=200)


@query(f"""WITH t AS (SELECT count(*) AS n, count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) AS train FROM orders),
sizes AS (SELECT o_orderstatus, count(*) AS c, min(o_orderkey) AS f FROM orders GROUP BY 1),
shares AS (
  SELECT o_orderstatus, c, c * train // n AS whole,
         row_number() OVER (ORDER BY c * train % n DESC, f) AS place, train,
         sum(c * train // n) OVER () AS given FROM sizes, t),
cuts AS (SELECT o_orderstatus, c - whole - CASE WHEN place <= train - given THEN 1 ELSE 0 END AS test FROM shares),
ranked AS (
  SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_ORDER}) AS r
  FROM orders)
SELECT o_orderkey, o_orderstatus, r <= test AS is_test FROM ranked JOIN cuts USING (o_orderstatus)""")
def train_test_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splits.train_test_split(df, "o_orderkey", "o_orderstatus", 0.2)


# The same answers where the rows are more than one task may sort.


@query(ORACLES["kfold"])
def kfold_narrowed(spark, sf):
    return splits.kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5, max_rows=200)


@query(ORACLES["stratified_kfold"])
def stratified_kfold_narrowed(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_kfold(df, "o_orderkey", "o_orderstatus", 5, max_rows=200)


@query(ORACLES["train_test_split"])
def train_test_split_narrowed(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splits.train_test_split(df, "o_orderkey", "o_orderstatus", 0.2, max_rows=200)


@query(ORACLES["impute_median"])
def impute_median_narrowed(spark, sf):
    df = readings(spark, sf).select("event_id", "value")
    specs = numeric_features(["value"], imputer_strategy="median", **PLAIN)
    return rounded(prep.FeaturePipeline(specs, max_rows=200).fit_transform(df), "value")


@query(ORACLES["scale_robust"])
def scale_robust_narrowed(spark, sf):
    names = ["l_quantity", "l_extendedprice"]
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *names)
    specs = numeric_features(names, scaler_type="robust")
    return rounded(prep.FeaturePipeline(specs, max_rows=500).fit_transform(df), *names)


# ---------------------------------------------------------------- metrics


@query(f"""WITH {RETURNED_SQL}
SELECT round(avg(CASE WHEN returned = called THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy FROM returned_items""")
def accuracy(spark, sf):
    return rounded(metrics.accuracy(called_items(spark, sf), "returned", "called"), "accuracy")


@query(f"""WITH {RETURNED_SQL}
SELECT round(avg(CASE WHEN returned = called AND l_tax < 0.04 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy
FROM returned_items""")
def accuracy_missing(spark, sf):
    """A missing prediction is a miss."""
    df = called_items(spark, sf).withColumn("called", F.when(F.col("l_tax") < 0.04, F.col("called")))
    return rounded(metrics.accuracy(df, "returned", "called"), "accuracy")


def auc_sql(score: str) -> str:
    return f"""per_score AS (
  SELECT {score} AS s, count(*) FILTER (returned = 1) AS p, count(*) FILTER (returned = 0) AS q
  FROM returned_items GROUP BY 1),
lower_ranks AS (SELECT p, q, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM per_score),
auc AS (SELECT sum(CAST(p AS DOUBLE) * (b + q / 2.0)) / (CAST(sum(p) AS DOUBLE) * sum(q)) AS auc FROM lower_ranks)"""


@query(f"""WITH {RETURNED_SQL}, {auc_sql("l_extendedprice")} SELECT round(auc, 6) AS roc_auc FROM auc""")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(returned_items(spark, sf), "returned", "l_extendedprice"), "roc_auc")


@query(ORACLES["roc_auc"])
def roc_auc_buckets(spark, sf):
    scored = returned_items(spark, sf)
    return rounded(metrics.roc_auc(scored, "returned", "l_extendedprice", bucket_rows=500), "roc_auc")


@query(f"""WITH {RETURNED_SQL}, {auc_sql("l_discount")} SELECT round(auc, 6) AS roc_auc FROM auc""")
def roc_auc_ties(spark, sf):
    scored = returned_items(spark, sf)
    return rounded(metrics.roc_auc(scored, "returned", "l_discount", bucket_rows=1_000), "roc_auc")


COUNTS_SQL = f"""WITH {RETURNED_SQL},
n AS (SELECT CAST(count(*) FILTER (returned = 1 AND called = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (returned = 0 AND called = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (returned = 1 AND called = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (returned = called) AS DOUBLE) / count(*) AS hits FROM returned_items)"""


@query(f"""{COUNTS_SQL} SELECT round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score FROM n""")
def prf(spark, sf):
    found = metrics.precision_recall_f1(called_items(spark, sf), "returned", "called")
    return rounded(found, "precision", "recall", "f1_score")


@query(f"""{COUNTS_SQL}, {auc_sql("l_discount")}
SELECT 'accuracy' AS metric, round(hits, 6) AS value FROM n
UNION ALL SELECT 'roc_auc', round(auc, 6) FROM auc
UNION ALL SELECT 'f1_score', round(2 * tp / (2 * tp + fp + fn), 6) FROM n
UNION ALL SELECT 'precision', round(tp / (tp + fp), 6) FROM n
UNION ALL SELECT 'recall', round(tp / (tp + fn), 6) FROM n""")
def evaluate(spark, sf):
    return rounded(metrics.evaluate(called_items(spark, sf), "returned", "called", "l_discount"), "value")


@query("""WITH pairs AS (
  SELECT o_orderstatus AS y, CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O' ELSE 'P' END AS p
  FROM orders),
classes AS (SELECT DISTINCT y AS c FROM pairs UNION SELECT DISTINCT p FROM pairs),
n AS (
  SELECT c, CAST(count(*) FILTER (y = c AND p = c) AS DOUBLE) AS tp, count(*) FILTER (y <> c AND p = c) AS fp,
         count(*) FILTER (y = c AND p <> c) AS fn FROM classes, pairs GROUP BY c),
m AS (
  SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re, 2 * tp / (2 * tp + fp + fn) AS f1, tp FROM n)
SELECT 'accuracy' AS metric, round(sum(tp) / (SELECT count(*) FROM pairs), 6) AS value FROM m
UNION ALL SELECT 'f1_score', round(avg(f1), 6) FROM m
UNION ALL SELECT 'precision', round(avg(pr), 6) FROM m
UNION ALL SELECT 'recall', round(avg(re), 6) FROM m""")
def evaluate_classes(spark, sf):
    price = F.col("o_totalprice")
    called = F.when(price < 150000, "F").when(price < 300000, "O").otherwise("P")
    rows = table(spark, sf, "orders").select("o_orderstatus", called.alias("called"))
    return rounded(metrics.evaluate_classes(rows, "o_orderstatus", "called"), "value")


# ---------------------------------------------------------------- models


@query()
def gbt_fit_predict(spark, sf):
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_day"]
    spec = ClassifierSpec(model_name="returns", hyperparameters={"n_estimators": 5, "max_depth": 3}, random_state=7)
    rows = write_through(returned_items(spark, sf), "items")
    fitted = ClassifierPipeline(numeric_features(features), spec).fit(rows, "returned")
    return fitted.transform(rows).select("l_orderkey", "l_linenumber", "returned", "prediction")


STUMP_SQL = """WITH counted AS (
  SELECT 'd' AS f, l_discount AS v, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END) AS DOUBLE) AS s
  FROM lineitem GROUP BY l_discount
  UNION ALL
  SELECT 't', l_tax, count(*), CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END) AS DOUBLE) FROM lineitem GROUP BY l_tax),
sides AS (
  SELECT f, v, sum(n) OVER up AS nl, sum(s) OVER up AS sl, sum(n) OVER whole AS n, sum(s) OVER whole AS s FROM counted
  WINDOW up AS (PARTITION BY f ORDER BY v), whole AS (PARTITION BY f)),
best AS (SELECT * FROM sides WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1),
scored AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN CASE WHEN f = 'd' THEN l_discount ELSE l_tax END <= v THEN sl / nl ELSE (s - sl) / (n - nl) END AS m
  FROM lineitem, best)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN m > 0 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
       round(1 / (1 + exp(-2 * m)), 6) AS p1 FROM scored"""


@query(STUMP_SQL)
def gbt_stump(spark, sf):
    """One tree with one split is the best cut of one column, which SQL finds as well."""
    spec = ClassifierSpec(model_name="stump", hyperparameters={"n_estimators": 1, "max_depth": 1}, random_state=7)
    rows = returned_items(spark, sf)
    fitted = ClassifierPipeline(numeric_features(["l_discount", "l_tax"]), spec).fit(rows, "returned")
    p1 = F.round(F.col("probability")[1], 6).alias("p1")
    return fitted.transform(rows).select("l_orderkey", "l_linenumber", "prediction", p1)


def boosted_round_sql(classes: int, depth: int, rate: float, target: str, split_rows: int = 2) -> str:
    """One round of boosting over three features of line items that have few values."""
    sides = "CASE b.j WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END"
    gain = "nl * (nn - nl) / nn * power(sl / nl - (ss - sl) / (nn - nl), 2)"
    levels = "".join(f"""
long{d} AS (
  SELECT k, node, j, v, CAST(count(*) AS DOUBLE) AS n, sum(r) AS s
  FROM (SELECT k, node, r, unnest([0, 1, 2]) AS j, unnest([f0, f1, f2]) AS v FROM rows{d}) GROUP BY ALL),
cuts{d} AS (
  SELECT k, node, j, v, sum(n) OVER up AS nl, sum(s) OVER up AS sl, sum(n) OVER whole AS nn, sum(s) OVER whole AS ss
  FROM long{d} WINDOW up AS (PARTITION BY k, node, j ORDER BY v), whole AS (PARTITION BY k, node, j)),
best{d} AS (
  SELECT k, node, j, v FROM cuts{d} WHERE nl < nn AND nn >= {split_rows} AND {gain} > 1e-12
  QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY round({gain}, 7) DESC, j, v) = 1),
rows{d + 1} AS (
  SELECT r.* REPLACE (CASE WHEN b.k IS NULL THEN node WHEN {sides} <= b.v THEN 2 * node + 1 ELSE 2 * node + 2 END AS node)
  FROM rows{d} r LEFT JOIN best{d} b USING (k, node)),""" for d in range(depth))
    start = "ln(p)" if classes > 2 else "ln(p / (1 - p))"
    weight = "abs(r) * (1 - abs(r))" if classes > 2 else "p * (1 - p)"
    # For two classes the tree of class 1 is the only one.
    return f"""WITH base AS (
  SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, CAST(year(l_shipdate) AS DOUBLE) AS f0,
         l_linenumber::DOUBLE AS f1, l_discount AS f2, {target} AS y
  FROM lineitem),
priors AS (SELECT y AS k, count(*) / CAST((SELECT count(*) FROM base) AS DOUBLE) AS p FROM base GROUP BY y),
rows0 AS (
  SELECT base.*, k, p, {start} AS start, CASE WHEN y = k THEN 1 ELSE 0 END - p AS r, 0 AS node FROM base, priors
  {"" if classes > 2 else "WHERE k = 1"}),{levels}
leaves AS (
  SELECT k, node, {rate} * {(classes - 1) / classes if classes > 2 else 1.0} * sum(r) / sum({weight}) AS step
  FROM rows{depth} GROUP BY k, node),
scores AS (SELECT id, l_orderkey, l_linenumber, k, exp(start + step) AS e FROM rows{depth} JOIN leaves USING (k, node))
SELECT l_orderkey, l_linenumber, {
    ", ".join(f"round(sum(CASE WHEN k = {i} THEN e END) / sum(e), 6) AS p{i}" for i in range(classes))
    if classes > 2 else "round(sum(e) / (1 + sum(e)), 6) AS p1"
} FROM scores GROUP BY id, l_orderkey, l_linenumber"""


def few_valued_items(spark: SparkSession, sf: str, target: Column) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").cast("double").alias("f0"),
        F.col("l_linenumber").cast("double").alias("f1"), F.col("l_discount").alias("f2"), target.alias("y"),
    )


@query(boosted_round_sql(3, 1, 0.5, "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"))
def gbt_joint_stumps(spark, sf):
    """One round for three classes: a stump for each, on the residuals of all of them."""
    flag = F.col("l_returnflag")
    rows = few_valued_items(spark, sf, F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2))
    spec = ClassifierSpec(model_name="stumps", hyperparameters={"n_estimators": 1, "max_depth": 1, "learning_rate": 0.5}, random_state=7)
    scored = ClassifierPipeline(numeric_features(["f0", "f1", "f2"]), spec).fit(rows, "y").transform(rows)
    return scored.select("l_orderkey", "l_linenumber", *[F.round(F.col("probability")[i], 6).alias(f"p{i}") for i in range(3)])


@query(boosted_round_sql(3, 2, 0.5, "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"))
def gbt_joint_depth_two(spark, sf):
    """One round for three classes with trees of depth two."""
    flag = F.col("l_returnflag")
    rows = few_valued_items(spark, sf, F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2))
    spec = ClassifierSpec(model_name="trees", hyperparameters={"n_estimators": 1, "max_depth": 2, "learning_rate": 0.5}, random_state=7)
    scored = ClassifierPipeline(numeric_features(["f0", "f1", "f2"]), spec).fit(rows, "y").transform(rows)
    return scored.select("l_orderkey", "l_linenumber", *[F.round(F.col("probability")[i], 6).alias(f"p{i}") for i in range(3)])


#: Leaves several nodes uncut, at sf0.001 most of them.
SPLIT_ROWS = 3_000


@query(boosted_round_sql(2, 3, 0.1, "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", SPLIT_ROWS))
def gbt_min_samples_split(spark, sf):
    """Depth three, but a node needs 3 000 rows to be cut."""
    rows = few_valued_items(spark, sf, F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    settings = {"n_estimators": 1, "max_depth": 3, "min_samples_split": SPLIT_ROWS}
    spec = ClassifierSpec(model_name="trees", hyperparameters=settings, random_state=7)
    scored = ClassifierPipeline(numeric_features(["f0", "f1", "f2"]), spec).fit(rows, "y").transform(rows)
    return scored.select("l_orderkey", "l_linenumber", F.round(F.col("probability")[1], 6).alias("p1"))


@query()
def gbt_proba(spark, sf):
    """Fitted on the labelled documents, applied to all."""
    rows = measured_documents(spark, sf)
    scored = sample_pipeline().fit(rows.filter("target IS NOT NULL"), "target").transform(rows)
    return scored.select("sample_index", "target", *[F.col("probability")[i].alias(f"p{i}") for i in (0, 1)])


@query()
def gbt_multiclass(spark, sf):
    """Three classes in one model, fitted on the labelled documents, applied to all."""
    rows = measured_documents(spark, sf, 3)
    scored = sample_pipeline().fit(rows.filter("target IS NOT NULL"), "target").transform(rows)
    shares = [F.col("probability")[i].alias(f"p{i}") for i in range(3)]
    return scored.select("sample_index", "target", "prediction", *shares)


@query()
def feature_importance(spark, sf):
    return sample_pipeline().fit(stored_samples(spark, sf), "target").importance()


@query()
def pipeline_fit_predict(spark, sf):
    """Fitted on the labelled documents, applied to all."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    specs = [*numeric_features(["n_chars"]), *categorical_features(["lang", "source"])]
    model = ClassifierSpec(model_name="quality", hyperparameters={"n_estimators": 5}, random_state=7)
    scored = ClassifierPipeline(specs, model).fit(rows.filter("quality IS NOT NULL"), "quality").transform(rows)
    return scored.select("doc_id", "quality", "prediction", F.col("probability")[1].alias("p1"))


# ---------------------------------------------------------------- tuning


@query()
def grid_search(spark, sf):
    spec = GridSearchSpec(
        tuning_name="grid", param_grid={"classifier__n_estimators": [3, 6]}, n_splits=3, random_state=7,
        scoring=["accuracy", "roc_auc"],
    )
    return tuning.search(spec, sample_pipeline(), stored_samples(spark, sf), "target", "sample_index").cv_results()


@query()
def random_search(spark, sf):
    spec = RandomSearchSpec(
        tuning_name="random", n_iter=2, n_splits=2, random_state=7,
        param_distributions={"classifier__n_estimators": [2, 4, 6], "classifier__max_depth": [2, 3]},
    )
    return tuning.search(spec, sample_pipeline(), stored_samples(spark, sf), "target", "sample_index").cv_results()


@query(f"""WITH r AS (
  SELECT *, row_number() OVER (ORDER BY {HASH_ORDER}) - 1 AS r, count(*) OVER () AS n FROM orders),
folds AS (
  SELECT o_totalprice, o_orderstatus, CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
                                           ELSE (r - n % 5) // (n // 5) END AS fold FROM r),
scores AS (
  SELECT candidate, fold, avg(CASE WHEN (o_totalprice < candidate) = (o_orderstatus = 'F')
                              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS score
  FROM folds, (SELECT unnest([100000, 200000, 300000]) AS candidate) GROUP BY ALL),
means AS (
  SELECT candidate, count(*) AS n_folds, avg(score) AS mean_score, stddev_pop(score) AS std_score
  FROM scores GROUP BY candidate)
SELECT candidate, n_folds, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score,
       CAST(rank() OVER (ORDER BY mean_score DESC) AS INTEGER) AS rank FROM means""")
def cv_results(spark, sf):
    """The results table of three price rules, scored on the folds of the orders."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    folded = splits.kfold(rows, "o_orderkey", 5)
    limits = [100_000, 200_000, 300_000]
    right = [
        F.avg(((F.col("o_totalprice") < x) == (F.col("o_orderstatus") == "F")).cast("double")).alias(str(x))
        for x in limits
    ]
    wide = folded.groupBy("fold").agg(*right)
    pairs = F.array(*[F.struct(F.lit(x).alias("candidate"), F.col(str(x)).alias("score")) for x in limits])
    return rounded(tuning.cv_results(wide.select(F.inline(pairs))), "mean_score", "std_score")


# One-split trees are the best cut of one column, so SQL can follow searches and validation fold by fold.

FINISHED = "orders AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_orderstatus FROM main.orders),\n"


def stump_scores_sql(folded: str, sides: Sequence[int], leaves: Sequence[int] = (1,)) -> str:
    """``scores``: for each held-out part and least leaf size, the accuracy of a stump on both sides."""
    mean = "CASE WHEN CASE WHEN j = 0 THEN f0 ELSE f1 END <= v THEN sl / nl ELSE (s - sl) / (n - nl) END"
    return f"""WITH folded AS ({folded}),
parts AS (
  SELECT f.fold AS part, 2 * f.o_orderstatus - 1 AS y, year(o.o_orderdate)::DOUBLE AS f0,
         CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS f1
  FROM folded f JOIN main.orders o USING (o_orderkey)),
sides AS (SELECT unnest({list(sides)}) AS side),
candidates AS (SELECT unnest({list(range(len(leaves)))}) AS candidate, unnest({list(leaves)}) AS leaf),
long AS (
  SELECT side, j, v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s
  FROM (SELECT side, y, unnest([0, 1]) AS j, unnest([f0, f1]) AS v FROM parts, sides WHERE part <> side) GROUP BY ALL),
cuts AS (
  SELECT side, j, v, sum(n) OVER up AS nl, sum(s) OVER up AS sl, sum(n) OVER whole AS n, sum(s) OVER whole AS s
  FROM long WINDOW up AS (PARTITION BY side, j ORDER BY v), whole AS (PARTITION BY side, j)),
best AS (
  SELECT * FROM cuts, candidates WHERE nl >= leaf AND n - nl >= leaf
  QUALIFY row_number() OVER (
    PARTITION BY side, candidate ORDER BY round(sl * sl / nl + (s - sl) * (s - sl) / (n - nl), 6) DESC, j, v) = 1),
scores AS (
  SELECT candidate, side AS fold, part = side AS test,
         avg(CASE WHEN ({mean} > 0) = (y > 0) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS score
  FROM parts, best GROUP BY ALL)
"""


def finished_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("double").alias("f0"), F.substring("o_orderpriority", 1, 1).cast("double").alias("f1"),
        (F.col("o_orderstatus") == "F").cast("int").alias("finished"),
    )


def stump_pipeline() -> ClassifierPipeline:
    spec = ClassifierSpec(model_name="stump", hyperparameters={"n_estimators": 1, "max_depth": 1}, random_state=7)
    return ClassifierPipeline(numeric_features(["f0", "f1"]), spec)


@query(stump_scores_sql(spread_sql(HASH_ORDER, FINISHED), range(5), (1, 400)) + """,
means AS (
  SELECT candidate, count(*) FILTER (WHERE test) AS n_folds, avg(score) FILTER (WHERE test) AS mean_score,
         stddev_pop(score) FILTER (WHERE test) AS std_score, avg(score) FILTER (WHERE NOT test) AS mean_train_score
  FROM scores GROUP BY candidate)
SELECT CAST(candidate AS INTEGER) AS candidate,
       CASE candidate WHEN 0 THEN '{"classifier__min_samples_leaf": 1}' ELSE '{"classifier__min_samples_leaf": 400}' END AS params,
       n_folds, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score,
       CAST(rank() OVER (ORDER BY round(mean_score, 9) DESC) AS INTEGER) AS rank, round(mean_train_score, 6) AS mean_train_score
FROM means""")
def grid_search_stumps(spark, sf):
    """Two candidates on five shuffled folds, with the scores of both sides."""
    spec = GridSearchSpec(tuning_name="stumps", param_grid={"classifier__min_samples_leaf": [1, 400]}, n_splits=5)
    found = tuning.search(spec, stump_pipeline(), finished_orders(spark, sf), "finished", "o_orderkey").cv_results()
    return rounded(found, "mean_score", "std_score", "mean_train_score")


@query(stump_scores_sql(spread_sql("o_orderkey", FINISHED), range(5)) + """
SELECT CAST(fold AS INTEGER) AS fold, round(score, 6) AS score FROM scores WHERE test""")
def cross_validate_stumps(spark, sf):
    """The accuracy of a stump on each unshuffled fold."""
    scores = flow.cross_validate(stump_pipeline(), finished_orders(spark, sf), "o_orderkey", "finished", 5)
    return rounded(scores, "score")


@query(stump_scores_sql(
    "SELECT o_orderkey, o_orderstatus, CASE WHEN is_test THEN 1 ELSE 0 END AS fold FROM ("
    + ORACLES["train_test_split"].replace("WITH t AS", f"WITH {FINISHED}t AS") + ")", [1]) + """
SELECT 'test_score' AS metric, round(score, 6) AS value FROM scores WHERE test
UNION ALL SELECT 'train_size', CAST(count(*) FILTER (WHERE part = 0) AS DOUBLE) FROM parts
UNION ALL SELECT 'test_size', CAST(count(*) FILTER (WHERE part = 1) AS DOUBLE) FROM parts""")
def holdout_validate_stumps(spark, sf):
    """The accuracy of a stump on a stratified fifth of the orders, and the sizes of both sides."""
    _, found = flow.holdout_validate(stump_pipeline(), finished_orders(spark, sf), "o_orderkey", "finished", 0.2)
    numbers = [(k, round(float(v), 6)) for k, v in found.items() if k != "validation_strategy"]
    return spark.createDataFrame(numbers, "metric string, value double")


@query(STUMP_SQL[: STUMP_SQL.index(",\nscored AS")] + """
SELECT feature, CASE WHEN x.f = best.f THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
FROM (VALUES ('d', 'l_discount'), ('t', 'l_tax')) x(f, feature), best""")
def stump_importance(spark, sf):
    """All importance is that of the one column that is cut."""
    spec = ClassifierSpec(model_name="stump", hyperparameters={"n_estimators": 1, "max_depth": 1}, random_state=7)
    return ClassifierPipeline(numeric_features(["l_discount", "l_tax"]), spec).fit(returned_items(spark, sf), "returned").importance()


# ---------------------------------------------------------------- calibration


def calibrated(spark: SparkSession, sf: str, classes: int = 2, **settings) -> DataFrame:
    """Fitted on the labelled documents, applied to all."""
    rows = measured_documents(spark, sf, classes)
    spec = CalibrationSpec(calibration_name="curve", random_state=7, **settings)
    fitted = CalibratedPipeline(sample_pipeline(), spec, "sample_index").fit(rows.filter("target IS NOT NULL"), "target")
    shares = [F.col("probability")[i].alias(f"p{i}") for i in range(classes)]
    return fitted.transform(rows).select("sample_index", "target", "prediction", *shares)


DISCOUNTS_SQL = f"""{RETURNED_SQL},
points AS (
  SELECT l_discount AS s, CAST(sum(returned) AS DOUBLE) AS p, CAST(count(*) - sum(returned) AS DOUBLE) AS q
  FROM returned_items GROUP BY 1)"""


@query(f"""WITH {DISCOUNTS_SQL},
stretches AS (
  SELECT a.s AS low, b.s AS high, sum(c.p) / sum(c.p + c.q) AS m
  FROM points a JOIN points b ON a.s <= b.s JOIN points c ON c.s BETWEEN a.s AND b.s GROUP BY 1, 2),
least AS (SELECT x.s, t.low, min(t.m) AS m FROM points x JOIN stretches t ON x.s BETWEEN t.low AND t.high GROUP BY 1, 2)
SELECT s AS l_discount, round(max(m), 6) AS calibrated FROM least GROUP BY 1""")
def isotonic_curve(spark, sf):
    """The rising step curve is the largest of the least means of stretches around each score."""
    rows = returned_items(spark, sf)
    curve = calibrate.isotonic_curve(rows, "l_discount", F.col("returned") == 1)
    found = curve(rows.select("l_discount").distinct(), "l_discount", "calibrated")
    return rounded(found, "calibrated")


@query(f"""WITH RECURSIVE {DISCOUNTS_SQL},
totals AS (SELECT sum(p) AS np, sum(q) AS nq FROM points),
weighted AS (
  SELECT s, p * (np + 1) / (np + 2) + q / (nq + 2) AS yes, p / (np + 2) + q * (nq + 1) / (nq + 2) AS no FROM points, totals),
steps AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b
  UNION ALL
  SELECT k + 1, a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b + (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (
    SELECT k, a, b, sum((yes - (yes + no) * m) * s) AS ga, sum(yes - (yes + no) * m) AS gb,
           sum((yes + no) * m * (1 - m) * s * s) AS haa, sum((yes + no) * m * (1 - m) * s) AS hab,
           sum((yes + no) * m * (1 - m)) AS hbb
    FROM (SELECT *, 1 / (1 + exp(-(a * s + b))) AS m FROM steps, weighted WHERE k < 20) GROUP BY k, a, b))
SELECT s AS l_discount, round(1 / (1 + exp(-(a * s + b))), 4) AS calibrated FROM points, steps WHERE k = 20""")
def sigmoid_curve(spark, sf):
    """Platt's curve is the logistic regression on smoothed targets; Newton steps find it in SQL."""
    rows = returned_items(spark, sf)
    curve = calibrate.sigmoid_curve(rows, "l_discount", F.col("returned") == 1)
    found = curve(rows.select("l_discount").distinct(), "l_discount", "calibrated")
    return found.withColumn("calibrated", F.round("calibrated", 4))


@query()
def calibrate_sigmoid(spark, sf):
    return calibrated(spark, sf)


@query()
def calibrate_isotonic(spark, sf):
    return calibrated(spark, sf, method="isotonic")


@query()
def calibrate_kfold(spark, sf):
    return calibrated(spark, sf, cv_strategy=3)


@query()
def calibrate_oof(spark, sf):
    return calibrated(spark, sf, method="isotonic", cv_strategy="stratified_kfold", n_splits=2, ensemble=False)


# ---------------------------------------------------------------- workflow


@query("""
SELECT o_orderkey AS sample_index, CASE WHEN fresh THEN o_totalprice END AS "orders__feature_0",
       CASE WHEN fresh THEN o_custkey END AS "orders__feature_1", CASE WHEN fresh THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS target
FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-08-01' - INTERVAL 365 DAY AND o_orderdate <= TIMESTAMP '1998-08-01' AS fresh FROM orders)""")
def workflow_rows(spark, sf):
    """The workflow's rows from a feature store: older than a year, features have expired."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_index"), F.col("o_totalprice").alias("feature_0"), F.col("o_custkey").alias("feature_1"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"), F.col("o_orderdate").alias("ingested_at"),
    )
    spec = FeatureStoreSpec(enabled=True, feature_view_name="orders", use_full_feature_names=True, timestamp=datetime(1998, 8, 1))
    return flow.feature_store_rows(rows, spec, "sample_index", "target")


@query()
def cross_validate(spark, sf):
    return flow.cross_validate(sample_pipeline(), stored_samples(spark, sf), "sample_index", "target", 3)


@query()
def holdout_validate(spark, sf):
    rows = stored_samples(spark, sf)
    _, found = flow.holdout_validate(sample_pipeline(), rows, "sample_index", "target", 0.25)
    numbers = [(k, float(v)) for k, v in found.items() if k != "validation_strategy"]
    return spark.createDataFrame(numbers, "metric string, value double")


@query()
def workflow(spark, sf):
    """Rows from the feature store, a search, calibration by folds, and cross-validation."""
    features = stored_samples(spark, sf).withColumn("ingested_at", ntz("2024-01-01 00:00:00"))
    pipeline = sample_pipeline()
    result = flow.run_workflow(
        features,
        "sample_index",
        "target",
        pipeline.prep.specs,
        pipeline.model_spec,
        cv_folds=2,
        tuning_spec=GridSearchSpec(
            tuning_name="grid", param_grid={"classifier__n_estimators": [3, 5]}, n_splits=2, random_state=7
        ),
        calibration_spec=CalibrationSpec(calibration_name="platt", cv_strategy=2),
        feature_store_spec=FeatureStoreSpec(enabled=True),
        feature_table=features,
    )
    return result.metric_rows(spark)
