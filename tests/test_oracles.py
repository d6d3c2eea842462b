"""Every query that SQL can express equals its SQL, values and types."""

import pytest
from compare import duck_rows, duck_types, spark_rows
from pyspark.sql import functions as F

from tidemark.plans.queries import ORACLES, QUERIES, document_samples, sample_measures

# The Spark type that each SQL type is read as.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    found, wanted = spark_rows(df), duck_rows(sf, ORACLES[name])
    assert found[0] == wanted[0]
    assert len(found[1]) == len(wanted[1]) > 0
    assert found[1] == wanted[1]
    types = {c: TYPES.get(t, t) for c, t in duck_types(sf, ORACLES[name]).items()}
    assert dict(df.dtypes) == types


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("count", [1, 4, 16])
@pytest.mark.parametrize("name", ["pit_join_ttl", "pit_join_hot_key", "stratified_kfold", "roc_auc_ties", "materialize"])
def test_number_of_partitions_does_not_matter(spark, sf, partitions, name, count):
    partitions(count)
    assert spark_rows(QUERIES[name](spark, sf)) == duck_rows(sf, ORACLES[name])


def test_samples_join_without_their_texts(spark, sf):
    """A join by shuffle would move every text of the labelled documents."""

    def inputs(plan):
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        own = [c.output().mkString(",") for c in below] if plan.nodeName() == "Join" else []
        return own + [x for c in below for x in inputs(c)]

    found = inputs(document_samples(spark, sf)._jdf.queryExecution().optimizedPlan())
    assert len(found) == 2 and not any("text#" in x for x in found)


def test_sample_measures_of_odd_texts(spark):
    texts = ["", "A", "a!b||", "ABC 12\n\n%$#*&é😀Z ", "x" * 50 + "9", "!!", "٣ÄÖ"]
    signs = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!", "|", "%$#*&"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in rows.select("text", *sample_measures(F.col("text"))).collect():
        t = row["text"]
        shares = [sum(c in s for c in t) / max(len(t), 1) for s in signs]
        assert list(row)[1:] == [len(t), t.count("\n") + 1, *shares, t.count(" ") + 1]
