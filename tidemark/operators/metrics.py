"""Accuracy, AUC, F1, precision and recall over scored rows (M6 to M9)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import with_bucket
from tidemark.functions.sketch import spread_quantiles
from tidemark.specs import METRICS

BUCKET_ROWS = 1_000_000


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of the labelled rows that are predicted right; a missing prediction is a miss."""
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("double")
    return df.agg(F.avg(F.when(F.col(label).isNotNull(), hit)).alias("accuracy"))


def roc_auc(df: DataFrame, label: str, score: str, positive: Any = 1, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Area under the ROC curve of a binary label; tied scores count half, a missing score is an error."""
    edges = _score_edges(df, score, bucket_rows, None)
    return _ranked_totals(df, score, _counts(label, None, positive), edges).select(_auc().alias("roc_auc"))


def precision_recall_f1(df: DataFrame, label: str, prediction: str, positive: Any = 1) -> DataFrame:
    totals = df.agg(*_counts(label, prediction, positive))
    return totals.select(*[_from_counts(m).alias(m) for m in ("precision", "recall", "f1_score")])


def evaluate(
    df: DataFrame,
    label: str,
    prediction: str,
    score: str | None = None,
    metrics: Sequence[str] = METRICS,
    positive: Any = 1,
    bucket_rows: int = BUCKET_ROWS,
    by: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Rows (metric, value) for a binary label, all from one pass over the scored rows.

    ``by`` gives the metrics of each group. ``rows``, the number of rows if it is known, saves
    the count that decides whether the scores need to be cut into buckets.
    """
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}")
    counts = _counts(label, prediction, positive)
    ranked = "roc_auc" in metrics and score is not None
    if ranked:
        totals = _ranked_totals(df, score, counts, _score_edges(df, score, bucket_rows, rows), by)
    else:
        totals = df.groupBy(*by).agg(*counts)
    wanted = [m for m in metrics if m != "roc_auc" or ranked]
    found = [_row(m, _auc() if m == "roc_auc" else _from_counts(m)) for m in wanted]
    return totals.select(*by, F.inline(F.array(*found)))


def evaluate_classes(
    df: DataFrame, label: str, prediction: str, metrics: Sequence[str] = METRICS, by: Sequence[str] = ()
) -> DataFrame:
    """The same for more than two classes: F1, precision and recall are averaged over classes.

    Rows are first counted per (label, prediction); AUC is defined for two classes only and
    left out.
    """
    pairs = df.groupBy(*by, F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("y") == F.col("p")
    zero = F.lit(0).cast("long")
    as_true = F.struct(
        F.col("y").alias("c"), F.when(hit, F.col("n")).otherwise(0).alias("tp"), zero.alias("fp"),
        F.when(hit, 0).otherwise(F.col("n")).alias("fn"), F.col("n").alias("n"),
    )
    as_predicted = F.struct(
        F.col("p").alias("c"), zero.alias("tp"), F.when(hit, 0).otherwise(F.col("n")).alias("fp"),
        zero.alias("fn"), zero.alias("n"),
    )
    classes = pairs.select(*by, F.inline(F.array(as_true, as_predicted))).groupBy(*by, "c")
    classes = classes.agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn", "n")])
    averages = classes.groupBy(*by).agg(
        (F.sum("tp") / F.sum("n")).alias("accuracy"),
        *[F.avg(_from_counts(m)).alias(m) for m in ("precision", "recall", "f1_score")],
    )
    wanted = [m for m in metrics if m != "roc_auc"]
    return averages.select(*by, F.inline(F.array(*[_row(m, F.col(m)) for m in wanted])))


def _row(metric: str, value: Column) -> Column:
    return F.struct(F.lit(metric).alias("metric"), value.alias("value"))


def _counts(label: str, prediction: str | None, positive: Any) -> list[Column]:
    truth = F.col(label) == F.lit(positive)
    counts = [F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg")]
    if prediction is not None:
        called = F.col(prediction) == F.lit(positive)
        counts += [
            F.count_if(F.col(label) == F.col(prediction)).alias("hits"),
            F.count_if(truth & called).alias("tp"),
            F.count_if(~truth & called).alias("fp"),
            F.count_if(truth & ~F.coalesce(called, F.lit(False))).alias("fn"),
        ]
    return counts


def _ratio(above: Column, below: Column) -> Column:
    return F.when(below > 0, above / below).otherwise(0.0)


def _from_counts(metric: str) -> Column:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    if metric == "accuracy":
        return F.col("hits") / (F.col("pos") + F.col("neg"))
    if metric == "precision":
        return _ratio(tp, tp + fp)
    if metric == "recall":
        return _ratio(tp, tp + fn)
    return _ratio(2 * tp, 2 * tp + fp + fn)


def _auc() -> Column:
    pairs = F.col("pos").cast("double") * F.col("neg")
    return F.when(pairs > 0, F.col("wins") / pairs)


def _ranked_totals(
    df: DataFrame, score: str, counts: list[Column], edges: list[float], by: Sequence[str] = ()
) -> DataFrame:
    """Totals of the counts, and ``wins``: pairs in which the positive row scores higher.

    Rows are counted per score first, so rows with one score are combined before the shuffle.
    Scores are then ranked within buckets of about equal size, and the buckets among each
    other, so no task sorts all scores.
    """
    names = ("pos", "neg", "hits", "tp", "fp", "fn")[: len(counts)]
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    checked = F.when(known, F.col(score)).otherwise(F.raise_error(F.lit(f"rows without a value of {score!r} cannot be ranked")))
    placed = with_bucket(df.withColumn(score, checked), F.col(score).cast("double"), edges, "_bucket")
    by_score = placed.groupBy(*by, "_bucket", F.col(score).alias("_score")).agg(*counts)
    below = Window.partitionBy(*by, "_bucket").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    neg, pos = F.col("neg").cast("double"), F.col("pos").cast("double")
    lower = F.coalesce(F.sum(neg).over(below), F.lit(0.0))
    by_bucket = (
        by_score.withColumn("_wins", pos * (lower + neg / 2))
        .groupBy(*by, "_bucket")
        .agg(*[F.sum(n).alias(n) for n in names], F.sum("_wins").alias("_wins"))
    )
    # A row for each bucket of BUCKET_ROWS rows is left for this window.
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("_wins") + pos * F.coalesce(F.sum(neg).over(before), F.lit(0.0))
    totals = by_bucket.withColumn("wins", wins).groupBy(*by)
    return totals.agg(*[F.sum(n).alias(n) for n in names], F.sum("wins").alias("wins"))


def _score_edges(df: DataFrame, score: str, bucket_rows: int, rows: int | None) -> list[float]:
    pieces = -(-(df.count() if rows is None else rows) // bucket_rows)
    if pieces < 2:
        return []
    values = df.select(F.col(score).cast("double").alias("s"))
    points = spread_quantiles(values, "s", [i / pieces for i in range(1, pieces)]).first()["p"]
    return sorted(set(points))
