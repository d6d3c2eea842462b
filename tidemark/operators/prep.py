"""Imputation, scaling and encoding.

Fitting aggregates all columns together and keeps a few numbers per column; transforming is
one projection with those numbers as literals, so it fuses with whatever reads the rows.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import missing_as_null
from tidemark.functions.ranks import MAX_ROWS, exact_quantiles
from tidemark.session import write_through
from tidemark.specs import CategoricalFeatureSpec, FeatureSpec, NumericFeatureSpec

#: Up to so many categories make a column each; more make one column with the position of the 1.
MAX_CATEGORIES = 1_000
QUARTERS = (0.25, 0.5, 0.75)


@dataclass
class FittedFeature:
    """What fitting learned about one column."""

    spec: FeatureSpec
    fill: Any = None
    centre: float = 0.0
    scale: float = 1.0
    categories: list[str] = field(default_factory=list)
    #: For encoders with more than MAX_CATEGORIES categories: rows (value, position).
    positions: DataFrame | None = None
    #: How many places ``positions`` has: categories but the first.
    width: int = 0

    def imputed(self, df: DataFrame) -> Column:
        value = missing_as_null(df, self.spec.feature_name)
        return value if self.fill is None else F.coalesce(value, F.lit(self.fill))

    def columns(self, df: DataFrame) -> list[Column]:
        """The column's output: one column, or one per category but the first."""
        name, spec = self.spec.feature_name, self.spec
        value = self.imputed(df)
        if isinstance(spec, NumericFeatureSpec):
            if spec.scaler_enabled and spec.scaler_type != "none":
                value = (value - F.lit(self.centre)) / F.lit(self.scale)
            return [value.alias(name)]
        if self.positions is not None:
            return [F.col(f"`{name}_position`")]
        if spec.encoder_enabled and spec.encoder_type != "none":
            return [
                F.when(value == F.lit(c), 1.0).otherwise(0.0).alias(f"{name}_{c}") for c in self.categories[1:]
            ]
        return [value.alias(name)]

    def output_names(self) -> list[str]:
        name, spec = self.spec.feature_name, self.spec
        if self.positions is not None:
            return [f"{name}_position"]
        if isinstance(spec, CategoricalFeatureSpec) and spec.encoder_enabled and spec.encoder_type != "none":
            return [f"{name}_{c}" for c in self.categories[1:]]
        return [name]


@dataclass
class FittedFeatures:
    """A fitted pipeline: transformed columns first, all other columns after them."""

    features: list[FittedFeature]

    def transform(self, df: DataFrame) -> DataFrame:
        missing = [f.spec.feature_name for f in self.features if f.spec.feature_name not in df.columns]
        if missing:
            raise ValueError(f"columns not in the frame: {missing}")
        done = {f.spec.feature_name for f in self.features}
        kept = [F.col(f"`{c}`") for c in df.columns if c not in done]
        df = self.placed(df)
        return df.select(*[c for f in self.features for c in f.columns(df)], *kept)

    def wide(self) -> list[FittedFeature]:
        """The features whose encoding is kept as a position."""
        return [f for f in self.features if f.positions is not None]

    def placed(self, df: DataFrame) -> DataFrame:
        """The frame with the position columns of wide encoders."""
        for f in self.wide():
            name = f.spec.feature_name
            places = f.positions.select(F.col("value").alias(f"_{name}_value"), F.col("position").alias(f"{name}_position"))
            df = df.join(places, f.imputed(df).cast("string") == F.col(f"`_{name}_value`"), "left").drop(f"_{name}_value")
        return df

    def output_names(self) -> list[str]:
        return [n for f in self.features for n in f.output_names()]

    def vectors(self, df: DataFrame, output: str = "features") -> DataFrame:
        """All columns of the frame, and the transformed features as one sparse vector.

        A slot for each number and each category but the first, in the order of ``slots``, however
        many categories a column has; a category that fitting did not see is all zeros. Missing
        numbers become NaN. Each row's places and values become a vector by way of its JSON: Spark's
        encoder and assembler would have the driver name every slot.
        """
        if output in df.columns:
            raise ValueError(f"the frame has a column {output!r} already")
        made, cells, size = self.placed(df), [], 0
        for f in self.features:
            own = f.columns(made)
            if f.positions is None:
                values = [F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in own]
                cells += [_cell(F.lit(size + i), v) for i, v in enumerate(values)]
                size += len(own)
            else:
                cells.append(_cell(F.lit(size) + own[0], F.lit(1.0)))  # no place: missing, unknown or the first category
                size += f.width
        made = made.withColumn("_cells", F.filter(F.array(*cells), lambda c: c["slot"].isNotNull() & (c["value"] != 0)))
        found = F.col("_cells")
        parts = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), found["slot"].alias("indices"), found["value"].alias("values"))
        text = F.to_json(F.struct(parts.alias("v")))
        if size <= 1.5 * (len(cells) + 1):  # a row can have so few zeros that all values in a row are shorter
            places = F.sequence(F.lit(0), F.lit(size - 1)) if size else F.array().cast("array<int>")
            values = F.transform(places, lambda i: F.coalesce(F.get(F.filter(found, lambda c: c["slot"] == i), F.lit(0))["value"], F.lit(0.0)))
            dense = F.to_json(F.struct(F.struct(F.lit(1).alias("type"), values.alias("values")).alias("v")))
            text = F.when(1.5 * (F.size(found) + 1) < size, text).otherwise(dense)
        vector = F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]
        return made.select(*[F.col(f"`{c}`") for c in df.columns], vector.alias(output))

    def slots(self) -> DataFrame:
        """Rows (slot, name): what each place of ``vectors`` stands for."""
        spark, found, at = SparkSession.active(), [], 0
        for f in self.features:
            if f.positions is None:
                names = f.output_names()
                found.append(spark.createDataFrame([(at + i, n) for i, n in enumerate(names)], "slot long, name string"))
                at += len(names)
            else:
                name = F.concat(F.lit(f"{f.spec.feature_name}_"), F.col("value").cast("string"))
                found.append(f.positions.filter("position IS NOT NULL").select((F.lit(at) + F.col("position")).cast("long").alias("slot"), name.alias("name")))
                at += f.width
        return reduce(DataFrame.unionByName, found)


def _cell(slot: Column, value: Column) -> Column:
    return F.struct(slot.cast("int").alias("slot"), value.alias("value"))


class FeaturePipeline:
    """Preprocessing by a list of feature specs, bound to columns by name."""

    def __init__(self, specs: Sequence[FeatureSpec], max_rows: int = MAX_ROWS) -> None:
        if not specs:
            raise ValueError("at least one feature spec is required")
        names = [s.feature_name for s in specs]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"features named more than once: {twice}")
        self.specs = list(specs)
        self.max_rows = max_rows
        self._fitted: FittedFeatures | None = None

    def fit(self, df: DataFrame) -> FittedFeatures:
        """Learn fill values, scales and categories from a frame."""
        self._fitted = self._fit(df, None, 1)[0]
        return self._fitted

    def fit_folds(self, df: DataFrame, fold: str, folds: int) -> list[FittedFeatures]:
        """For each fold, what ``fit`` learns from the rows of all others, in one pass over the frame.

        Rows are counted and summed by fold, and a training side is the sum of the other folds.
        """
        return self._fit(df, fold, folds)

    def _fit(self, df: DataFrame, fold: str | None, sides: int) -> list[FittedFeatures]:
        active = [s for s in self.specs if s.enabled]
        for s in [s for s in active if s.feature_name not in df.columns]:
            warnings.warn(f"feature {s.feature_name!r} is not a column; skipped", stacklevel=3)
        found = [[FittedFeature(s) for s in active if s.feature_name in df.columns] for _ in range(sides)]
        if not found[0]:
            raise ValueError("none of the feature specs names a column of the frame")
        numeric, categorical = (
            [[f for f in side if isinstance(f.spec, kind)] for side in found]
            for kind in (NumericFeatureSpec, CategoricalFeatureSpec)
        )
        _fit_numeric(df, numeric, fold, self.max_rows)
        _fit_categorical(df, categorical, fold)
        return [FittedFeatures(side) for side in found]

    def transform(self, df: DataFrame) -> DataFrame:
        if self._fitted is None:
            raise ValueError("the pipeline must be fitted before it transforms")
        return self._fitted.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def _moments(rows: Sequence, columns: int) -> tuple[int, list[tuple[int, float | None, float | None]]]:
    """Rows, and (values, mean, variance) of each column, of several parts together."""
    if len(rows) == 1:
        return rows[0][0], [tuple(rows[0][1 + 3 * i : 4 + 3 * i]) for i in range(columns)]
    found = []
    for i in range(columns):
        parts = [r[1 + 3 * i : 4 + 3 * i] for r in rows if r[1 + 3 * i]]
        n = sum(p[0] for p in parts)
        mean = sum(p[0] * p[1] for p in parts) / n if n else None
        found.append((n, mean, sum(p[0] * (p[2] + (p[1] - mean) ** 2) for p in parts) / n if n else None))
    return sum(r[0] for r in rows), found


def _fit_numeric(df: DataFrame, sides: list[list[FittedFeature]], fold: str | None, max_rows: int) -> None:
    """One pass for counts, means and variances; quantiles only where a spec asks for them.

    Mean and variance after imputation follow from those before it and the number of filled
    rows, so scaling needs no pass of its own. With a ``fold``, side k is all rows of other folds.
    """
    if not sides[0]:
        return
    names = [f.spec.feature_name for f in sides[0]]
    values = {n: missing_as_null(df, n) for n in names}
    wanted = [F.count(F.lit(1))]
    for n in names:
        wanted += [F.count(values[n]), F.avg(values[n]), F.var_pop(values[n])]
    by = [] if fold is None else [fold]
    rows = [tuple(r) for r in df.groupBy(*by).agg(*wanted).collect()]  # a row for each fold
    parts = [[r[len(by) :] for r in rows if fold is None or r[0] != k] for k in range(len(sides))]

    def inside(k: int, value: Column) -> Column:
        return value if fold is None else F.when(F.col(fold) != k, value)

    total, known, mean, variance = [], [], [], []
    for own in parts:
        size, found = _moments(own or [(0, *[0, None, None] * len(names))], len(names))
        total.append(size)
        for of, at in ((known, 0), (mean, 1), (variance, 2)):
            of.append({n: f[at] for n, f in zip(names, found)})

    for k, features in enumerate(sides):
        imputed = [f for f in features if f.spec.imputer_enabled]
        empty = [f.spec.feature_name for f in imputed if not known[k][f.spec.feature_name] and f.spec.imputer_strategy != "constant"]
        if empty:
            raise ValueError(f"columns without any value cannot be imputed from the data: {empty}")
    by_median = [f.spec.feature_name for f in sides[0] if f.spec.imputer_enabled and f.spec.imputer_strategy == "median"]
    pairs = [(k, n) for k in range(len(sides)) for n in by_median]
    medians = _quantiles(df, {(k, n): inside(k, values[n]) for k, n in pairs}, [0.5], {(k, n): known[k][n] for k, n in pairs}, max_rows)
    for k, features in enumerate(sides):
        for f in features:
            n = f.spec.feature_name
            if f.spec.imputer_enabled:
                f.fill = {"mean": mean[k][n], "constant": f.spec.imputer_fill_value}.get(f.spec.imputer_strategy)
                if f.spec.imputer_strategy == "median":
                    f.fill = medians[k, n][0]
                f.fill = float(f.fill)
            filled = total[k] - known[k][n] if f.fill is not None else 0
            if not f.spec.scaler_enabled or f.spec.scaler_type != "standard" or known[k][n] + filled == 0:
                continue
            old_mean, spread = mean[k][n] or 0.0, (variance[k][n] or 0.0) * known[k][n]
            share = filled / (known[k][n] + filled)
            gap = (f.fill - old_mean) if filled else 0.0
            f.centre = old_mean + gap * share
            f.scale = math.sqrt((spread + gap * gap * known[k][n] * share) / (known[k][n] + filled)) or 1.0

    robust = {(k, f.spec.feature_name): f for k, side in enumerate(sides) for f in side if f.spec.scaler_enabled and f.spec.scaler_type == "robust"}
    sizes = {(k, n): total[k] if f.fill is not None else known[k][n] for (k, n), f in robust.items()}
    present = {(k, n): inside(k, f.imputed(df)) for (k, n), f in robust.items() if sizes[k, n]}
    for at, (low, centre, high) in _quantiles(df, present, QUARTERS, sizes, max_rows).items():
        robust[at].centre, robust[at].scale = centre, (high - low) or 1.0


def _quantiles(df: DataFrame, columns: dict, probabilities: Sequence[float], sizes: dict, max_rows: int) -> dict:
    """``exact_quantiles`` of all sides' columns together, by (side, name)."""
    if not columns:
        return {}
    found = exact_quantiles(df, {str(i): c for i, c in enumerate(columns.values())}, probabilities, {str(i): sizes[at] for i, at in enumerate(columns)}, max_rows)
    return {at: found[str(i)] for i, at in enumerate(columns)}


def value_counts(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (name, value, n) for several text columns, in one aggregation."""
    pairs = [F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("string").alias("value")) for n in names]
    long = df.select(*by, F.explode(F.array(*pairs)).alias("p")).select(*by, "p.name", "p.value")
    return long.groupBy(*by, "name", "value").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The commonest value of each name; the smallest one among equals."""
    ranked = F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("top")
    return counts.filter("value IS NOT NULL").groupBy(*by, "name").agg(ranked).select(*by, "name", "top.value")


def _fit_categorical(df: DataFrame, sides: list[list[FittedFeature]], fold: str | None) -> None:
    """Fill values and categories from one count per value.

    The counts of narrow columns are few and all come back; columns with more values than
    one-hot encoding allows are reduced on the executors instead.
    """
    if not sides[0]:
        return
    by_name = [{f.spec.feature_name: f for f in side} for side in sides]
    encoded = [n for n, f in by_name[0].items() if f.spec.encoder_enabled and f.spec.encoder_type != "none"]
    by_mode = []
    for n, f in by_name[0].items():
        if f.spec.imputer_enabled and f.spec.imputer_strategy == "most_frequent":
            by_mode.append(n)
        elif f.spec.imputer_enabled:
            for side in by_name:
                side[n].fill = f.spec.imputer_fill_value

    names = list(dict.fromkeys([*by_mode, *encoded]))
    if not names:
        return
    counts = write_through(value_counts(df, names, [fold] if fold else []), "categories")
    if fold:  # each count goes to the training sides it belongs to
        others = F.filter(F.array(*map(F.lit, range(len(sides)))), lambda k: k != F.col(fold))
        counts = counts.select(F.explode(others).alias("side"), "name", "value", "n")
        counts = counts.groupBy("side", "name", "value").agg(F.sum("n").alias("n"))
    else:
        counts = counts.withColumn("side", F.lit(0))
    # A row for each side and column each; what is read in full comes from columns known to be narrow.
    known = counts.groupBy("side", "name").agg(F.count("value").alias("width"), F.max(F.col("value").isNull()).alias("missing")).collect()
    missing = {(r["side"], r["name"]) for r in known if r["missing"]}
    widths = {(r["side"], r["name"]): r["width"] for r in known}
    for r in most_frequent(counts.filter(F.col("name").isin(by_mode)), ["side"]).collect() if by_mode else []:
        by_name[r["side"]][r["name"]].fill = r["value"]
    empty = [n for n in by_mode if any(side[n].fill is None for side in by_name)]
    if empty:
        raise ValueError(f"columns without any value cannot be imputed from the data: {empty}")

    narrow = [n for n in encoded if all(widths.get((k, n), 0) <= MAX_CATEGORIES for k in range(len(sides)))]
    values: dict[tuple[int, str], list[str]] = {}
    if narrow:
        for r in counts.filter(F.col("name").isin(narrow) & F.col("value").isNotNull()).select("side", "name", "value").collect():
            values.setdefault((r["side"], r["name"]), []).append(r["value"])
    for k, side in enumerate(by_name):
        for n in encoded:
            f = side[n]
            extra = [f.fill] if f.fill is not None and (k, n) in missing else []
            if n in narrow:
                f.categories = sorted({*values.get((k, n), []), *extra})
                continue
            wide = counts.filter((F.col("side") == k) & (F.col("name") == n) & F.col("value").isNotNull()).select("value")
            more = df.sparkSession.createDataFrame([(x,) for x in extra], "value string")
            f.positions = _positions(wide.union(more).distinct())
            f.width = f.positions.filter("position IS NOT NULL").count()


def _positions(categories: DataFrame) -> DataFrame:
    """Rows (value, position): where the 1 of a category's one-hot vector stands, null for the first.

    The categories are written in sorted parts of even size, numbered within each part, and
    shifted by the parts before.
    """
    ranged = categories.repartitionByRange("value").withColumn("_part", F.spark_partition_id())
    parts = write_through(ranged, "positions")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("value")) - 1
    position = F.col("_shift") + F.col("_inside") - 1
    numbered = parts.withColumn("_inside", inside).join(shifts, "_part")
    return write_through(numbered.select("value", F.when(position >= 0, position).alias("position")), "positions")


def category_positions(df: DataFrame, name: str) -> DataFrame:
    """One-hot encoding of a column with any number of categories, as a position.

    Adds ``<name>_position``: where the single 1 of the row's one-hot vector stands, or null
    for the dropped first category and for missing values.
    """
    value = F.col(f"`{name}`")
    numbered = _positions(df.filter(value.isNotNull()).select(value.alias("value")).distinct())
    numbered = numbered.select(F.col("value").alias(name), F.col("position").alias(f"{name}_position"))
    return df.join(numbered, name, "left").select(*df.columns, f"{name}_position")
