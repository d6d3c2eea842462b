"""Folds and train/test splits with exact sizes (K1 to K4).

Rows are ordered by a hash of their id (or by the id itself) and cut into blocks of exact
size. Only the values at the cuts are looked for, by two or three passes over the id and label
columns; tagging the rows is then a projection, so the wide rows are neither sorted nor
shuffled.
"""

from __future__ import annotations

import math
import warnings
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import SHUFFLE_KEYS, bucket_of, shuffle_key, with_computed
from tidemark.functions.ranks import MAX_ROWS, values_at_ranks
from tidemark.operators.checks import MAX_CLASSES


def kfold(
    df: DataFrame, key: str, n_splits: int = 5, seed: int = 42, fold: str = "fold", max_rows: int = MAX_ROWS
) -> DataFrame:
    """Tag rows with a fold: blocks of the shuffled order, sizes within one of each other."""
    total = df.count()
    _check_splits(n_splits, total)
    narrow = with_computed(df.select(F.col(key).alias("_id")), shuffle_key(seed, ["_id"]), "_h")
    cuts = _starts([total // n_splits + (i < total % n_splits) for i in range(n_splits)], total)
    at = values_at_ranks(narrow, "_h", {None: cuts}, {None: total}, None, "_id", max_rows, SHUFFLE_KEYS)
    edges = [_pair(F.lit(at[None, r][0]), F.lit(at[None, r][1])) for r in cuts]
    placed = with_computed(df, _pair(shuffle_key(seed, [key]), F.col(key)), "_here")
    return placed.withColumn(fold, bucket_of(F.col("_here"), edges)).drop("_here")


def stratified_kfold(
    df: DataFrame,
    key: str,
    label: str,
    n_splits: int = 5,
    seed: int = 42,
    fold: str = "fold",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Shuffled folds in which every label is spread evenly."""
    sizes = _label_sizes(df, key, label)
    blocks = _spread(sizes, n_splits)
    return _cut_by_label(df, key, label, sizes, blocks, seed, fold, max_rows)


def ordered_stratified_folds(
    df: DataFrame, key: str, label: str, n_splits: int = 5, fold: str = "fold", max_rows: int = MAX_ROWS
) -> DataFrame:
    """Stratified folds without shuffling: contiguous blocks of each label in id order."""
    sizes = _label_sizes(df, key, label)
    blocks = _spread(sizes, n_splits)
    return _cut_by_label(df, key, label, sizes, blocks, None, fold, max_rows)


def train_test_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    flag: str = "is_test",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Tag the rows of a stratified test part of ``ceil(n * test_size)`` rows.

    Each label contributes its share; rows left over by rounding go to the labels with the
    largest remainders.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    sizes = _label_sizes(df, key, label)
    if min(sizes.values()) < 2:
        raise ValueError("every label needs at least two rows for a stratified split")
    total = sum(sizes.values())
    n_test = math.ceil(total * test_size)
    if n_test < len(sizes) or total - n_test < len(sizes):
        raise ValueError("both parts must have room for every label")
    train = _proportional(sizes, total - n_test)
    blocks = {g: [sizes[g] - train[g], train[g]] for g in sizes}
    tagged = _cut_by_label(df, key, label, sizes, blocks, seed, flag, max_rows)
    return tagged.withColumn(flag, F.col(flag) == 0)


def _check_splits(n_splits: int, largest: int) -> None:
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    if n_splits > largest:
        raise ValueError(f"cannot make {n_splits} folds of {largest} rows")


def _label_sizes(df: DataFrame, key: str, label: str) -> dict[Any, int]:
    """Rows per label, in order of each label's first id."""
    counts = df.groupBy(F.col(label).alias("g")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
    found = counts.limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} classes")
    if any(r["g"] is None for r in found):
        raise ValueError("rows without a label cannot be stratified")
    if not found:
        raise ValueError("cannot split an empty frame")
    return {r["g"]: r["n"] for r in sorted(found, key=lambda r: r["first"])}


def _spread(sizes: dict[Any, int], n_splits: int) -> dict[Any, list[int]]:
    """Block sizes per label when the label-sorted rows are dealt to the folds in turn."""
    _check_splits(n_splits, max(sizes.values()))
    if min(sizes.values()) < n_splits:
        warnings.warn(f"the rarest label has fewer rows than {n_splits} folds", stacklevel=3)
    blocks, dealt = {}, 0
    for g, n in sizes.items():
        blocks[g] = [_dealt_to(i, dealt, dealt + n, n_splits) for i in range(n_splits)]
        dealt += n
    return blocks


def _dealt_to(fold: int, start: int, stop: int, n_splits: int) -> int:
    return (stop - fold + n_splits - 1) // n_splits - (start - fold + n_splits - 1) // n_splits


def _proportional(sizes: dict[Any, int], share: int) -> dict[Any, int]:
    total = sum(sizes.values())
    whole = {g: n * share // total for g, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda g: (-(sizes[g] * share % total), list(sizes).index(g)))
    for g in by_remainder[: share - sum(whole.values())]:
        whole[g] += 1
    return whole


def _starts(blocks: list[int], size: int) -> list[int]:
    """Rank at which each block but the first begins; blocks that begin after the end drop out."""
    starts, total = [], 0
    for n in blocks[:-1]:
        total += n
        starts.append(total)
    return [s for s in starts if s < size]


def _pair(hashed: Column, key: Column) -> Column:
    return F.struct(hashed.alias("h"), key.alias("id"))


def _cut_by_label(df, key, label, sizes, blocks, seed, fold, max_rows) -> DataFrame:
    cuts = {g: _starts(blocks[g], n) for g, n in sizes.items()}
    narrow = df.select(F.col(label).alias("_g"), F.col(key).alias("_id"))
    if seed is None:
        hashed = F.lit(0).cast("long")
        at = values_at_ranks(narrow, "_id", cuts, sizes, by="_g", max_rows=max_rows)
        at = {place: (0, value) for place, value in at.items()}
    else:
        hashed = shuffle_key(seed, [key])
        narrow = with_computed(narrow, shuffle_key(seed, ["_id"]), "_h")
        at = values_at_ranks(narrow, "_h", cuts, sizes, "_g", "_id", max_rows, SHUFFLE_KEYS)
    # One row per label: at most MAX_CLASSES rows, known to the driver.
    kind = f"_g {df.schema[label].dataType.simpleString()}, _cuts array<struct<h:bigint,id:{df.schema[key].dataType.simpleString()}>>"
    table = df.sparkSession.createDataFrame([(g, [at[g, r] for r in cuts[g]]) for g in sizes], kind)
    placed = with_computed(df, _pair(hashed, F.col(key)), "_here")
    joined = placed.join(F.broadcast(table), F.col(label) == F.col("_g"))
    number = F.size(F.filter("_cuts", lambda c: c <= F.col("_here")))
    return joined.withColumn(fold, number).drop("_g", "_cuts", "_here")
