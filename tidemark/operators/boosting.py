"""Gradient boosting with one model for all classes, grown level by level from histograms (M1, M4).

A round fits one tree for each class to the residuals of the softmax of all classes' scores (one
tree and the logistic function for two classes). A level of all the round's trees is one aggregate:
tasks count rows, residuals and weights by (tree, node, feature, bin), the counts are summed, and the
best cut of each node comes from its sums. The driver sees a row for each node. Rows stay where
they are written, binned; their scores are brought up to date every ``REFRESH`` rounds, so work is
linear in the rounds and a lost executor repeats at most those since.

A feature may be a category's place instead of a number. Its cuts then part one category from all
others, as cuts of one-hot columns do, but a row holds one number whatever the number of categories;
only a node's sums grow with it (24 bytes a category).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions.sketch import spread_quantiles
from tidemark.session import write_through
from tidemark.specs import ClassifierSpec

#: Rounds after which the stored scores are brought up to date, and bytes of a task's histograms.
REFRESH, HISTOGRAM_BYTES = 8, 64 << 20
MAX_BINS = 32
#: Gains this close (relatively) are equal; the first feature and the lowest cut then win.
TIE = 1e-9
LEAST_WEIGHT = 1e-150


@dataclass
class Tree:
    """Nodes in the order they were made; ``feature`` is -1 at leaves."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> None:
        """Rows whose bin is at most ``cut`` go to the first of two new nodes."""
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, len(self.feature), gain
        for of, default in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            of += [default, default]

    def walk(self, above) -> np.ndarray:
        """The leaf of each row; ``above(rows, features, nodes)`` tells which rows lie above their node's cut."""
        feature, left = np.array(self.feature), np.array(self.left)
        at = np.zeros(above.rows, np.int64)
        open_ = np.arange(above.rows) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(open_):
            nodes = at[open_]
            at[open_] = left[nodes] + above(open_, feature[nodes], nodes)
            open_ = open_[feature[at[open_]] >= 0]
        return at


class _Binned:
    """Bins above the node's cut; for categories, the bin that is the cut."""

    def __init__(self, bins: np.ndarray, tree: Tree, one: np.ndarray) -> None:
        self.bins, self.rows, self.cut, self.one = bins, len(bins), np.array(tree.cut), one

    def __call__(self, rows, features, nodes) -> np.ndarray:
        bins, cut = self.bins[rows, features], self.cut[nodes]
        return np.where(self.one[features], bins == cut, bins > cut)


class _Raw:
    """Numbers that are missing lie above every cut; missing places are no category."""

    def __init__(self, x: np.ndarray, tree: Tree, edges: list[np.ndarray], places: Mapping[int, int]) -> None:
        self.x, self.rows = x, len(x)
        self.one = np.isin(np.arange(len(edges)), list(places))
        # The bin of a place is one more than the place.
        self.cut = np.array([0.0 if f < 0 else c - 1 if f in places else edges[f][c] for f, c in zip(tree.feature, tree.cut)])

    def __call__(self, rows, features, nodes) -> np.ndarray:
        x, cut = self.x[rows, features], self.cut[nodes]
        return np.where(self.one[features], x == cut, ~(x <= cut))


def shares(raw: np.ndarray) -> np.ndarray:
    """Class probabilities of scores: softmax, or the logistic function for a single score (of class 1)."""
    if raw.shape[1] == 1:
        one = 1 / (1 + np.exp(-np.clip(raw, -700, 700)))
        return np.hstack([1 - one, one])
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class JointTrees:
    """Trees of all rounds (one for each class, or one for two classes) and the scores they start from.

    ``places`` has the number of categories of each feature that is a place.
    """

    spec: ClassifierSpec
    features: list[str]
    classes: list
    label_type: DataType
    edges: list[np.ndarray]
    start: list[float]
    rounds: list[list[Tree]]
    places: dict[int, int] = field(default_factory=dict)

    def labels(self) -> Column:
        """The classes as an array of the label's type."""
        return F.array(*[F.lit(c).cast(self.label_type) for c in self.classes])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        raw = np.tile(np.array(self.start), (len(x), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                raw[:, k] += np.array(tree.value)[tree.walk(_Raw(x, tree, self.edges, self.places))]
        return shares(raw)

    def score(self, df: DataFrame, vector: Column, probability: str, prediction: str) -> DataFrame:
        """Add the class probabilities (in the order of ``classes``) and the predicted class."""
        width, own = len(self.features), self

        @F.pandas_udf("array<double>")
        def scored(x: pd.Series) -> pd.Series:
            rows = np.array(x.tolist(), float).reshape(len(x), width)
            return pd.Series(list(own.probabilities(rows)))

        out = df.withColumn(probability, scored(vector_to_array(vector)))
        best = F.array_position(F.col(probability), F.array_max(F.col(probability))).cast("int")
        return out.withColumn(prediction, F.element_at(self.labels(), best))

    def first(self, rounds: int) -> JointTrees:
        """The model as it was after so many rounds."""
        return replace(self, rounds=self.rounds[:rounds])

    def importance(self) -> DataFrame:
        """Rows (feature, importance): shares of the gain, averaged over trees that split."""
        total, trees = np.zeros(len(self.features)), [t for r in self.rounds for t in r if t.feature[0] >= 0]
        for tree in trees:
            at = np.array(tree.feature)
            own = np.bincount(at[at >= 0], weights=np.array(tree.gain)[at >= 0], minlength=len(total))
            total += own / own.sum() / len(trees)
        rows = [(name, float(v)) for name, v in zip(self.features, total)]
        return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def bin_edges(rows: DataFrame, width: int, max_bins: int, places: Mapping[int, int] = {}) -> list[np.ndarray]:
    """Cuts of each feature: midpoints between its values, or quantiles where it has more than ``max_bins``.

    A task gives up on a feature at its first value too many, so no set of values outgrows the bins.
    Places need no cuts.
    """
    numbers = [j for j in range(width) if j not in places]
    if not numbers:
        return [np.zeros(0)] * width

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list = [np.zeros(0)] * width
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            for j in numbers:
                if seen[j] is not None:
                    found = np.union1d(seen[j], x[:, j][~np.isnan(x[:, j])])
                    seen[j] = found if len(found) <= max_bins else None
        js = [j for j in numbers for _ in ([None] if seen[j] is None else seen[j])]
        vs = [v for j in numbers for v in ([None] if seen[j] is None else seen[j].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(js, pa.int32()), pa.array(vs, pa.float64())], ["j", "v"])

    found = rows.select("x").mapInArrow(values, "j int, v double").distinct()
    # At most max_bins values of a feature survive; of more, only that there are more.
    sets = found.groupBy("j").agg(F.max(F.col("v").isNull()).alias("many"), F.count("v").alias("n"))
    few = sets.filter(~F.col("many") & (F.col("n") <= max_bins)).select(F.col("j").alias("of"))
    kept = found.join(few, F.col("j") == F.col("of")).select("j", "v").toPandas()
    edges: list = [None] * width
    for j, own in kept.groupby("j"):
        v = np.sort(own["v"].to_numpy())
        edges[j] = v[:-1] + (v[1:] - v[:-1]) / 2
    many = [r.j for r in sets.filter(F.col("many") | (F.col("n") > max_bins)).collect()]
    if many:
        pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col("x")[j].alias("v")) for j in many])).alias("p")).select("p.*")
        pairs = pairs.filter(~F.isnan("v"))
        for r in spread_quantiles(pairs, "v", [i / max_bins for i in range(1, max_bins)], ["j"]).collect():
            edges[r.j] = np.unique(np.array(r.p, float))
    return [np.zeros(0) if e is None else e for e in edges]


def _sizes(edges: list[np.ndarray], places: Mapping[int, int]) -> np.ndarray:
    """Number of bins of each feature; bin 0 of a place is that of no category."""
    return np.array([places.get(j, len(e)) + 1 for j, e in enumerate(edges)], np.int64)


def _write_binned(rows: DataFrame, edges: list[np.ndarray], places: Mapping[int, int]) -> DataFrame:
    width, kind = len(edges), np.min_scalar_type(int(_sizes(edges, places).max(initial=1)) - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            bins = np.empty(x.shape, kind)
            for j, e in enumerate(edges):
                if j in places:
                    known = (x[:, j] >= 0) & (x[:, j] < places[j])
                    bins[:, j] = np.where(known, x[:, j], -1) + 1
                    continue
                # Values at a cut lie below it; missing ones above all.
                bins[:, j] = np.where(np.isnan(x[:, j]), len(e), np.searchsorted(e, x[:, j], side="left"))
            stored = pa.array([b.tobytes() for b in bins], pa.binary())
            none = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), stored, batch.column("y"), none], ["row", "bins", "y", "raw"])

    return write_through(rows.mapInArrow(cut, "row long, bins binary, y int, raw binary"), "binned")


class _State:
    """What a task needs to bring a batch of binned rows up to date."""

    def __init__(self, sizes: np.ndarray, one: np.ndarray, start: Sequence[float], since: list[list[Tree]]) -> None:
        self.width, self.sizes, self.one, self.start, self.since = len(sizes), sizes, one, np.array(start), since
        self.kind = np.min_scalar_type(int(sizes.max(initial=1)) - 1)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Bins and scores of a batch."""
        n = batch.num_rows
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), self.kind).reshape(n, self.width)
        stored = batch.column("raw").to_pylist()
        raw = np.array([self.start if r is None else np.frombuffer(r) for r in stored]).reshape(n, len(self.start))
        for trees in self.since:
            for k, tree in enumerate(trees):
                raw[:, k] += np.array(tree.value)[tree.walk(_Binned(bins, tree, self.one))]
        return bins, raw


def _residuals(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Negative gradient and Newton weight of each row for each tree of the round."""
    p = shares(raw)
    if raw.shape[1] == 1:
        r = (y == 1)[:, None] - p[:, 1:]
        return r, p[:, 1:] * (1 - p[:, 1:])
    r = (y[:, None] == np.arange(raw.shape[1])) - p
    return r, np.abs(r) * (1 - np.abs(r))


def _drawn(rows: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Which rows take part in a round, by a hash of row and round."""
    x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + round_) % (1 << 63))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * ((1 << 64) - 1)))


PARTIAL = "tree int, node int, feature int, bin int, n double, s double, w double"
BEST = "tree int, node int, n double, s double, w double, feature int, cut int, gain double, n_left double, s_left double, w_left double"


def _level(table: DataFrame, state: _State, trees: list[Tree], nodes: list[tuple[int, int]], draw, leaf_rows: int) -> list:
    """The best cut of each open node (tree, node): one row each."""
    sizes, one, width = state.sizes, state.one, state.width
    base = np.cumsum(sizes) - sizes
    slots = int(sizes.sum())
    place = {pair: i for i, pair in enumerate(nodes)}
    at = [np.full(len(t.feature), -1, np.int64) for t in trees]
    for (k, node), i in place.items():
        at[k][node] = i

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(nodes) * slots))
        for batch in batches:
            binned, raw = state.read(batch)
            if draw is not None:
                taken = draw(batch.column("row").to_numpy())
                binned, raw, y = binned[taken], raw[taken], batch.column("y").to_numpy()[taken]
            else:
                y = batch.column("y").to_numpy()
            r, w = _residuals(raw, y)
            for k, tree in enumerate(trees):
                own = at[k][tree.walk(_Binned(binned, tree, one))]
                inside = np.flatnonzero(own >= 0)
                index = (own[inside, None] * slots + base + binned[inside]).ravel()
                for of, values in zip(sums, (None, r[inside, k], w[inside, k])):
                    np.add.at(of, index, 1.0 if values is None else np.repeat(values, width))
        used = np.flatnonzero(sums[0])
        pair = np.array(nodes, np.int32).reshape(-1, 2)[used // slots]
        feature = np.searchsorted(base, used % slots, side="right") - 1
        bin_ = used % slots - base[feature]
        columns = [pa.array(c.astype(np.int32)) for c in (pair[:, 0], pair[:, 1], feature, bin_)]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x[used]) for x in sums)], ["tree", "node", "feature", "bin", *"nsw"])

    def best(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = base[group["feature"]] + group["bin"].to_numpy()
        sums = np.zeros((3, slots))
        for of, name in zip(sums, "nsw"):
            of[own] = group[name]
        total = sums[:, : sizes[0]].sum(axis=1)
        low = np.empty_like(sums)
        for j in range(width):
            inside = slice(base[j], base[j] + sizes[j])
            low[:, inside] = total[:, None] - sums[:, inside] if one[j] else np.cumsum(sums[:, inside], axis=1)
        able = np.ones(slots, bool)
        able[np.where(one, base, base + sizes - 1)] = False  # no category, and cuts above all values
        (nl, sl, _), (nr, sr, _) = low, total[:, None] - low
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = nl * nr / total[0] * (sl / nl - sr / nr) ** 2
        gain = np.where(able & (nl >= max(1, leaf_rows)) & (nr >= max(1, leaf_rows)), gain, -1.0)
        row = [key[0], key[1], *total, -1, 0, 0.0, 0.0, 0.0, 0.0]
        if gain.size and (top := gain.max()) > 1e-12:
            at_ = int(np.flatnonzero(gain >= top * (1 - TIE))[0])
            j = int(np.searchsorted(base, at_, side="right")) - 1
            row[5:] = j, at_ - int(base[j]), float(gain[at_]), *low[:, at_].tolist()
        return pd.DataFrame([row], columns=[c.split()[0] for c in BEST.split(", ")])

    summed = table.mapInArrow(count, PARTIAL).groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "nsw"])
    return summed.groupBy("tree", "node").applyInPandas(best, BEST).collect()  # a row for each open node


def fit_joint(df: DataFrame, vector: Column, index: Column, label_type: DataType, features: Sequence[str], spec: ClassifierSpec, classes: list, settings: Mapping[str, Any], places: Mapping[int, int] = {}) -> JointTrees:
    """Fit all classes at once; ``index`` is the place of a row's class, ``settings`` the classifier's.

    ``places`` names the features that are categories' places (NaN: none), with the number of places.
    """
    width, outputs = len(features), 1 if len(classes) == 2 else len(classes)
    rate, depth, rounds = settings.get("learning_rate", 0.1), settings.get("max_depth", 3), settings.get("n_estimators", 100)
    share, seed = settings.get("subsample", 1.0), settings.get("random_state", spec.random_state) or 0
    plain = df.select(F.monotonically_increasing_id().alias("row"), vector_to_array(vector).alias("x"), index.cast("int").alias("y"))
    rows = write_through(plain, "training-rows")
    counts = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    total = sum(counts.values())
    if not total:
        raise ValueError("no rows to fit")
    prior = np.array([counts.get(k, 0) / total for k in range(len(classes))])
    logs = np.log(np.maximum(prior, np.finfo(float).eps))
    start = [float(logs[1] - logs[0])] if outputs == 1 else (logs - logs.mean()).tolist()
    split_rows, leaf_rows = settings.get("min_samples_split", 2), settings.get("min_samples_leaf", 1)
    edges = bin_edges(rows, width, settings.get("max_bins", MAX_BINS), places)
    table, since, done = _write_binned(rows, edges, places), [], []
    sizes, one = _sizes(edges, places), np.isin(np.arange(width), list(places))
    block = max(1, HISTOGRAM_BYTES // (24 * int(sizes.sum())))
    for number in range(rounds):
        state = _State(sizes, one, start, since)
        draw = None if share >= 1 else lambda r, number=number: _drawn(r, number, seed, share)
        trees = [Tree() for _ in range(outputs)]
        open_ = [(k, 0) for k in range(outputs)]
        sums: dict[tuple[int, int], tuple[float, float, float]] = {}
        for level in range(depth):
            found = []
            for i in range(0, len(open_), block):
                found += _level(table, state, trees, open_[i : i + block], draw, leaf_rows)
            open_ = []
            for f in sorted(found, key=lambda f: (f.tree, f.node)):
                sums[f.tree, f.node] = (f.n, f.s, f.w)
                if f.feature < 0 or f.n < split_rows:
                    continue
                tree = trees[f.tree]
                tree.split(f.node, f.feature, f.cut, f.gain)
                low = tree.left[f.node]
                for child, own in ((low, (f.n_left, f.s_left, f.w_left)), (low + 1, (f.n - f.n_left, f.s - f.s_left, f.w - f.w_left))):
                    sums[f.tree, child] = own
                    if level + 1 < depth and own[0] >= max(split_rows, 2 * leaf_rows):
                        open_.append((f.tree, child))
            if not open_:
                break
        scale = 1.0 if outputs == 1 else (outputs - 1) / outputs
        for (k, node), (_, s, w) in sums.items():
            if trees[k].feature[node] < 0:
                trees[k].value[node] = rate * scale * s / w if w > LEAST_WEIGHT else 0.0
        done.append(trees)
        since = [*since, trees]
        if len(since) == REFRESH and number + 1 < rounds:
            table, since = _refresh(table, _State(sizes, one, start, since)), []
    return JointTrees(spec, list(features), classes, label_type, edges, start, done, dict(places))


def _refresh(table: DataFrame, state: _State) -> DataFrame:
    """The rows with their scores after all rounds so far."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, raw = state.read(batch)
            stored = pa.array([r.tobytes() for r in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], stored], ["row", "bins", "y", "raw"])

    return write_through(table.mapInArrow(update, table.schema), "scored-rows")
