"""Quality classifier: gradient-boosted trees over statistics of whole documents.

The statistics are computed for every document by array operations over the bytes of a batch. The
trees are grown from histograms of binned statistics, on the driver, from at most
``TRAIN_ROWS`` labelled rows (those whose hashed id comes first); they are then flattened into
arrays, and a batch of rows walks all trees by array lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free, segment_ids, slices, stored, table
from tidemark.llm.text_bytes import LOWER, Hashes, utf8, words

#: Labelled rows that the trees are grown from, at most.
TRAIN_ROWS = 40_000
TREES, DEPTH, RATE, BINS, LEAST_WEIGHT, SHRINK = 80, 4, 0.15, 64, 2.0, 1.0
THRESHOLD = 0.3

STATISTICS = [
    "log_bytes", "log_words", "lower", "upper", "digit", "space", "comma_stop", "symbol", "non_ascii", "newline",
    "top_symbol", "mean_word", "spread_word", "long_words", "no_letter_words", "symbol_ends", "distinct_words",
    "top_word", "mean_line", "distinct_lines", "distinct_pairs",
]

# Classes of bytes: lower, upper, digit, space, comma or stop, other ASCII, not ASCII.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[[44, 46]] = 4
_CLASS[128:] = 6


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: how many different values it has, and how often its commonest one occurs."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[at], np.diff(np.append(at, len(owner))))
    return np.bincount(owner[at], minlength=n), top


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text; null and empty texts have zeros."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = segment_ids(offsets)
    kinds = np.bincount(owner * 7 + _CLASS[data], minlength=n * 7).reshape(n, 7)
    odd = np.flatnonzero(_CLASS[data] == 5)
    _, top_symbol = _distinct(owner[odd], data[odd], n)
    hashes = Hashes(LOWER[data])
    start, end, first = words(data, offsets)
    count = np.diff(first)
    of_word, length = segment_ids(first), end - start
    total = lambda x: np.bincount(of_word, weights=x, minlength=n)
    hash_ = hashes.of(start, end)
    different, top_word = _distinct(of_word, hash_, n)
    letters = np.concatenate([[0], np.cumsum((_CLASS[data] <= 1) | (_CLASS[data] == 6))])
    pair = (of_word[1:] == of_word[:-1]) if len(of_word) else np.zeros(0, bool)
    pairs, _ = _distinct(of_word[1:][pair], (hash_[1:] * np.uint64(31) + hash_[:-1])[pair], n)
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1][size > 0], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    of_line = owner[line_start] if len(line_start) else np.zeros(0, np.int64)
    lines = np.bincount(of_line, minlength=n)
    line_hash = hashes.of(line_start, line_end - ((line_end > line_start) & (data[line_end - 1] == 10))) if len(line_start) else np.zeros(0, np.uint64)
    own_lines, _ = _distinct(of_line, line_hash, n)
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(count, 1)
    mean = total(length) * per_word
    columns = [
        np.log1p(size), np.log1p(count), *(kinds[:, k] * per_byte for k in range(7)), np.bincount(owner[breaks], minlength=n) * per_byte,
        top_symbol * per_byte, mean, np.sqrt(np.maximum(total(length.astype(float) ** 2) * per_word - mean**2, 0)), total(length > 16) * per_word,
        total(letters[end] == letters[start]) * per_word, total(_CLASS[data[end - 1]] == 5) * per_word, different * per_word,
        top_word * per_word, size / np.maximum(lines, 1), own_lines / np.maximum(lines, 1), pairs / np.maximum(count - 1, 1),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def document_statistics(docs: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """``keep`` columns of each row and its statistics as an array of floats."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            found = statistics(batch.column("__text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, "statistics"])

    source = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return source.mapInArrow(measure, f"{kinds}statistics array<float>")


@dataclass
class Trees:
    """All trees in flat arrays; a leaf is its own child, so a walk takes ``depth`` steps for every row."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees for the logistic loss; each split is the best of the histograms' cuts.

    With no rows, or rows of one label, there are no splits and the probability is that of the
    labels seen, counted with one more row of each.
    """
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1) if len(x) else np.zeros(x.shape, int)
    columns = x.shape[1]
    flat = binned + np.arange(columns) * BINS
    margin = np.full(len(y), base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
        todo = [(roots[-1], np.arange(len(y)), 0)]
        while todo:
            node, rows, level = todo.pop()
            g, h = slope[rows].sum(), weight[rows].sum()
            best = (1e-6, -1, -1)
            if level < depth:
                at = flat[rows].ravel()
                gs = np.bincount(at, np.repeat(slope[rows], columns), columns * BINS).reshape(columns, BINS).cumsum(axis=1)
                hs = np.bincount(at, np.repeat(weight[rows], columns), columns * BINS).reshape(columns, BINS).cumsum(axis=1)
                gain = gs**2 / (hs + SHRINK) + (g - gs) ** 2 / (h - hs + SHRINK) - g**2 / (h + SHRINK)
                gain[(hs < LEAST_WEIGHT) | (h - hs < LEAST_WEIGHT)] = 0
                for k, c in enumerate(cuts):
                    gain[k, len(c) :] = 0
                k, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
                best = max(best, (float(gain[k, cut]), int(k), int(cut)))
            if best[1] < 0:
                nodes[node][4] = -rate * g / (h + SHRINK)
                margin[rows] += nodes[node][4]
                continue
            _, k, cut = best
            low = binned[rows, k] <= cut
            left, right = len(nodes), len(nodes) + 1
            nodes[node][:4] = [k, cuts[k][cut], left, right]
            nodes += [[0, np.inf, left, left, 0.0], [0, np.inf, right, right, 0.0]]
            todo += [(left, rows[low], level + 1), (right, rows[~low], level + 1)]
    a = np.array(nodes, float).reshape(-1, 5)
    return Trees(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], np.array(roots, int), depth, base)


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def training_rows(measured: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled documents, first by hashed id.

    Null labels are left out; a document labelled more than once counts with its highest label.
    """
    known = labels.filter(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    joined = measured.filter(learn).join(known, "doc_id")
    sample = joined.select("statistics", "__label", F.xxhash64("doc_id").alias("__h"), "doc_id").orderBy("__h", "doc_id").limit(rows)
    found = sample.select("statistics", "__label").toPandas()
    x = np.stack(found["statistics"].to_numpy()) if len(found) else np.zeros((0, len(STATISTICS)), np.float32)
    return x.astype(np.float32), found["__label"].to_numpy(float)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``score`` (of label 1) and ``predicted``.

    Labels of held-out documents (crc32 of the id divisible by five) are not learned from. Null
    and empty texts are scored by their statistics, which are zeros; an empty table gives no
    rows; without any label of one kind all scores are the share of the labels known.
    """
    measured = stored(document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", "doc_id"), "statistics")
    model = grow(*training_rows(measured, labels, "quality", remainder("doc_id", 5) != 0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("statistics").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.probability(x))], ["doc_id", "score"])

    scored = measured.mapInArrow(score, "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", predicted)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier accepts; all columns stay.

    It is learned as in ``score_quality``. A text is measured once more when its row is judged, so
    no text is shuffled. Null texts are judged as empty ones, each row by its own text, whatever its
    id (null or repeated). An empty table stays empty.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = stored(document_statistics(ids.filter("doc_id is not null"), "text", "doc_id"), "statistics")
    model = grow(*training_rows(measured, labels, "quality", remainder("doc_id", 5) != 0))

    text, names = free("__text", docs), docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            good = model.probability(statistics(batch.column(text))) >= threshold
            yield batch.select(names).filter(pa.array(good))

    return docs.withColumn(text, F.col("text").cast("string")).mapInArrow(judge, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored for quality."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
