"""Exact search for the largest inner products, with a KD-tree for each shard of the vectors.

A small top tree, fitted on a bounded sample, deals all vectors to shards, so that a shard is a
region of space. Each shard's task cuts its vectors at medians into a tree whose nodes carry tight
bounding boxes, and stores it as one row of a table. A query is first searched in the shard of its
own region. Its k-th best score then goes with it to those other shards whose bounding box could
still hold a better one. Inside a shard nodes are visited in the order of the largest score their
box allows, until that falls below the k-th score known. Scores are integers, so nothing is
approximate.

Equal vectors cannot be told apart by cuts. Of equal vectors only the ``k + 1`` smallest ids can
be among a query's best (ties go to smaller ids, one may be the query's own), so each batch of
rows, and then each shard, keeps only these; a vector that a third of all rows hold is a few rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

SCALE, TOP, EVERY = 256, 5, 50
#: Rows of a shard (as the sample predicts them), of a leaf, of the sample, and queries of one block.
SHARD_ROWS, LEAF_ROWS, SAMPLE_ROWS, BLOCK_QUERIES = 16_384, 128, 20_000, 2_048


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null if the vector or a component is null or not finite."""
    parts = vector.cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(parts, lambda x: F.floor(x * float(scale)).cast("long")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of ``dim`` elements as an array of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def top_tree(sample: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """Median cuts of the widest component: (component, cut, low side, high side); ``~i`` is shard ``i``."""
    nodes: list = []
    count = 0

    def cut(rows: np.ndarray, parts: int) -> int:
        nonlocal count
        spread = np.ptp(sample[rows], axis=0) if parts > 1 and len(rows) > 1 else np.zeros(1)
        if not spread.size or not spread.max():
            count += 1
            return ~(count - 1)
        axis = int(np.argmax(spread))
        low_parts = parts // 2
        values = np.sort(sample[rows, axis])
        value = int(values[(len(values) * low_parts) // parts - 1])
        value = int(values[values < values[-1]][-1]) if value == values[-1] else value
        at = len(nodes)
        nodes.append(None)
        low = sample[rows, axis] <= value
        nodes[at] = (axis, value, cut(rows[low], low_parts), cut(rows[~low], parts - low_parts))
        return at

    cut(np.arange(len(sample)), shards)
    return nodes


def locate(nodes: list, x: np.ndarray) -> np.ndarray:
    """The shard of each vector."""
    found = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))] if nodes else []
    while todo:
        node, rows = todo.pop()
        if node < 0:
            found[rows] = ~node
            continue
        axis, value, low_side, high_side = nodes[node]
        low = x[rows, axis] <= value
        todo += [(low_side, rows[low]), (high_side, rows[~low])]
    return found


def keep_smallest(ids: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Rows to keep: of equal vectors those with the ``most`` smallest different ids."""
    if not len(ids):
        return np.zeros(0, np.int64)
    bytes_ = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel() if x.shape[1] else np.zeros(len(ids), "V1")
    _, vector = np.unique(bytes_, return_inverse=True)
    order = np.lexsort((ids, vector))
    vector, sorted_ids = vector[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (vector[1:] != vector[:-1]) | (sorted_ids[1:] != sorted_ids[:-1])
    order, vector = order[new], vector[new]
    first = np.searchsorted(vector, vector)
    return np.sort(order[np.arange(len(order)) - first < most])


def build(x: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row order, nodes (start, end, left child or -1) and their boxes (least and largest components)."""
    order, nodes, boxes = np.arange(len(x)), [[0, len(x), -1]], []
    at = 0
    while at < len(nodes):
        start, end, _ = nodes[at]
        rows = order[start:end]
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        boxes.append((low, high))
        if end - start > leaf and (high > low).any():
            axis = int(np.argmax(high - low))
            middle = (end - start) // 2
            order[start:end] = rows[np.argpartition(x[rows, axis], middle)]
            nodes[at][2] = len(nodes)
            nodes += [[start, start + middle, -1], [start + middle, end, -1]]
        at += 1
    return order, np.array(nodes, np.int64), np.array(boxes, np.int64)


def _product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    if len(x) and float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]) < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


def search(ids: np.ndarray, x: np.ndarray, nodes: np.ndarray, boxes: np.ndarray, own: int, q: np.ndarray, top: int, known: int | None) -> list[tuple[int, int]]:
    """The shard's ``top`` best (score, id) for a query, none below ``known``, its k-th score so far."""
    limits = np.maximum(boxes[:, 0] * q, boxes[:, 1] * q).sum(axis=1)
    best: list[tuple[int, int]] = []  # a heap of (score, -id), worst first
    todo = [(-int(limits[0]), 0)]
    least = known
    while todo:
        limit, node = heapq.heappop(todo)
        if least is not None and -limit < least:
            break
        start, end, child = nodes[node]
        if child >= 0:
            for side in (child, child + 1):
                if least is None or limits[side] >= least:
                    heapq.heappush(todo, (-int(limits[side]), int(side)))
            continue
        scores = _product(x[start:end], q)
        good = np.flatnonzero((ids[start:end] != own) & (scores >= (least if least is not None else scores.min(initial=0))))
        for i in good[np.lexsort((ids[start:end][good], -scores[good]))[:top]]:
            entry = (int(scores[i]), -int(ids[start + i]))
            if len(best) < top:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
        if len(best) == top and (least is None or best[0][0] > least):
            least = best[0][0]
    return [(s, -i) for s, i in best]


def top_products(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, scale: int = SCALE) -> DataFrame:
    """Per query its ``top`` other rows by integer inner product: ``query_id, rank, vec_id, score``.

    Vectors that are null, or hold null or non-finite components, and rows with a null id take no
    part. Vectors are compared with those of the same length. Rows with the query's id are its
    own; if they hold different vectors, the smallest of these asks. Fewer than ``top`` candidates
    give fewer rows, an empty table none.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole_components(F.col(vector_col), scale).alias("x"), is_query.alias("asks"))
    rows = stored(rows.filter("id is not null and x is not null").withColumn("dim", F.size("x")), "vectors")
    parts = [_one_length(rows.filter(F.col("dim") == d), d, n, top) for d, n in sorted((r.dim, r.n) for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect())]
    found = parts[0] if parts else rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for other in parts[1:]:
        found = found.unionByName(other)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _one_length(rows: DataFrame, dim: int, count: int, top: int) -> DataFrame:
    shards = max(1, math.ceil(count / SHARD_ROWS))
    sample = rows.select("x", F.xxhash64("id", "x").alias("h")).orderBy("h").limit(SAMPLE_ROWS if shards > 1 else 0).select("x").toPandas()["x"]
    nodes = top_tree(np.array(sample.tolist(), np.int64).reshape(-1, dim), shards) if len(sample) else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = matrix(batch.column("x"), dim), batch.column("id").to_numpy()
            kept = keep_smallest(ids, x, top + 1)
            yield pa.RecordBatch.from_arrays([*(batch.take(pa.array(kept)).columns), pa.array(locate(nodes, x[kept]))], ["id", "x", "shard"])

    dealt = rows.select("id", "x").mapInArrow(deal, "id long, x array<long>, shard long")

    def index(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids, x = group["id"].to_numpy(np.int64), np.array(group["x"].tolist(), np.int64).reshape(len(group), dim)
        kept = keep_smallest(ids, x, top + 1)
        ids, x = ids[kept], x[kept]
        order, tree, boxes = build(x)
        fields = {"shard": key[0], "ids": ids[order].tobytes(), "x": x[order].tobytes(), "tree": tree.tobytes(), "boxes": boxes.tobytes()}
        return pd.DataFrame([fields | {"low": boxes[0, 0].tolist(), "high": boxes[0, 1].tolist()}])

    kinds = "shard long, ids binary, x binary, tree binary, boxes binary, low array<long>, high array<long>"
    trees = stored(dealt.groupBy("shard").applyInPandas(index, kinds), "kd-trees")

    queries = rows.filter("asks").groupBy("id").agg(F.min("x").alias("x"))
    blocks = max(1, math.ceil(count / EVERY / BLOCK_QUERIES))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = locate(nodes, matrix(batch.column("x"), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], ["id", "x", "shard"])

    def ask(asked: DataFrame) -> DataFrame:
        """Search each row's shard; a block of queries of one shard is one group."""
        asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        wanted = asked.select(F.col("shard").alias("of"), F.col("block").alias("for_block")).distinct()
        needed = trees.drop("low", "high").join(wanted, F.col("shard") == F.col("of"))

        def run(tree: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
            found = []
            for _, t in tree.iterrows():
                ids, parts = np.frombuffer(t["ids"], np.int64), np.frombuffer(t["tree"], np.int64).reshape(-1, 3)
                x, boxes = np.frombuffer(t["x"], np.int64).reshape(len(ids), dim), np.frombuffer(t["boxes"], np.int64).reshape(len(parts), 2, dim)
                for own, q, known in zip(group["id"], group["x"], group["known"]):
                    best = search(ids, x, parts, boxes, own, np.asarray(q, np.int64), top, None if pd.isna(known) else int(known))
                    found += [(own, i, s) for s, i in best]
            return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

        sides = needed.groupBy("of", "for_block").cogroup(asked.groupBy("shard", "block"))
        return sides.applyInPandas(run, "query_id long, vec_id long, score long")

    asked = queries.mapInArrow(home, "id long, x array<long>, shard long")
    first = stored(ask(asked.withColumn("known", F.lit(None).cast("decimal(38,0)"))), "first-search")
    if shards == 1:
        return first

    # The k-th score of the own region goes with the query to every shard whose box allows more.
    score = F.when(F.count(F.lit(1)) >= top, F.min("score")).cast("decimal(38,0)")
    known = first.groupBy("query_id").agg(score.alias("known"))
    boxes = trees.select("shard", "low", "high").toPandas()  # a box for each shard
    numbers = boxes["shard"].to_numpy(np.int64)
    low, high = (np.array(boxes[c].tolist(), np.int64).reshape(-1, dim) for c in ("low", "high"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, least = matrix(batch.column("x"), dim), batch.column("known").to_pylist()
            at = locate(nodes, x)
            pairs = []
            for i, q in enumerate(x):
                limits = np.maximum(low * q, high * q).sum(axis=1)
                pairs += [(i, s) for s in numbers[(numbers != at[i]) & (limits >= (least[i] if least[i] is not None else limits.min(initial=0)))]]
            rows_, shard = (np.array(c, np.int64) for c in (zip(*pairs) if pairs else ((), ())))
            taken = batch.take(pa.array(rows_))
            yield pa.RecordBatch.from_arrays([taken.column("id"), taken.column("x"), taken.column("known"), pa.array(shard)], ["id", "x", "known", "shard"])

    with_known = queries.join(known, queries["id"] == known["query_id"], "left").select("id", "x", "known")
    further = with_known.mapInArrow(visit, "id long, x array<long>, known decimal(38,0), shard long")
    return first.unionByName(ask(stored(further, "further")))


def op7_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE = f"""
WITH parts AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
