"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Scores are integer inner products. A vector x gets one more component, the root of M^2 - |x|^2 with M
the largest norm of its shard, so that all have the same norm and inner products with a query are an
affine function of Euclidean distance. Over these augmented vectors each shard holds a cover tree:
the points of a node lie within its radius of its centre, the centres of its children are more than
``1 / SHRINK`` of that radius apart and cover all its points, and the node's own centre is the first of
them. A node's inner products with q then lie within |q| times its radius of its centre's.

Nodes are visited in the order of the largest product they allow. Nodes outside all windows that are
asked for, or of no wanted label, are skipped; leaves are verified with integer products, so nothing is
approximate. A query is first searched in its most promising shard; what it found there narrows its
windows before it goes to the others, of which it visits those whose balls reach into a window.
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
from tidemark.llm.nearest import keep_smallest, locate, top_tree, whole_components

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: Least score of a negative, in percent of the positive's.
NEAR = 80
#: Rows of a shard and of the sample that deals vectors to shards, sample rows for each region.
SHARD_ROWS, SAMPLE_ROWS, REGION_SAMPLE = 4_096, 20_000, 8
#: Points of a leaf; a node also stays a leaf if its net needed a centre for fewer than ``FAN`` points.
LEAF_ROWS, FAN, SHRINK = 32, 4, 1.3
#: Queries of a group, balls of a group.
BLOCK_QUERIES, BLOCK_BALLS = 1_024, 1_024
LOW, HIGH = -(1 << 62), 1 << 62


def augmented(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The vectors with equal norms, and that norm."""
    x = x.astype(np.float64)
    squares = (x * x).sum(axis=1)
    most = float(squares.max(initial=0))
    return np.column_stack([x, np.sqrt(np.maximum(most - squares, 0))]), math.sqrt(most)


def build(x: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """A cover tree: ``order`` of the rows; per node its rows (start, end), children (first, count), label.

    ``centre`` is a row's place in the order, ``radius`` the largest distance to any of the node's
    points, ``label`` that of all its rows, with ``mixed`` where there are several.
    """
    y, norm = augmented(x)
    # Rounding in the added component can reach norm * 1e-8.
    slack = 1e-7 * norm
    order, nodes, centres, radii = np.arange(len(x)), [[0, len(x), 0, 0]], [0], []
    reach = [np.linalg.norm(y - y[0], axis=1)]
    at = 0
    while at < len(nodes):
        start, end, _, _ = nodes[at]
        rows, near = order[start:end].copy(), reach[at]
        reach[at] = None
        centre = centres[at]
        radius = float(near.max(initial=0))
        radii.append(radius)
        if len(rows) > LEAF_ROWS and radius > 0:
            net, owner = [centre], np.zeros(len(rows), np.int64)
            while len(net) * FAN <= len(rows):
                far = int(np.argmax(near))
                if near[far] <= radius / SHRINK:
                    break
                distance = np.linalg.norm(y[rows] - y[rows[far]], axis=1)
                closer = distance < near
                owner[closer], near = len(net), np.minimum(near, distance)
                net.append(rows[far])
            if len(net) > 1 and len(net) * FAN <= len(rows):
                by_owner = np.argsort(owner, kind="stable")
                order[start:end] = rows[by_owner]
                cuts = start + np.searchsorted(owner[by_owner], np.arange(len(net) + 1))
                nodes[at][2:] = len(nodes), len(net)
                for i, own in enumerate(net):
                    nodes.append([cuts[i], cuts[i + 1], 0, 0])
                    centres.append(own)
                    reach.append(near[by_owner][cuts[i] - start : cuts[i + 1] - start])
        at += 1
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    nodes = np.array(nodes, np.int64)
    sorted_labels = labels[order]
    first = sorted_labels[nodes[:, 0]] if len(x) else np.zeros(1, np.int64)
    changes = np.concatenate([[0], np.cumsum(sorted_labels[1:] != sorted_labels[:-1]), [0]])
    mixed = changes[nodes[:, 1] - 1] != changes[nodes[:, 0]]
    return {"order": order, "nodes": nodes, "centre": place[centres], "radius": np.array(radii) * (1 + 1e-9) + slack, "label": first, "mixed": mixed}


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]) < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


class Shard:
    """A cover tree with the rows it is made of, in its order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, tree: dict[str, np.ndarray]) -> None:
        self.ids, self.labels, self.tree = ids, labels, tree
        largest = float(np.abs(x).max(initial=0))
        self.x, self.exact_below = x, 2**53 / max(1.0, largest * max(1, x.shape[1]))
        self.floats = x.astype(np.float64)
        self.centres = self.floats[tree["centre"]]
        self.visited = 0

    def search(self, own: int, label: int, q: np.ndarray, lows: np.ndarray, highs: np.ndarray, same: bool, top: int) -> list[list[tuple[int, int]]]:
        """For each window of scores, its ``top`` best (score, id) of the wanted label, best first."""
        nodes, radius = self.tree["nodes"], self.tree["radius"]
        least, best = lows.copy(), [[] for _ in lows]
        qf, exact = q.astype(np.float64), float(np.abs(q).max(initial=0)) < self.exact_below
        norm = float(np.linalg.norm(qf)) * (1 + 1e-9)
        todo = [(-math.inf, 0)]
        while todo:
            limit, node = heapq.heappop(todo)
            if -limit < least.min():
                break
            start, end, first, count = nodes[node]
            if not count:
                self.visited += end - start
                scores = (self.floats[start:end] @ qf).astype(np.int64) if exact else self.x[start:end] @ q
                fits = ((self.labels[start:end] == label) == same) & (self.ids[start:end] != own) & (scores >= least.min()) & (scores <= highs.max())
                fits = np.flatnonzero(fits)
                found, ids = scores[fits], self.ids[start:end][fits]
                for w in range(len(least)):
                    inside = np.flatnonzero((found >= least[w]) & (found <= highs[w]))
                    if not len(inside):
                        continue
                    inside = inside[np.lexsort((ids[inside], -found[inside]))[:top]]
                    new = [(-s, i) for s, i in zip(found[inside].tolist(), ids[inside].tolist())]
                    best[w] = heapq.nsmallest(top, best[w] + new)
                    if len(best[w]) == top:
                        least[w] = -best[w][-1][0]
                continue
            kids = slice(first, first + count)
            middle, spread = self.centres[kids] @ qf, radius[kids] * norm
            # Centres' products are rounded where integers do not fit a float.
            spread = spread if exact else spread + 1e-9 * np.abs(middle) + 1
            above, below = middle + spread, middle - spread
            wanted = self.tree["mixed"][kids] | ((self.tree["label"][kids] == label) == same)
            alive = wanted & ((above[:, None] >= least) & (below[:, None] <= highs)).any(axis=1)
            for k in np.flatnonzero(alive).tolist():
                heapq.heappush(todo, (-above[k], first + k))
        return [[(-s, i) for s, i in b] for b in best]


ROW = "id long, label long, dim int, x array<long>"
TREE = "shard long, dim int, ids binary, labels binary, x binary, nodes binary, centre binary, radius binary, label binary, mixed binary, ball array<double>, ball_radius double"
_PARTS = {"nodes": np.int64, "centre": np.int64, "radius": np.float64, "label": np.int64, "mixed": np.bool_}


def _region_finder(rows: DataFrame):
    """For each vector length a tree of median cuts, fitted on a bounded sample of all rows."""
    counts = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each length
    sample = rows.select("dim", "x", F.xxhash64("id", "label", "x").alias("h")).orderBy("h").limit(SAMPLE_ROWS).select("dim", "x").toPandas()
    trees = {}
    for dim, own in sample.groupby("dim"):
        regions = min(math.ceil(counts[dim] / SHARD_ROWS), max(1, len(own) // REGION_SAMPLE))
        trees[dim] = top_tree(np.array(own["x"].tolist(), np.int64).reshape(-1, dim), regions) if regions > 1 else []
    return trees


def plant(rows: DataFrame, top: int) -> DataFrame:
    """``TREE``: the rows' shards with their cover trees.

    Rows are dealt by regions of space; a region with more rows than its share is cut by hashes of
    the ids, so no group exceeds about twice ``SHARD_ROWS``. Of rows with equal vector and label only
    the ``top + 1`` smallest ids can be answers; each batch keeps only these.
    """
    trees = _region_finder(rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), dim)
                kept = keep_smallest(ids, np.column_stack([x, labels]), top + 1)
                regions = pa.array(locate(trees.get(dim, []), x[kept]), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(kept)).columns, regions], ["id", "label", "dim", "x", "region"])

    dealt = stored(rows.select("id", "label", "dim", "x").mapInArrow(deal, f"{ROW}, region long"), "dealt")
    sizes = dealt.groupBy("dim", "region").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(F.col("dim").alias("of_dim"), F.col("region").alias("of"), F.greatest(F.lit(1), F.round(F.col("n") / SHARD_ROWS)).cast("long").alias("parts"))
    placed = dealt.join(sizes, (F.col("dim") == F.col("of_dim")) & (F.col("region") == F.col("of")))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).select("id", "label", "dim", "x", "region", "part")

    def index(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        ids, labels = group["id"].to_numpy(np.int64), group["label"].to_numpy(np.int64)
        x = np.array(group["x"].tolist(), np.int64).reshape(len(group), dim)
        kept = keep_smallest(ids, np.column_stack([x, labels]), top + 1)
        tree = build(x[kept], labels[kept])
        order = kept[tree.pop("order")]
        row = {"shard": key[1] * 1_000_000 + key[2], "dim": dim, "ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "x": x[order].tobytes()}
        row |= {k: np.ascontiguousarray(tree[k], kind).tobytes() for k, kind in _PARTS.items()}
        return pd.DataFrame([row | {"ball": x[order[tree["centre"][0]]].astype(float).tolist(), "ball_radius": float(tree["radius"][0])}])

    grown = placed.groupBy("dim", "region", "part").applyInPandas(index, TREE)
    grown = stored(grown, "cover-trees")
    return grown.withColumn("block", F.pmod(F.xxhash64("dim", "shard"), F.lit(max(1, math.ceil(grown.count() / BLOCK_BALLS)))))


def _shard(row) -> Shard:
    dim = int(row["dim"])
    tree = {k: np.frombuffer(row[k], kind) for k, kind in _PARTS.items()}
    tree["nodes"] = tree["nodes"].reshape(-1, 4)
    ids = np.frombuffer(row["ids"], np.int64)
    return Shard(ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["x"], np.int64).reshape(len(ids), dim), tree)


ASK = f"{ROW}, lows array<long>, highs array<long>"


def windows_best(trees: DataFrame, asked: DataFrame, same: bool, top: int) -> DataFrame:
    """For rows of ``ASK``: the best ``top`` rows in each window, ``query_id, high, vec_id, score, rank``.

    ``same`` asks for rows of the query's label, else for those of any other. A query's windows have
    different upper ends.
    """
    asked = stored(asked.withColumn("q_block", F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(asked.count() / BLOCK_QUERIES))))), "asked")
    balls = trees.select("shard", F.col("dim").alias("b_dim"), F.col("block").alias("b_block"), "ball", "ball_radius")
    blocks = trees.select("dim", "block").distinct()

    def reaching(queries: DataFrame, best_only: bool, label: str) -> DataFrame:
        """Queries with each ``shard`` whose ball reaches into a window, or only the most promising."""
        spread = queries.join(blocks, "dim")  # a row for each query and block of balls
        wanted = spread.select(F.col("dim").alias("w_dim"), F.col("block").alias("w_block"), F.col("q_block").alias("w_q")).distinct()
        sides = balls.join(wanted, (F.col("b_dim") == F.col("w_dim")) & (F.col("b_block") == F.col("w_block")))

        def run(ball: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(ball) and len(group):
                dim = int(ball["b_dim"].iloc[0])
                centres, radius = np.array(ball["ball"].tolist(), float).reshape(len(ball), dim), ball["ball_radius"].to_numpy()
                shards = ball["shard"].to_numpy()
                q = np.array(group["x"].tolist(), float).reshape(len(group), dim)
                norm = np.linalg.norm(q, axis=1)
                middle, own = q @ centres.T, group["id"].to_numpy()
                spread = norm[:, None] * radius * (1 + 1e-9) + 1e-9 * np.abs(middle) + 1
                above, below = middle + spread, middle - spread
                for i, (lows, highs) in enumerate(zip(group["lows"], group["highs"])):
                    fits = ((above[i][:, None] >= np.asarray(lows)) & (below[i][:, None] <= np.asarray(highs))).any(axis=1)
                    hits = np.flatnonzero(fits)
                    if best_only and len(hits):
                        hits = hits[[np.argmax(above[i][hits])]]
                    out += [(own[i], shards[h], above[i][h]) for h in hits]
            return pd.DataFrame(out, columns=["to_id", "shard", "above"]).astype({"to_id": "int64", "shard": "int64", "above": "float64"})

        found = sides.groupBy("b_dim", "b_block", "w_q").cogroup(spread.groupBy("dim", "block", "q_block")).applyInPandas(run, "to_id long, shard long, above double")
        if best_only:
            found = found.groupBy("to_id").agg(F.max_by("shard", F.struct("above", "shard")).alias("shard"))
        return stored(found.select("to_id", "shard"), label)

    def search(queries: DataFrame, visits: DataFrame) -> DataFrame:
        visiting = queries.join(visits, F.col("id") == F.col("to_id")).drop("to_id")
        wanted = visiting.select(F.col("dim").alias("w_dim"), F.col("shard").alias("w_shard"), F.col("q_block").alias("w_q")).distinct()
        needed = trees.drop("block", "ball", "ball_radius").join(wanted, (F.col("dim") == F.col("w_dim")) & (F.col("shard") == F.col("w_shard")))

        def run(tree: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
            out = []
            for _, t in tree.iterrows():
                shard = _shard(t)
                for own, label, q, lows, highs in zip(group["id"], group["label"], group["x"], group["lows"], group["highs"]):
                    highs = np.asarray(highs, np.int64)
                    best = shard.search(own, label, np.asarray(q, np.int64), np.asarray(lows, np.int64), highs, same, top)
                    out += [(own, h, i, s) for h, found in zip(highs.tolist(), best) for s, i in found]
            return pd.DataFrame(out, columns=["query_id", "high", "vec_id", "score"]).astype("int64")

        pairs = needed.groupBy("dim", "shard", "w_q").cogroup(visiting.groupBy("dim", "shard", "q_block"))
        return pairs.applyInPandas(run, "query_id long, high long, vec_id long, score long")

    home = reaching(asked, True, "home-shards")
    first = stored(search(asked, home), "first-search")
    # A window that is full already rises to its last score; ties may still have smaller ids.
    full = first.groupBy("query_id", "high").agg(F.when(F.count(F.lit(1)) >= top, F.min("score")).alias("least")).filter("least is not null")
    known = full.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("high", "least"))).alias("known"))  # as many as a query has windows
    raised = F.zip_with("lows", "highs", lambda low, high: F.coalesce(F.element_at("known", high), low))
    narrowed = stored(asked.join(known, F.col("id") == F.col("query_id"), "left").withColumn("lows", F.when(F.col("known").isNull(), F.col("lows")).otherwise(raised)).select(asked.columns), "narrowed")
    others = reaching(narrowed, False, "other-shards")
    others = others.join(home.select(F.col("to_id").alias("h_id"), F.col("shard").alias("h_shard")), (F.col("to_id") == F.col("h_id")) & (F.col("shard") == F.col("h_shard")), "left_anti")
    found = first.unionByName(search(narrowed, others))
    order = Window.partitionBy("query_id", "high").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, near: int = NEAR, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its ``positives`` best other rows of its label. Negatives are, for each
    positive, the ``negatives`` best rows of other labels that score at most as high as it and at
    least ``near`` percent of that; a positive of negative score has none. Ties go to smaller ids.

    Rows with a null id or label, a null vector, or null or non-finite components take no part;
    vectors are compared with those of the same length. Identical rows count once. Rows with an
    anchor's id are its own; if they differ, the one of smallest label and vector asks. Other columns
    are ignored, an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole_components(F.col(vector_col), scale).alias("x"), is_anchor.alias("asks"))
    rows = rows.filter("id is not null and label is not null and x is not null").withColumn("dim", F.size("x"))
    rows = stored(rows.select("id", "label", "dim", "x", "asks"), "vectors")
    trees = plant(rows, max(positives, negatives))
    asks = rows.filter("asks").groupBy("id").agg(F.min(F.struct("label", "x")).alias("own"))
    anchors = asks.select("id", "own.label", F.size("own.x").alias("dim"), "own.x")
    whole = anchors.select("*", F.array(F.lit(LOW)).alias("lows"), F.array(F.lit(HIGH)).alias("highs"))
    good = stored(windows_best(trees, whole, True, positives).select(F.col("query_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # One window for each different score of an anchor's positives.
    scores = good.filter("positive_score >= 0").groupBy("anchor_id").agg(F.array_sort(F.collect_set("positive_score")).alias("highs"))
    # The least whole score s with near * p <= 100 * s; no product outgrows p.
    lows = F.expr(f"transform(highs, p -> p - {100 - near}L * (p div 100) - ({100 - near}L * (p % 100)) div 100)")
    asked = anchors.join(scores, F.col("id") == F.col("anchor_id")).select("id", "label", "dim", "x", lows.alias("lows"), "highs")
    bad = windows_best(trees, asked, False, negatives)
    bad = bad.select("query_id", "high", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    joined = good.join(bad, (F.col("anchor_id") == F.col("query_id")) & (F.col("positive_score") == F.col("high")))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has moved to the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE = f"""
WITH parts AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM parts a JOIN parts c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
good AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
ranked AS (
  SELECT g.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY g.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM good g JOIN pairs p ON p.anchor_id = g.anchor_id AND NOT p.same
    AND {NEAR} * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {NEGATIVES}
"""
