"""Near-duplicate groups by MinHash, with sequential Bayesian verification.

1. Each text becomes the set of its hashed word shingles, a fingerprint of the set and a MinHash
   signature. Texts with equal sets form a class; one of each class goes on.
2. Signatures are cut into bands. Texts with an equal band share a bucket; texts joined by
   buckets, over any number of steps, form a cluster. Only narrow rows are shuffled for this.
3. A cluster's texts meet in one task, each once. There, texts that share a bucket
   are compared, the most central text first and only while they are not connected yet: batch by
   batch of their signatures, a pair is given up when the posterior probability that its
   similarity reaches the threshold falls below ``MISS``; the pairs that survive all batches are
   compared by their full sets.
4. A cluster above ``CLUSTER_ROWS`` texts (or ``CLUSTER_SHINGLES`` shingles) is split into blocks
   that each also get the cluster's most central texts. What is not connected to the cluster's
   largest group after that visits the other blocks with which it shares a bucket, so each pair
   in a bucket is still compared unless it is connected already.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, segment_ids, slices, stored, table
from tidemark.llm.components import components
from tidemark.llm.filters import id_filter, in_filter
from tidemark.llm.text_bytes import LOWER, Hashes, utf8, words

#: Bands of five hashes: a pair of similarity 0.85 (0.8) shares none with probability 1e-7 (3e-5) with 26 bands.
BANDS, BAND_ROWS = 26, 5
HASHES = BANDS * BAND_ROWS
#: Hashes compared at a time, and the probability at which a pair is given up.
BATCH, MISS = 26, 1e-7
#: Bytes of text that a task works on at a time.
SLICE = 2 << 20
CLUSTER_ROWS, CLUSTER_SHINGLES, CENTRES = 1_024, 500_000, 4

_rng = np.random.Generator(np.random.PCG64(20_240_229))
_FACTORS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of each text's different word shingles, one text after the other, and offsets.

    Words are lower-cased (A-Z) and separated by ASCII white space. Fewer words than ``size`` form
    one shingle; no word, none.
    """
    data, offsets = utf8(column)
    data = LOWER[data]
    start, end, first = words(data, offsets)
    word, count = Hashes(data).of(start, end), np.diff(first)
    shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    owner = segment_ids(np.concatenate([[0], np.cumsum(shingles)]))
    at = first[owner] + np.arange(len(owner)) - np.concatenate([[0], np.cumsum(shingles)])[owner]
    hashed = np.zeros(len(owner), np.uint64)
    for k in range(size):
        there = k < count[owner]
        part = word[np.where(there, at + k, 0)] if len(word) else hashed
        hashed = np.where(there, mix64(hashed * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k)), hashed)
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[new], np.searchsorted(owner[new], np.arange(len(count) + 1))


def signatures(hashed: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash signatures (32 bits a hash) of the sets that are not empty."""
    full = offsets[:-1][np.diff(offsets) > 0]
    found = np.zeros((len(full), HASHES), np.uint32)
    if len(full):
        for k in range(HASHES):
            found[:, k] = np.minimum.reduceat(hashed * _FACTORS[k] + _SHIFTS[k], full) >> np.uint64(32)
    return found


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(BAND_ROWS):
        key = mix64(key + parts[:, :, k])
    return key.view(np.int64)


def least_agreement(threshold: float, miss: float = MISS) -> dict[int, int]:
    """After so many hashes, the fewest equal ones with which a pair goes on.

    With a uniform prior, the posterior of the similarity after ``m`` of ``n`` equal hashes is
    Beta(m + 1, n - m + 1); its mass above the threshold is a binomial sum.
    """
    found = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, 0
        while m <= n:
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if mass >= miss:
                break
            m += 1
        found[n] = m
    return found


class Group:
    """Texts that meet in one task: their signatures, sets, and who is connected to whom."""

    def __init__(self, signature: np.ndarray, sets: list[np.ndarray], label: np.ndarray, percent: int) -> None:
        self.signature, self.sets, self.label, self.percent = signature, sets, label, percent
        self.size = np.array([len(s) for s in sets])
        self.keys = band_keys(signature)
        self.least = least_agreement(percent / 100)

    def connect(self, visitors: np.ndarray | None = None) -> None:
        """Make ``label`` equal for linked texts; with ``visitors``, only pairs with one of them count."""
        label, order = self.label, np.arange(len(self.sets))
        if len(order) > 2:
            shared = np.zeros(len(order), np.int64)
            for band in self.keys.T:
                _, inverse, count = np.unique(band, return_inverse=True, return_counts=True)
                shared += count[inverse]
            order = np.argsort(-shared, kind="stable")
        for i in order:
            other = label != label[i]
            if visitors is not None and not visitors[i]:
                other &= visitors
            near = np.flatnonzero(other)
            if not len(near):
                continue
            small, large = np.minimum(self.size[near], self.size[i]), np.maximum(self.size[near], self.size[i])
            near = near[100 * small >= self.percent * large]
            near = near[(self.keys[near] == self.keys[i]).any(axis=1)]
            agree = np.zeros(len(near), np.int64)
            for n, least in self.least.items():
                agree += (self.signature[near, n - BATCH : n] == self.signature[i, n - BATCH : n]).sum(axis=1)
                near, agree = near[agree >= least], agree[agree >= least]
            for j in near[np.argsort(-agree, kind="stable")]:
                if label[j] != label[i] and self._similar(i, j):
                    label[label == max(label[i], label[j])] = min(label[i], label[j])

    def _similar(self, i: int, j: int) -> bool:
        a, b = (self.sets[i], self.sets[j]) if self.size[i] <= self.size[j] else (self.sets[j], self.sets[i])
        at = np.searchsorted(b, a)
        both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """Per row: its id, size of its set, fingerprint and band keys (null for an empty set)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            hashed, offsets = shingle_sets(batch.column("text"), size)
            count = np.diff(offsets)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashed + np.uint64(k)))]) for k in (1, 2)]
            prints = [(s[offsets[1:]] - s[offsets[:-1]]).view(np.int64) for s in sums]
            rows = iter(band_keys(signatures(hashed, offsets)))
            keys = [next(rows).tobytes() if c else None for c in count]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), *map(pa.array, prints), pa.array(keys, pa.binary())],
                ["doc_id", "n_shingles", "print1", "print2", "bands"],
            )

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, print1 long, print2 long, bands binary")


def _bands(nodes: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
                node = np.repeat(batch.column("node").to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(keys)], ["node", "key"])

    return nodes.select("node", "bands").mapInArrow(cut, "node long, key long")


def _in_groups(rows: DataFrame, keys: list[str], work: Callable, kinds: str) -> DataFrame:
    """Bring rows of equal keys together and call ``work`` with the columns of each group.

    Groups are walked one after the other while the sorted partition streams by.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(work(group), schema=out)

        out = pa.schema([(c.split()[0], pa.int64()) for c in kinds.split(", ")])
        group, key = [], None
        for batch in batches:
            for row in batch.to_pylist():
                own = tuple(row[k] for k in keys)
                if own != key and group:
                    yield done(group)
                    group = []
                key = own
                group.append(row)
        if group:
            yield done(group)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(walk, kinds)


def _group(rows: list[dict], label: np.ndarray, size: int, percent: int) -> Group:
    hashed, offsets = shingle_sets(pa.array([r["text"] for r in rows], pa.string()), size)
    return Group(signatures(hashed, offsets), [hashed[a:b] for a, b in zip(offsets[:-1], offsets[1:])], label, percent)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked if the sets of their ``size``-word shingles have a Jaccard similarity of at
    least ``percent`` / 100; ``component_id`` is the smallest id reachable over links. Texts
    without words, and null texts, are linked with nothing. Equal texts are one node, named
    after their smallest id, and different texts of the same name count as one document for
    linking; so where rows repeat an id with different texts, each row has the component of its
    text, and these may differ. Rows with a null id are linked with nothing, have no component and are kept.
    An empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = stored(_sketches(source, size), "sketches")
    known = sketches.filter("doc_id is not null and n_shingles > 0")
    prints = ["print1", "print2", "n_shingles"]
    classes = stored(known.groupBy(*prints).agg(F.min("doc_id").alias("node")), "classes")
    firsts = known.join(classes, prints).filter("doc_id = node").select("node", "n_shingles", "bands")
    members = _linked(source, stored(firsts, "first-texts"), size, percent)

    of = classes.join(members, "node", "left").select(*prints, F.coalesce("label", "node").alias("component_id"))
    rows = sketches.drop("bands").join(of, prints, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    found = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def _linked(source: DataFrame, firsts: DataFrame, size: int, percent: int) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of nodes linked with smaller ones."""
    bands = stored(_bands(firsts), "bands")
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).filter("n > 1")
    # Written first: the join then shuffles both sides anew, and AQE can split a hot bucket.
    shared = stored(bands.join(stored(buckets, "bucket-sizes"), "key"), "buckets")
    clusters = components(shared.select(F.col("node").alias("a"), F.col("centre").alias("b")))
    central = shared.groupBy("node").agg(F.sum("n").alias("shared"))
    nodes = firsts.drop("bands").dropDuplicates(["node"]).join(clusters, "node").join(central, "node").withColumnRenamed("component", "cluster")
    totals = nodes.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("rows") / CLUSTER_ROWS, F.col("shingles") / CLUSTER_SHINGLES))
    nodes = stored(nodes.join(totals.select("cluster", blocks.alias("blocks")), "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "nodes")

    # The most central texts of a split cluster go to all its blocks: first the best of each block, then of these.
    order = [F.col("shared").desc(), "node"]
    best = nodes.filter("blocks > 1").withColumn("nth", F.row_number().over(Window.partitionBy("cluster", "block").orderBy(*order))).filter(F.col("nth") <= CENTRES)
    best = best.withColumn("nth", F.row_number().over(Window.partitionBy("cluster").orderBy(*order))).filter(F.col("nth") <= CENTRES)
    guests = best.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("to <> block")
    placed = nodes.select("cluster", "block", "blocks", "node").union(guests.select("cluster", "to", "blocks", "node"))
    # Texts move to their groups, where sets and signatures are made again: a text is shorter than these.
    able = in_filter(source, "doc_id", id_filter(nodes, "node")).withColumnRenamed("doc_id", "node")

    def first(rows: list[dict]) -> list[dict]:
        label = np.array([r["node"] for r in rows])
        group = _group(rows, label.copy(), size, percent)
        group.connect()
        split = int(rows[0]["blocks"] > 1)
        return [{"a": int(n), "b": int(g), "split": split} for n, g in zip(label, group.label) if n != g]

    links = stored(_in_groups(placed.join(able, "node"), ["cluster", "block"], first, "a long, b long, split long"), "links")
    done = links.filter("split = 0").select(F.col("a").alias("node"), F.col("b").alias("label"))
    if nodes.filter("blocks > 1").isEmpty():
        return done
    some = components(links.filter("split = 1")).withColumnRenamed("component", "label")

    # What is not in the largest group of its cluster visits the blocks it shares a bucket with.
    split = nodes.filter("blocks > 1").select("cluster", "block", "node")
    state = stored(split.join(some, "node", "left").select("cluster", "block", "node", F.coalesce("label", "node").alias("label")), "state")
    sizes = state.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    rest = state.join(largest, "cluster").filter("label <> main").select("cluster", "block", "node", "label")
    where = shared.select("key", "node").join(state.select("node", "block"), "node").select("key", F.col("block").alias("to")).distinct()
    visits = rest.join(shared.select("key", "node"), "node").join(where, "key").select("cluster", F.col("to").alias("block"), "node", "label").distinct()
    visits = visits.join(state.select("block", "node"), ["block", "node"], "left_anti").withColumn("visits", F.lit(1).cast("long"))
    hosts = state.join(visits.select("cluster", "block").distinct(), ["cluster", "block"], "left_semi").withColumn("visits", F.lit(0).cast("long"))
    meeting = hosts.select("cluster", "block", "node", "label", "visits").union(visits.select("cluster", "block", "node", "label", "visits"))

    def second(rows: list[dict]) -> list[dict]:
        label = np.array([r["label"] for r in rows])
        group = _group(rows, label.copy(), size, percent)
        group.connect(np.array([bool(r["visits"]) for r in rows]))
        return [{"a": a, "b": b} for a, b in {(int(n), int(g)) for n, g in zip(label, group.label) if n != g}]

    more = components(stored(_in_groups(meeting.join(able, "node"), ["cluster", "block"], second, "a long, b long"), "late-links"))
    last = more.select(F.col("node").alias("label"), "component")
    moved = state.join(last, "label", "left").select("node", F.coalesce("component", "label").alias("label"))
    return done.union(moved.filter("node <> label"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their groups of near copies: three-word shingles, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85)
