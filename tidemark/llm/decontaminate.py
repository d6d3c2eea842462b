"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive words: the words at its ones are hashed together, those at its
zeros may be anything. The two masks below hit every stretch of ``WINDOW`` words in which at most
two are substituted. Seeds of the benchmark are joined with those of the documents; a bitmap of
fixed size first drops the document seeds that certainly match none. A hit fixes how item and
document lie against each other, and the words around it are compared there one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free, mix64, slices, stored, table
from tidemark.llm.filters import FILTER_BITS, bitmap, id_filter, in_filter
from tidemark.llm.text_bytes import Hashes, utf8, words

#: Of so many aligned words in a row, this share must be equal.
WINDOW, SHARE = 13, 0.8
#: With these, any two of ``WINDOW`` words may differ and one seed still hits.
MASKS = ("11101011", "11001111")

_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text (lower case, without ASCII signs around them), and offsets."""
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string())))
    start, end, _ = words(data, offsets)
    plain = np.concatenate([[0], np.cumsum(~_MARK[data])])
    some = plain[end] > plain[start]
    start, end = start[some], end[some]
    if len(start):
        # The first byte that is no sign, and one past the last.
        at = np.flatnonzero(~_MARK[data])
        start, end = at[plain[start]], at[plain[end] - 1] + 1
    return Hashes(data).of(start, end), np.searchsorted(start, offsets)


def seeds(hashed: np.ndarray, offsets: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed hashes of all places where the mask lies within one text: hash, text, place in it."""
    n = len(hashed) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.full(n, int(mask, 2), np.uint64)
    for k, on in enumerate(mask):
        if on == "1":
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + n])
    owner = np.searchsorted(offsets, np.arange(n), side="right") - 1
    inside = np.arange(n) + len(mask) <= offsets[owner + 1]
    return value[inside], owner[inside], (np.arange(n) - offsets[owner])[inside]


def masks_for(lengths: list[int]) -> list[str]:
    """The masks, and whole items that are shorter than these."""
    least = min(map(len, MASKS))
    return [*MASKS, *("1" * n for n in sorted(set(lengths)) if 0 < n < least)]


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Longest accepted stretch of an item laid at word ``shift`` of a text: its first word, words, equal words.

    Each ``WINDOW`` words in a row of which ``SHARE`` are equal are accepted, and stretches of
    such windows run together; they are trimmed to equal words. An item with fewer words must be
    there with all of them. No accepted stretch: zeros.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    size = min(WINDOW, len(item))
    if not size or high - low < size:
        return 0, 0, 0
    equal = doc[shift + low : shift + high] == item[low:high]
    sums = np.concatenate([[0], np.cumsum(equal)])
    needed = int(np.ceil(SHARE * size)) if size == WINDOW else size
    good = np.flatnonzero(sums[size:] - sums[:-size] >= needed)
    if not len(good):
        return 0, 0, 0
    best = (0, 0, 0)
    for run in np.split(good, np.flatnonzero(np.diff(good) > size) + 1):
        at = np.flatnonzero(equal[run[0] : run[-1] + size]) + run[0]
        best = max(best, (int(at[-1] - at[0] + 1), int(sums[at[-1] + 1] - sums[at[0]]), -int(at[0])))
    return shift + low - best[2], best[0], best[1]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of texts and items that overlap: ``text_key``, ``item_id``, ``first_word``, ``n_words``, ``n_equal``.

    ``text_key`` is the 64-bit hash of a text, so equal texts are looked at once. Null and empty
    texts and items overlap with nothing. Items with equal ids but different texts are different
    items. The longest overlap of a pair is given, the earliest among equals.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    items = items.withColumn("item", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashed, offsets = word_hashes(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashed.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), lists], ["item", "item_id", "words"])

    known = stored(items.mapInArrow(tokens, "item long, item_id long, words array<long>"), "items")
    short = known.select(F.size("words").alias("n")).filter(F.col("n") < WINDOW).distinct().collect()  # fewer than WINDOW rows
    masks = masks_for([r.n for r in short])

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("words")
            hashed = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)
            for mask in masks:
                value, owner, place = seeds(hashed, offsets, mask)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(batch.column("item").to_numpy()[owner]), pa.array(place)], ["seed", "item", "at"])

    test = stored(known.mapInArrow(item_seeds, "seed long, item long, at long"), "seeds")
    bits = bitmap(test.select(F.expr(f"seed & {FILTER_BITS - 1}").alias("bit")), "bit")
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null").withColumn("text_key", F.xxhash64("text"))

    def doc_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashed, offsets = word_hashes(batch.column("text"))
            for mask in masks:
                value, owner, place = seeds(hashed, offsets, mask)
                bit = (value & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                hit = (shared.value[bit >> 6] >> (bit & 63) & 1).astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array(batch.column("text_key").to_numpy()[owner[hit]]), pa.array(value[hit].view(np.int64)), pa.array(place[hit])], ["text_key", "seed", "place"])

    hits = texts.mapInArrow(doc_seeds, "text_key long, seed long, place long")
    lies = hits.join(test, "seed").select("text_key", "item", (F.col("place") - F.col("at")).alias("shift")).distinct()
    lies = stored(lies.groupBy("text_key", "item").agg(F.collect_list("shift").alias("shifts")), "hits")

    wanted = lies.join(known, "item").groupBy("text_key").agg(F.collect_list(F.struct("item_id", "words", "shifts")).alias("items"))
    able = in_filter(texts.select("text_key", "text"), "text_key", id_filter(lies, "text_key"))
    once = able.groupBy("text_key").agg(F.min("text").alias("text"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashed, offsets = word_hashes(batch.column("text"))
            rows = []
            for i, (key, found) in enumerate(zip(batch.column("text_key").to_pylist(), batch.column("items").to_pylist())):
                doc = hashed[offsets[i] : offsets[i + 1]]
                for item in found:
                    own = np.array(item["words"], np.int64).view(np.uint64)
                    first, n, equal = max((overlap(doc, own, s) for s in item["shifts"]), key=lambda o: (o[1], o[2], -o[0]))
                    if n:
                        rows.append((key, item["item_id"], first, n, equal))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["text_key", "item_id", "first_word", "n_words", "n_equal"])

    kinds = "text_key long, item_id long, first_word long, n_words long, n_equal long"
    return stored(once.join(wanted, "text_key").mapInArrow(verify, kinds), "overlaps")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text overlaps with no benchmark item; all columns stay."""
    own, key = free("__text_key", docs), free("__key", docs)
    keys = stored(contaminated(docs, benchmark).select(F.col("text_key").alias(key)).distinct(), "overlapping")
    rows = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    return rows.join(keys, F.col(own) == F.col(key), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that overlap with benchmark items, and with which."""
    docs = table(spark, sf_dir, "documents")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    ids = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    return ids.join(found, "text_key").select("doc_id", "item_id", "first_word", "n_words", "n_equal")
