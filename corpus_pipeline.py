"""The corpus pipeline: raw documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the documents of the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.boilerplate import drop_boilerplate
from tidemark.llm.common import free, stored, table
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``labels``.

    Each row is judged by its own text, null texts as empty ones; ids may be null or repeated.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; ``n_chars`` follows the text.

    All rows and all other columns stay as they are, null texts stay null.
    """
    counts = (free("__n_lines", docs), free("__n_dropped", docs))
    found = drop_boilerplate(docs, counts=counts).select(*(F.col(f"`{c}`") for c in docs.columns))
    return found.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else found


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id.

    Rows whose id is null or repeated are documents of their own: they get numbers above all ids,
    so that a group with other ids keeps one of those. Texts without words have no copies.
    """
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    again = stored(again.select(F.col("doc_id").alias("of")), "repeated-ids")
    gone = free("__gone", docs)
    if again.isEmpty():
        copies = near_duplicates(docs, 5, 80).filter(~F.col("kept")).select(F.col("doc_id").alias(gone))
        return docs.join(stored(copies, "copies"), F.col("doc_id") == F.col(gone), "left_anti")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    top = rows.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    marked = rows.join(again.withColumn("again", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("of")), "left")
    number = F.when(F.col("again"), F.lit(top) + 1 + F.monotonically_increasing_id()).otherwise(F.col("doc_id"))
    rows = stored(marked.select("row", number.alias("doc_id"), "text"), "numbered")
    copies = near_duplicates(rows, 5, 80).filter(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    left = rows.join(stored(copies, "copies"), F.col("doc_id") == F.col("gone"), "left_anti")
    return left.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``; each row goes or stays by its own text."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences of 2048.

    Null texts are empty; rows with null or repeated ids have pieces each.
    """
    # The stages share their workers' memory, so this one remembers fewer words than it does alone.
    return pack(docs, memory_words=250_000)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dup", near_dup),
    ("decontaminate", benchmark),
    ("pack", packing),
]

#: The classifier and the tokenizer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
