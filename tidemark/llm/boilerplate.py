"""Drop lines that a large share of a site's pages repeat (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free, stored, table

#: A line goes if more than this share of its host's different pages have it, and at least so many of them.
RATIO, LEAST_PAGES = 0.01, 3


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def boilerplate(docs: DataFrame, host: Column, text: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per host with such lines: ``__host`` and ``__lines``, the md5 sums of its boilerplate lines.

    Pages of a host with equal texts count once, so what copies repeat is no boilerplate for that.
    A page counts a line once. Pages are told apart by a hash of their text; lines are first
    reduced to different (host, line, page) rows, dealt by all three, then counted before rows are
    shuffled, which keeps hot hosts and lines small. A host has at most (mean number of lines of a
    page / ``ratio``) boilerplate lines.
    """
    page = F.xxhash64(text).alias("__page")
    pages = docs.filter(text.isNotNull()).select(host.alias("__host"), page).distinct().groupBy("__host").agg(F.count(F.lit(1)).alias("__pages"))
    lines = F.array_distinct(F.filter(F.split(text, "\n", -1), lambda line: line != ""))
    each = docs.select(host.alias("__host"), page, F.explode(lines).alias("__line")).select("__host", "__page", _key(F.col("__line")).alias("__key"))
    counts = each.distinct().groupBy("__host", "__key").agg(F.count(F.lit(1)).alias("__with"))
    often = counts.filter(F.col("__with") >= least_pages).join(pages, "__host").filter(F.col("__with") > ratio * F.col("__pages"))
    return often.groupBy("__host").agg(F.sort_array(F.collect_set("__key")).alias("__lines"))


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The rows with boilerplate lines taken out of their text, and ``n_lines`` and ``n_dropped``.

    All columns and rows stay; columns of those two names (``counts`` renames them) are replaced. Each row is a page, also
    if its id is repeated; pages of a host with equal texts count as one. Null hosts form one site. Lines are compared as they are; empty lines
    are never dropped. A null text stays null and has no lines, an empty one has one (empty) line.
    A text of boilerplate only becomes empty.
    """
    host, text = F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`").cast("string")
    # Written first: its size is then known when the join is planned, small tables are broadcast.
    known = stored(boilerplate(docs, host, text, ratio, least_pages), "boilerplate")
    site, of, gone, left = (free(n, docs) for n in ("__site", "__host", "__lines", "__kept"))
    known = known.select(F.col("__host").alias(of), F.col("__lines").alias(gone))
    rows = docs.withColumn(site, host).join(known, F.col(site) == F.col(of), "left")
    lines = F.split(text, "\n", -1)
    kept = F.when(F.col(gone).isNull(), lines).otherwise(F.filter(lines, lambda line: ~F.array_contains(F.col(gone), _key(line))))
    rows = rows.withColumn(left, kept)
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(text.isNull(), 0).otherwise(F.size(left)).cast("long")
    return rows.select(
        *(F.array_join(left, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in counts),
        n_lines.alias(counts[0]),
        (n_lines - n_kept).alias(counts[1]),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that more than a hundredth of their source's different texts have."""
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


ORACLE = f"""
WITH texts AS (SELECT DISTINCT coalesce(source, '') AS host, text FROM documents WHERE text IS NOT NULL),
pages AS (SELECT host, count(*) AS n FROM texts GROUP BY 1),
each_line AS (
  SELECT host, unnest(list_distinct(list_filter(string_split(text, chr(10)), lambda x: x <> ''))) AS line FROM texts),
often AS (
  SELECT c.host, list(c.line) AS lines
  FROM (SELECT host, line, count(*) AS n FROM each_line GROUP BY 1, 2) c JOIN pages p ON p.host = c.host
  WHERE c.n >= {LEAST_PAGES} AND c.n > CAST({RATIO} AS DOUBLE) * p.n GROUP BY c.host),
cut AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines,
         list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(o.lines, CAST([] AS VARCHAR[])), x)) AS kept
  FROM documents d LEFT JOIN often o ON o.host = coalesce(d.source, ''))
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text
FROM cut
"""
