"""Line dedup by site-relative frequency.

The lines of a page count once per page and host. A line that more than a
given share of its host's pages have is boilerplate there and is dropped from
them. Counting shuffles hashes of lines, combined before the shuffle, so a
line on very many pages is no hot key. A host has at most (mean lines per
page / ratio) boilerplate lines, however many pages it has: that list is what
meets the pages again, and the text itself is not shuffled where all lists
together are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm.names import free_names
from caremart.sources.tables import staged

#: A line is boilerplate on a host if more than this share of its pages ...
MAX_RATIO = 0.1
#: ... and at least so many pages have it.
MIN_PAGES = 5


def _key(line: Column) -> Column:
    """A line's 64-bit hash, without the white space around it; null if blank."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate_lines(docs: DataFrame, text: str = "text", host: str = "source",
                      max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """``(host, lines)``: the hashes of each host's boilerplate lines.

    Every row is a page; without ``copies``, rows of a host with the same
    lines are one page (blank lines and white space around lines aside), so a
    text is no boilerplate for being there several times. Blank lines are never boilerplate. Null is a host of
    its own; a null text is a page without lines.
    """
    pages = docs.select(docs[host].alias("host"), docs[text].alias("text"))
    keys = F.transform(F.split("text", "\n"), _key)
    if copies:
        pages = pages.select("host", F.array_distinct(keys).alias("keys"))
    else:
        pages = pages.select("host", F.filter(keys, lambda x: x.isNotNull()).alias("keys"))
        pages = pages.groupBy("host", F.xxhash64("keys").alias("h1"), F.xxhash64(F.lit(1), "keys").alias("h2")).agg(
            F.array_distinct(F.first("keys")).alias("keys")
        )
        pages = staged(pages.select("host", "keys"), "distinct-pages")
    lines = pages.select("host", F.explode("keys").alias("line")).where("line is not null")
    totals = staged(
        pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "host-pages"
    ).withColumnRenamed("host", "of")
    found = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    found = found.join(totals, F.col("host").eqNullSafe(F.col("of")))
    found = found.where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
    return staged(found.groupBy("host").agg(F.collect_list("line").alias("lines")), "boilerplate")


def with_kept_lines(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO,
                    min_pages: int = MIN_PAGES, copies: bool = True) -> tuple[DataFrame, str, str]:
    """``docs`` with its lines, and those that stay, as arrays in two further columns, whose names are given too.

    Both are null where the text is null; an empty text has one empty line.
    Other lines stay in order, repeated or not. The new names are none of the
    table's, whatever it calls its columns.
    """
    of, drop, lines, kept = free_names(docs, "host", "drop", "lines", "kept")
    found = boilerplate_lines(docs, text, host, max_ratio, min_pages, copies)
    found = found.select(F.col("host").alias(of), F.col("lines").alias(drop))
    joined = docs.join(found, docs[host].eqNullSafe(F.col(of)), "left")
    stays = F.when(F.col(drop).isNull(), F.col(lines)).otherwise(
        F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(drop), _key(x)), F.lit(False)))
    )
    return joined.withColumn(lines, F.split(docs[text], "\n")).withColumn(kept, stays).drop(of, drop), lines, kept


def drop_boilerplate(docs: DataFrame, text: str = "text", host: str = "source",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text; all rows stay.

    ``n_chars``, where there is such a column, is counted anew.
    """
    with_lines, _, kept = with_kept_lines(docs, text, host, max_ratio, min_pages, copies)
    clean = F.array_join(kept, "\n")
    new = {text: clean}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(clean).cast(docs.schema["n_chars"].dataType)
    return with_lines.withColumns(new).select(*docs.columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, judged by its source as the host."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    with_lines, lines, kept = with_kept_lines(docs)
    clean = F.coalesce(F.array_join(kept, "\n"), F.lit(""))
    return with_lines.select(
        "doc_id",
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long").alias("n_dropped"),
        F.length(clean).cast("long").alias("n_kept_chars"),
        F.sha2(clean, 256).alias("kept_sha256"),
    )


OP10_SQL = r"""
WITH pages AS (SELECT row_number() OVER () AS row, doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
placed AS (
  SELECT row, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM pages),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM placed),
counted AS (
  SELECT source, key, count(DISTINCT row) AS n FROM bare WHERE key <> '' GROUP BY source, key),
found AS (
  SELECT c.source, c.key FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= 5 AND c.n > CAST(0.1 AS DOUBLE) * t.pages),
kept AS (
  SELECT b.row, string_agg(b.line, chr(10) ORDER BY b.place) AS text, count(*) AS n
  FROM bare b LEFT JOIN found f ON b.key = f.key AND b.source IS NOT DISTINCT FROM f.source
  WHERE f.key IS NULL GROUP BY b.row)
SELECT p.doc_id, CAST(coalesce(len(p.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(p.lines), 0) - coalesce(k.n, 0) AS BIGINT) AS n_dropped,
       CAST(length(coalesce(k.text, '')) AS BIGINT) AS n_kept_chars,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM pages p LEFT JOIN kept k USING (row)
"""
