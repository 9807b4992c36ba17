"""Line dedup by site-relative frequency.

Pages are grouped by host.  A line is boilerplate of a host if the share of the host's pages that contain it exceeds a
ratio, by so much that chance doesn't explain it on a host with so few pages; it is dropped from all pages of that host.
Counts are made by (host, line), so map-side aggregation shrinks a hot host or line before any shuffle.  A host's
boilerplate lines number less than 1/ratio times its mean of distinct lines a page, so they are gathered as one array of
hashes a host, whose size doesn't grow with the number of pages.  Everything runs as built-in Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm.common import BLANKS, join_checked, materialize, packed

#: A line goes if it is on more than this share of its host's pages: well above the share that a group of copied pages is
#: likely to have of its host, whose lines are no boilerplate ...
RATIO = 0.08
#: ... by so many standard deviations of a count with that share (a line on all of 3 pages goes, one on 2 of 7 stays) ...
DEVIATIONS = 3
#: ... and on at least this many pages.
LEAST_PAGES = 3


def line_key(line: Column) -> Column:
    """Lines are compared without blanks at their ends."""
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def boilerplate(pages: DataFrame, text: str, host: str, ratio: float = RATIO, deviations: float = DEVIATIONS, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): the hashes of the lines to drop, one row for each host that has any."""
    totals = pages.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("pages"))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    keys = F.explode(F.array_distinct(F.transform(lines, line_key)))
    counts = pages.select(F.col(host).alias("host"), keys.alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    over = F.col("n") - F.col("pages") * F.lit(float(ratio))
    found = counts.join(totals, counts.host.eqNullSafe(totals.host)).where((over > 0) & (over * over > F.col("pages") * F.lit(deviations**2 * ratio * (1 - ratio))))
    return found.groupBy(counts.host).agg(F.array_sort(F.collect_list("line")).alias("lines"))


def drop_lines(pages: DataFrame, text: str = "text", host: str = "source", **rule) -> DataFrame:
    """pages with text less its host's boilerplate lines, and fr_lines, fr_dropped: how many lines there were and went.

    Every row stays, also one that loses all lines (its text is then empty).  Null text stays null and has no lines;
    lines without a word are no boilerplate and stay.  Null host is a host of its own.  A page counts once for a line
    however often it repeats it; rows that repeat count as pages of their own.  Very long texts are read whole; an empty
    table gives an empty table.  rule: ratio, deviations, least_pages.
    """
    table = materialize(boilerplate(pages.select(text, host), text, host, **rule)).select(F.col("host").alias("fr_host"), F.col("lines").alias("fr_found"))
    rows = join_checked(pages, table, pages[host].eqNullSafe(F.col("fr_host")), size=F.size("fr_found"))
    lines = F.split(F.col(text), "\n")
    # of the host's lines those that the page has, by hashing; each line is then looked up among these few
    rows = rows.withColumn("fr_here", F.when(F.col("fr_found").isNotNull(), F.array_intersect(F.transform(lines, line_key), F.col("fr_found"))))
    kept = F.filter(lines, lambda x: (F.btrim(x, F.lit(BLANKS)) == "") | ~F.array_contains(F.col("fr_here"), line_key(x)))
    rows = rows.withColumn("fr_kept", F.when(F.coalesce(F.size("fr_here"), F.lit(0)) > 0, kept).otherwise(lines))
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    rows = rows.withColumn("fr_lines", F.when(F.col(text).isNull(), 0).otherwise(n(lines)).cast("long"))
    rows = rows.withColumn("fr_dropped", F.when(F.col(text).isNull(), 0).otherwise(F.col("fr_lines") - n(F.col("fr_kept"))).cast("long"))
    return rows.withColumn(text, F.array_join("fr_kept", "\n")).drop("fr_host", "fr_found", "fr_here", "fr_kept")


def clean_documents(docs: DataFrame) -> DataFrame:
    """docs without boilerplate lines, source as host, n_chars brought up to date.

    Every row stays; null texts and sources, repeated rows, very long texts and empty tables are as in drop_lines().
    """
    done = drop_lines(packed(docs, "text", "source"))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("fr_dropped") > 0, F.length("text")).otherwise(F.col("fr_row.n_chars")).cast("long")}
    return done.select(*(new.get(c, F.col(f"fr_row.`{c}`")).alias(c) for c in docs.columns))


def page_lines(html: Column) -> Column:
    """The text of an HTML page with a line for each block: comments, scripts and styles go, tags of blocks break lines."""
    t = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")
    t = F.regexp_replace(t, r"(?i)<(?!/?(?:a|b|i|em|strong|span)\b)[^>]*>", "\n")
    return F.btrim(F.regexp_replace(F.regexp_replace(t, "<[^>]*>", ""), r"[ \t\r]*\n\s*", "\n"), F.lit(BLANKS))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page.  Null html has no lines and a null hash; an url without a host, or none, is of one host ("" or null)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", host_of(F.col("url")).alias("host"), page_lines(F.col("html")).alias("text"))
    done = drop_lines(materialize(pages), "text", "host")  # lines are read twice, HTML only once
    return done.select("page_id", "host", F.col("fr_lines").alias("n_lines"), F.col("fr_dropped").alias("n_dropped"), F.sha2("text", 256).alias("text_sha256"))


#: The same result in DuckDB's SQL.  Rows are told apart by their place, as page_id may repeat or be null.
OP10_SQL = rf"""
WITH a AS (SELECT row_number() OVER () AS row, page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
             regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g') AS t FROM pages),
b AS (SELECT row, page_id, host, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?i)</?(?:a|b|i|em|strong|span)(?:[^A-Za-z0-9_>][^>]*)?>', '', 'g'), '<[^>]*>', chr(10), 'g'), '[ \t\r]*\n[ \t\n\x0B\f\r]*', chr(10), 'g'), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS text FROM a),
l AS (SELECT row, host, i, string_split(text, chr(10))[i] AS line FROM b, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i)),
k AS (SELECT row, host, i, line, regexp_replace(line, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS key FROM l),
p AS (SELECT host, count(*) AS pages FROM b GROUP BY host),
c AS (SELECT host, key, count(DISTINCT row) AS n FROM k WHERE key <> '' GROUP BY host, key),
o AS (SELECT c.host, key, n, pages, n - pages * {float(RATIO)}::DOUBLE AS over FROM c JOIN p ON c.host IS NOT DISTINCT FROM p.host),
bad AS (SELECT host, key FROM o WHERE n >= {LEAST_PAGES} AND over > 0 AND over * over > pages * {DEVIATIONS**2 * RATIO * (1 - RATIO)!r}::DOUBLE),
r AS (SELECT row, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(bad.key) AS BIGINT) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (bad.key IS NULL), '') AS text
      FROM k LEFT JOIN bad ON k.key = bad.key AND k.host IS NOT DISTINCT FROM bad.host GROUP BY ALL)
SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(r.text) AS text_sha256 FROM b LEFT JOIN r ON b.row = r.row
"""
