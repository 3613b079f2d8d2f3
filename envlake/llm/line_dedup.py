"""Boilerplate lines by their share of a site's pages.

A line is boilerplate on a site if it stands on more than ``max_ratio`` of the site's
pages and on ``min_pages`` of them at least. Pages with the same whole text count once, in
the line's pages and in the site's: copies of a page are no sign of boilerplate. Lines are
told apart after trimming spaces; empty lines never are boilerplate.

The lines of a site above the ratio are few (at most 1/max_ratio times the lines of its
average page), so they travel as one array per site, and texts are filtered where they
are: no text is taken apart and gathered again.

Null texts count as empty and become empty; null sites form a site of their own. Repeated
rows are the same page. An empty table gives an empty result. Other columns, of whatever
name, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm.tables import free_name, read_table, written

MAX_RATIO = 0.05
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(documents: DataFrame, site: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, line, pages, ratio) of every boilerplate line."""
    pages = documents.select(
        F.col(site).cast("string").alias("site"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("page"),
        _lines(F.col("text")).alias("lines"),
    )
    totals = pages.select("site", "page").distinct().groupBy("site").agg(F.count("*").alias("site_pages"))
    lines = pages.select("site", "page", F.explode(F.array_distinct(F.transform("lines", lambda line: F.trim(line)))).alias("line"))
    # Lines travel as a hash; texts are fetched for the few that are left.
    hashed = lines.filter("line <> ''").select("site", F.xxhash64("line").alias("line_hash"), "page")
    counted = hashed.distinct().groupBy("site", "line_hash").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    same_site = counted["site"].eqNullSafe(totals["site"])
    above = counted.join(totals, same_site).filter(F.col("pages") > F.col("site_pages") * max_ratio).select(
        counted["site"].alias("site"), "line_hash", "pages", (F.col("pages") / F.col("site_pages")).alias("ratio")
    )
    above = written(above, "line-dedup-above")
    # Every frequent line once, with its text.
    wanted = above.select("line_hash").distinct()
    texts = lines.filter("line <> ''").select("line", F.xxhash64("line").alias("line_hash"))
    named = texts.join(wanted, "line_hash", "left_semi").distinct()
    return above.join(named, "line_hash").select("site", "line", "pages", "ratio")


def _with_boilerplate(documents: DataFrame, site: str, max_ratio: float, min_pages: int) -> tuple[DataFrame, str]:
    """Documents beside an array of their site's boilerplate lines; the array's column name."""
    found = boilerplate(documents, site, max_ratio, min_pages).groupBy("site").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    taken = documents.columns
    key, array = free_name("boilerplate_site", taken), free_name("boilerplate_lines", taken)
    per_site = written(found.select(F.col("site").alias(key), F.col("lines").alias(array)), "line-dedup-sites")
    joined = documents.join(per_site, F.col(site).cast("string").eqNullSafe(F.col(key)), "left").drop(key)
    return joined, array


def _kept(text: Column, boilerplate_lines: Column) -> Column:
    return F.filter(_lines(text), lambda line: ~F.coalesce(F.array_contains(boilerplate_lines, F.trim(line)), F.lit(False)))


def drop_boilerplate(documents: DataFrame, site: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Documents with boilerplate lines cut out of their text; n_chars, where there, follows."""
    joined, array = _with_boilerplate(documents, site, max_ratio, min_pages)
    text = F.array_join(_kept(F.col("text"), F.col(array)), "\n")
    columns = []
    for name in documents.columns:
        if name == "text":
            columns.append(text.alias("text"))
        elif name == "n_chars":
            columns.append(F.length(text).cast(documents.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return joined.select(*columns)


def op4_site_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines dropped from all documents, their source as the site."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text", "source")
    joined, array = _with_boilerplate(documents, "source", MAX_RATIO, MIN_PAGES)
    kept = joined.select("doc_id", F.size(_lines(F.col("text"))).alias("n_lines"), _kept(F.col("text"), F.col(array)).alias("kept"))
    return kept.select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        (F.col("n_lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n").cast("binary"), 256).alias("text_sha256"),
    )


OP4_SQL = f"""
WITH pages AS (SELECT doc_id, source, coalesce(text, '') AS page, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(DISTINCT page) AS site_pages FROM pages GROUP BY source),
line_pages AS (SELECT DISTINCT source, page, trim(unnest(lines)) AS line FROM pages),
counted AS (SELECT source, line, count(*) AS pages FROM line_pages WHERE line <> '' GROUP BY source, line),
above AS (
  SELECT c.source, c.line FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.pages >= {MIN_PAGES} AND c.pages > t.site_pages * {MAX_RATIO}),
sites AS (SELECT source, list(line) AS drop_lines FROM above GROUP BY source),
kept AS (
  SELECT p.doc_id, p.lines,
         list_filter(p.lines, lambda x: NOT list_contains(coalesce(s.drop_lines, []), trim(x))) AS left_lines
  FROM pages p LEFT JOIN sites s ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - len(left_lines))::BIGINT AS n_dropped,
       sha256(array_to_string(left_lines, chr(10))) AS text_sha256
FROM kept
"""
