"""Line dedup by site-relative frequency: lines on too large a share of a site's pages are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, join_dimension, numbered, whole

# A line is boilerplate on more than this share of the site's pages, and on this many at least.
RATIO_PERCENT = 5
LEAST_PAGES = 5
TRIM = " \t\r\x0b\x0c"


def line_key(line: Column) -> Column:
    """64-bit key of a line without the white space around it."""
    return F.xxhash64(F.btrim(line, F.lit(TRIM)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(TRIM)) != ""


def boilerplate(df: DataFrame, host: str, text: str, percent: int = RATIO_PERCENT, least: int = LEAST_PAGES) -> DataFrame:
    """(_site, _lines): per site the keys of its boilerplate lines.

    Each page counts a line once. Counting is pre-aggregated, so a line on a third of all pages is one
    row per task. A site can have at most (lines per page) / ratio such lines, so a list is short.
    """
    pages = df.select(
        _site(host).alias("_site"),
        F.array_distinct(F.transform(F.filter(_lines(whole(text)), _has_word), line_key)).alias("_keys"),
    )
    totals = pages.groupBy("_site").agg(F.count("*").alias("_pages"))
    counts = (
        pages.select("_site", F.explode("_keys").alias("_line")).groupBy("_site", "_line")
        .agg(F.count("*").alias("_on")).filter(F.col("_on") >= least)
    )
    often = counts.join(totals, "_site").filter(F.col("_on") * 100 > F.col("_pages") * percent)
    return often.groupBy("_site").agg(F.collect_list("_line").alias("_lines"))


def _site(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))


def drop_site_lines(
    df: DataFrame, host: str = "source", text: str = "text", percent: int = RATIO_PERCENT,
    least: int = LEAST_PAGES, counts: tuple[str, str] | None = None,
) -> DataFrame:
    """`df` with the boilerplate lines of each site taken out of `text`.

    A line is compared without white space around it; lines without words are never counted or
    dropped, nor is a line on fewer than `least` pages of its site, whatever their share. Null texts
    stay null and count as pages without lines; a null host is a site of its own; a page whose lines
    all go keeps an empty text. Repeated rows count as pages each. No rows: no rows. `counts` names
    two columns to add: lines of the page, and lines dropped. Texts are not shuffled as long as few
    sites have boilerplate; beyond that they are joined by site and salt. Columns may have any name; those
    that `counts` names are replaced.
    """
    rows, names = numbered(df)
    at, of = names[text], names[host]
    flagged = cut_lineage(boilerplate(rows, of, at, percent, least))
    joined = join_dimension(rows.withColumn("_site", _site(of)), flagged, ["_site"], [at])
    lines = _lines(F.col(at).cast("string"))
    kept = F.filter(lines, lambda x: ~(_has_word(x) & F.array_contains(F.col("_lines"), line_key(x))))
    marked = joined.withColumn("_kept", F.when(F.col("_lines").isNull(), lines).otherwise(kept))
    out = {c: F.col(n) for c, n in names.items()}
    if counts:
        zero = F.lit(0).cast("bigint")
        out |= {
            counts[0]: F.when(F.col(at).isNull(), zero).otherwise(F.size(lines).cast("bigint")),
            counts[1]: F.when(F.col(at).isNull(), zero).otherwise((F.size(lines) - F.size("_kept")).cast("bigint")),
        }
    out[text] = F.array_join("_kept", "\n")
    return marked.select(*[c.alias(name) for name, c in out.items()])
