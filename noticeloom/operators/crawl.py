"""What a crawl brought: yield per page, where a source ended, which rows count."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..sources.pages import OK_STATUS, cap_of
from .scaling import join_dimension, running_total

REASONS = ("status", "empty", "no_new", "gap", "cap")


def page_yield(rows: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(source, page_no, parsed, new_rows, total) from rows (source, page_no, id).

    A row is new when no earlier page of its source has the id; repeats on one page all count.
    `total` is the running number of distinct ids. With `pages`, pages without rows appear too.
    """
    per_page = rows.groupBy("source", "page_no", "id").agg(F.count("*").alias("_rows"))
    firsts = per_page.groupBy("source", "id").agg(
        F.min("page_no").alias("page_no"), F.min_by("_rows", "page_no").alias("_rows")
    )
    parsed = per_page.groupBy("source", "page_no").agg(F.sum("_rows").alias("parsed"))
    fresh = firsts.groupBy("source", "page_no").agg(
        F.sum("_rows").alias("new_rows"), F.count("*").alias("_ids")
    )
    known = parsed
    if pages is not None:
        known = pages.select("source", "page_no").distinct().join(
            parsed, ["source", "page_no"], "left"
        )
    counted = known.join(fresh, ["source", "page_no"], "left").fillna(
        0, ["parsed", "new_rows", "_ids"]
    )
    return running_total(counted, ["source"], "page_no", "_ids", "total").drop("_ids")


def stop_pages(
    pages: DataFrame, yields: DataFrame, caps: int | Mapping[str, int] | None = None
) -> DataFrame:
    """(source, stop_page, stop_reason, crawl_complete): the first page that ends a crawl.

    A page ends it by its status (a missing status is no answer either), by having no rows, by
    bringing nothing new, or by missing; a cap ends it only where the caller gives one. The crawl is
    complete when nothing new came, or when a page after the first was empty.
    """
    page = pages.select("source", "page_no", "status")
    seen = page.join(yields, ["source", "page_no"], "left")
    rank = (
        F.when(~F.col("status").eqNullSafe(F.lit(OK_STATUS)), 0)
        .when(F.coalesce("parsed", F.lit(0)) == 0, 1)
        .when(F.col("new_rows") == 0, 2)
    )
    # Page and reason in one number, so that the smallest per source is the stop.
    size = F.lit(8)
    ends = seen.select("source", (F.col("page_no") * size + rank).alias("code"))
    following = page.select("source", (F.col("page_no") + 1).alias("page_no"))
    first = page.select("source", F.lit(1).alias("page_no")).distinct()
    gaps = (
        following.unionByName(first).distinct()
        .join(page, ["source", "page_no"], "left_anti")
        .select("source", (F.col("page_no") * size + 3).alias("code"))
    )
    found = ends.unionByName(gaps)
    if caps is not None:
        cap = cap_of(F.col("source"), caps)
        found = found.unionByName(page.select("source", (cap * size + 4).alias("code")).distinct())
    stops = found.groupBy("source").agg(F.min("code").alias("code"))
    reason = F.element_at(F.array(*[F.lit(r) for r in REASONS]), (F.col("code") % 8 + 1).cast("int"))
    stop_page = F.floor(F.col("code") / 8).cast("int")
    complete = (reason == "no_new") | ((reason == "empty") & (stop_page > 1))
    return stops.select(
        "source", stop_page.alias("stop_page"), reason.alias("stop_reason"),
        complete.alias("crawl_complete"),
    )


def kept_rows(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """Rows up to and including the stop page of their source."""
    bound = stops.select("source", "stop_page")
    joined = join_dimension(rows, bound, ["source"], ["id"], "inner")
    return joined.filter(F.col("page_no") <= F.col("stop_page")).drop("stop_page")
