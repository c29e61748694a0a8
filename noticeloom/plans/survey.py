"""The stages of a survey put together: crawl, details, re-survey."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.boards import extract_all
from ..operators.crawl import kept_rows, page_yield, stop_pages
from ..operators.dedup import dedup_last
from ..operators.diff import (
    carry_verdicts, confirm_closed, lost_opportunities, recheck_queue, snapshot_diff,
)
from ..schemas import KEY
from ..session import cut_lineage
from ..sources.pages import page_cap


@dataclass(frozen=True)
class Crawl:
    announcements: DataFrame
    yields: DataFrame
    stops: DataFrame


def collect(pages: DataFrame, caps: int | Mapping[str, int] | None = None) -> Crawl:
    """Announcements of one run out of its list pages, and how complete each source is.

    All stored pages are read unless `caps` gives a last page, for all sources or by source. Pages of
    several runs are refused. Records, yields and stops are each computed once and kept as tables;
    yields and stops have a row per page and per source.
    """
    if "run_id" in pages.columns:
        runs = pages.select("run_id").distinct().limit(2).count()
        if runs > 1:
            raise ValueError("the pages are of several runs: filter one run_id")
    capped = pages if caps is None else page_cap(pages, caps)
    # Pages are parsed once: the records are kept as files, the markup is not read again.
    rows = cut_lineage(extract_all(capped))
    known = cut_lineage(capped.select("source", "page_no", "status"))
    yields = cut_lineage(page_yield(rows, known))
    stops = cut_lineage(stop_pages(known, yields, caps))
    found = dedup_last(kept_rows(rows, stops), KEY, ["page_no", "pos"])
    return Crawl(found, yields, stops)


@dataclass(frozen=True)
class Resurvey:
    diff: DataFrame
    carried: DataFrame
    recheck: DataFrame
    lost: DataFrame


def resurvey(
    prev: DataFrame, curr: DataFrame, verdicts: DataFrame, stops: DataFrame | None = None
) -> Resurvey:
    """What changed since the previous run, and what that means for its verdicts.

    prev and curr have a column first_pos for their order, as `collect` gives it.
    """
    diff = snapshot_diff(prev, curr, ["first_pos"])
    if stops is not None:
        diff = confirm_closed(diff, stops)
    return Resurvey(
        diff, carry_verdicts(diff, verdicts), recheck_queue(diff, verdicts),
        lost_opportunities(diff, verdicts),
    )


def store_run(announcements: DataFrame, run_id: str, path: str) -> None:
    """Keep a run as Parquet below run_id=..., sorted so that later runs read narrow ranges.

    Storing a run again replaces it and leaves other runs as they are.
    """
    (
        announcements.withColumn("run_id", F.lit(run_id))
        .repartition(*KEY).sortWithinPartitions(*KEY)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id").parquet(path)
    )


def load_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The announcements of a stored run."""
    return stored_runs(spark, path).filter(F.col("run_id") == run_id).drop("run_id")


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """All stored runs with their run_id as text; a filter on it reads that run only."""
    return spark.read.option("mergeSchema", "true").parquet(path).withColumn(
        "run_id", F.col("run_id").cast("string")
    )


def previous_run(spark: SparkSession, path: str, before: str) -> str | None:
    """The latest stored run_id below `before`, None if there is none. Run ids sort by age."""
    runs = stored_runs(spark, path).filter(F.col("run_id") < before)
    return runs.agg(F.max("run_id")).first()[0]
