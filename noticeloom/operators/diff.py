"""Differences between two survey runs, with a guard for sources of only one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import KEY
from ..session import cut_lineage, fine_shuffles
from .scaling import join_dimension


def _end(record: str) -> Column:
    return F.coalesce(F.col(f"{record}.apply_end"), F.lit(""))


def source_coverage(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """(source, in_prev, in_curr, coverage) with coverage common, added or dropped."""
    tagged = prev.select("source", F.lit(1).alias("p"), F.lit(0).alias("c")).unionByName(
        curr.select("source", F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    both = tagged.groupBy("source").agg(F.max("p").alias("in_prev"), F.max("c").alias("in_curr"))
    coverage = (
        F.when(F.col("in_prev") + F.col("in_curr") == 2, "common")
        .when(F.col("in_curr") == 1, "added").otherwise("dropped")
    )
    return both.withColumn("coverage", coverage)


def pair_runs(prev: DataFrame, curr: DataFrame, order: list[str]) -> DataFrame:
    """Both runs by key with one shuffle: (source, id, prev, curr, prev_pos, curr_pos).

    Fields that only one run has are null in the records of the other. Repeated keys inside a run are folded in the same step: last values, first position.
    """
    fields = list(dict.fromkeys([*prev.columns, *curr.columns]))
    place = F.struct(*order)
    tagged = prev.withColumn("_run", F.lit(0)).unionByName(
        curr.withColumn("_run", F.lit(1)), allowMissingColumns=True
    )
    record = F.struct(*[c for c in fields if c not in order])

    def of(run: int, value: Column) -> Column:
        return F.when(F.col("_run") == run, value)

    return tagged.groupBy(*KEY).agg(
        F.max_by(of(0, record), of(0, place)).alias("prev"),
        F.max_by(of(1, record), of(1, place)).alias("curr"),
        F.min(of(0, place)).alias("prev_pos"),
        F.min(of(1, place)).alias("curr_pos"),
    )


def snapshot_diff(prev: DataFrame, curr: DataFrame, order: list[str]) -> DataFrame:
    """One status per key of either run.

    new, closed: the source is in both runs. deadline_changed, unchanged: the key is in both,
    a null deadline equals ''. first_time, not_recrawled: the source is in one run only.

    The runs are read and paired once. The pairs are written as a stage, and the coverage of the
    sources is taken from them by one aggregate of two flags.
    """
    with fine_shuffles(prev.sparkSession):
        paired = cut_lineage(pair_runs(prev, curr, order))
    return with_status(paired, paired_coverage(paired))


def paired_coverage(paired: DataFrame) -> DataFrame:
    """(source, coverage) of paired runs."""
    flags = paired.groupBy("source").agg(
        F.max(F.col("prev").isNotNull()).alias("p"), F.max(F.col("curr").isNotNull()).alias("c")
    )
    coverage = F.when(F.col("p") & F.col("c"), "common").when(F.col("c"), "added").otherwise("dropped")
    return flags.select("source", coverage.alias("coverage"))


def with_status(paired: DataFrame, coverage: DataFrame) -> DataFrame:
    known = paired.join(coverage.select("source", "coverage"), "source", "left")
    status = (
        F.when(F.col("prev").isNotNull() & F.col("curr").isNotNull(),
               F.when(_end("prev") != _end("curr"), "deadline_changed").otherwise("unchanged"))
        .when(F.col("coverage") == "common",
              F.when(F.col("curr").isNotNull(), "new").otherwise("closed"))
        .when(F.col("curr").isNotNull(), "first_time")
        .otherwise("not_recrawled")
    )
    return known.select(
        *KEY, status.alias("status"),
        F.col("prev.apply_end").alias("old_end"), F.col("curr.apply_end").alias("new_end"),
        "prev", "curr", "prev_pos", "curr_pos",
    )


def snapshot_diff_by_join(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """The same statuses as a full outer join of two runs with unique keys (key, status)."""
    p = prev.select(*KEY, F.coalesce("apply_end", F.lit("")).alias("p_end"), F.lit(1).alias("p"))
    c = curr.select(*KEY, F.coalesce("apply_end", F.lit("")).alias("c_end"), F.lit(1).alias("c"))
    both = p.join(c, KEY, "full_outer")
    known = join_dimension(
        both, source_coverage(prev, curr).select("source", "coverage"), ["source"], ["id"]
    )
    status = (
        F.when(F.col("p_end") != F.col("c_end"), "deadline_changed")
        .when(F.col("p_end") == F.col("c_end"), "unchanged")
        .when(F.col("coverage") == "common", F.when(F.col("c") == 1, "new").otherwise("closed"))
        .when(F.col("c") == 1, "first_time").otherwise("not_recrawled")
    )
    return known.select(*KEY, status.alias("status"))


def confirm_closed(diff: DataFrame, stops: DataFrame) -> DataFrame:
    """Closed items of a source whose current crawl was cut short become closed_unconfirmed."""
    state = stops.select("source", "crawl_complete")
    known = join_dimension(diff, state, ["source"], ["id"])
    doubtful = (F.col("status") == "closed") & (F.col("crawl_complete") == F.lit(False))
    return known.withColumn(
        "status", F.when(doubtful, "closed_unconfirmed").otherwise(F.col("status"))
    ).drop("crawl_complete")


def _with(diff: DataFrame, status: str) -> DataFrame:
    return diff.filter(F.col("status") == status)


def new_items(diff: DataFrame) -> DataFrame:
    return _with(diff, "new")


def closed(diff: DataFrame) -> DataFrame:
    return _with(diff, "closed")


def deadline_changed(diff: DataFrame) -> DataFrame:
    return _with(diff, "deadline_changed")


def unchanged(diff: DataFrame) -> DataFrame:
    return _with(diff, "unchanged")


def first_time(diff: DataFrame) -> DataFrame:
    return _with(diff, "first_time")


def not_recrawled(diff: DataFrame) -> DataFrame:
    """Sources of the previous run that the current run lacks, with their item counts."""
    return _with(diff, "not_recrawled").groupBy("source").agg(F.count("*").alias("items"))


def order_new(diff: DataFrame) -> DataFrame:
    """New items by deadline as text, missing ones as '~', ties in input order."""
    end = F.coalesce(F.nullif("new_end", F.lit("")), F.lit("~"))
    return new_items(diff).orderBy(end, "curr_pos", "source", "id")


def run_sources(run: DataFrame) -> DataFrame:
    return run.select("source").distinct()


def common_sources(prev: DataFrame, curr: DataFrame) -> DataFrame:
    return run_sources(prev).intersect(run_sources(curr))


def added_sources(prev: DataFrame, curr: DataFrame) -> DataFrame:
    return run_sources(curr).subtract(run_sources(prev))


def dropped_sources(prev: DataFrame, curr: DataFrame) -> DataFrame:
    return run_sources(prev).subtract(run_sources(curr))


def status_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count("*").alias("items"))


def run_totals(diff: DataFrame) -> DataFrame:
    """One row: distinct items of either run, and the number of sources that were compared."""
    compared = F.col("status").isin("new", "closed", "deadline_changed", "unchanged", "closed_unconfirmed")
    return diff.agg(
        F.count("prev").alias("prev_items"), F.count("curr").alias("curr_items"),
        F.count_distinct(F.when(compared, F.col("source"))).alias("compared_sources"),
    )


def compared_sources(diff: DataFrame) -> DataFrame:
    """(source, refreshed): sources of the diff; those of the previous run only are not refreshed."""
    stale = F.min(F.col("status") == "not_recrawled")
    return diff.groupBy("source").agg((~stale).alias("refreshed"))


# Verdicts of the previous survey.


def carry_verdicts(diff: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Previous verdicts of items that are still there; other items wait for a review.

    verdicts: (profile_id, source, id, tier).
    """
    there = diff.filter(F.col("curr").isNotNull()).select(*KEY, "status", "new_end")
    # Inner and anti join instead of a left join: verdicts of one hot item can then be split.
    judged = verdicts.select("profile_id", *KEY, "tier").join(there, KEY)
    unjudged = there.join(verdicts.select(*KEY).distinct(), KEY, "left_anti")
    carried = F.col("status").isin("unchanged", "deadline_changed")
    return judged.unionByName(unjudged, allowMissingColumns=True).select(
        "profile_id", *KEY, "status", F.col("new_end").alias("apply_end"),
        F.when(carried, F.col("tier")).alias("tier"),
        F.when(carried & F.col("tier").isNotNull(), "carried").otherwise("unreviewed").alias("review"),
    )


def _of_tier(diff: DataFrame, verdicts: DataFrame, tier: str) -> DataFrame:
    return diff.join(verdicts.filter(F.col("tier") == tier), KEY)


def recheck_queue(diff: DataFrame, verdicts: DataFrame, tier: str = "A") -> DataFrame:
    """Items of the best tier whose deadline changed: their terms may have changed too."""
    return _of_tier(deadline_changed(diff), verdicts, tier).select(
        "profile_id", *KEY, "old_end", "new_end"
    )


def lost_opportunities(diff: DataFrame, verdicts: DataFrame, tier: str = "A") -> DataFrame:
    return _of_tier(closed(diff), verdicts, tier).select("profile_id", *KEY, "old_end")


def incremental_report(diff: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """Items by status, tier before and tier now, per profile; a missing tier is 'none'.

    Items that no profile has a verdict for are counted under a null profile.
    """
    old = before.select("profile_id", *KEY, F.col("tier").alias("tier_before"))
    new = now.select("profile_id", *KEY, F.col("tier").alias("tier_now"))
    judged = old.join(new, ["profile_id", *KEY], "full_outer")
    there = diff.select(*KEY, "status")
    found = judged.join(there, KEY)
    silent = there.join(judged.select(*KEY).distinct(), KEY, "left_anti")
    return (
        found.unionByName(silent, allowMissingColumns=True)
        .groupBy(
            "profile_id", "status",
            F.coalesce("tier_before", F.lit("none")).alias("tier_before"),
            F.coalesce("tier_now", F.lit("none")).alias("tier_now"),
        )
        .agg(F.count("*").alias("items"))
    )
