"""Report tables: counts, shares, rankings, calendars, checks. No text is laid out here."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import IMMINENT_DAYS, as_date, d_day, imminent, is_open
from ..schemas import KEY
from .scaling import row_number_by_range

ALWAYS_OPEN = "상시"


def open_on(df: DataFrame, as_of: Column | datetime.date, end: str = "apply_end") -> DataFrame:
    """Announcements that can still be applied for; unknown deadlines stay."""
    return df.filter(is_open(F.col(end), as_of))


def with_days_left(
    df: DataFrame, as_of: Column | datetime.date, days: int = IMMINENT_DAYS, end: str = "apply_end"
) -> DataFrame:
    return df.withColumn("days_left", d_day(F.col(end), as_of)).withColumn(
        "imminent", imminent(F.col(end), as_of, days)
    )


def items_per_source(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct items per source. Exact counts go over the keys, so a hot source is split."""
    if approx:
        return df.groupBy("source").agg(F.approx_count_distinct("id").alias("items"))
    return df.select(*KEY).distinct().groupBy("source").agg(F.count("*").alias("items"))


def source_names(df: DataFrame) -> DataFrame:
    return df.select("source").distinct().orderBy("source")


def category_share(df: DataFrame, category: str = "category") -> DataFrame:
    """Items and share per category; the total is one number from the counts."""
    counts = df.groupBy(F.col(category).alias("category")).agg(F.count("*").alias("items"))
    # One row per category, so the window over all of them is small.
    total = F.sum("items").over(Window.partitionBy())
    return counts.withColumn("share", F.col("items") / total)


def attach_details(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Candidates with their detail text; those without one stay, with a null text.

    Texts of other announcements are dropped before any text is moved.
    """
    wanted = details.select(*KEY, "text").join(candidates.select(*KEY), KEY, "left_semi")
    return candidates.join(wanted, KEY, "left")


def survey_coverage(
    candidates: DataFrame, collected: DataFrame, verified: DataFrame, before: DataFrame | None = None
) -> DataFrame:
    """(source, collected, candidates, verified, unknown, refreshed): how far a survey went.

    Each input has (source, id), unique; `verified` also has `unknowns`. A source of `before` (source)
    of which nothing was collected is listed as not refreshed.
    """

    def mark(df: DataFrame, part: str, unknown: Column) -> DataFrame:
        return df.select("source", F.lit(part).alias("_part"), unknown.alias("_unknown"))

    marked = (
        mark(collected, "collected", F.lit(0))
        .unionByName(mark(candidates, "candidates", F.lit(0)))
        .unionByName(mark(verified, "verified", (F.col("unknowns") > 0).cast("int")))
    )
    if before is not None:
        marked = marked.unionByName(mark(before.select("source").distinct(), "before", F.lit(0)))
    counted = marked.groupBy("source").agg(
        *[F.count_if(F.col("_part") == p).alias(p) for p in ("collected", "candidates", "verified")],
        F.count_if(F.col("_unknown") == 1).alias("unknown"),
    )
    return counted.withColumn("refreshed", F.col("collected") > 0)


def tier_rollup(judged: DataFrame) -> DataFrame:
    """(source, tier, items) with subtotals; 'all' stands for every value."""
    rolled = judged.rollup("source", "tier").agg(
        F.count("*").alias("items"), F.grouping("source").alias("_s"), F.grouping("tier").alias("_t")
    )
    return rolled.select(
        F.when(F.col("_s") == 1, "all").otherwise(F.col("source")).alias("source"),
        F.when(F.col("_t") == 1, "all").otherwise(F.col("tier")).alias("tier"), "items",
    )


def action_calendar(judged: DataFrame, tiers: tuple[str, ...] = ("A", "B")) -> DataFrame:
    """What is due when: one row per application with a known deadline, by date.

    Rows, not lists, so a date on which very much is due is still sorted in parallel.
    """
    due = judged.filter(F.col("tier").isin(*tiers)).withColumn("due", as_date(F.col("apply_end")))
    return due.filter(F.col("due").isNotNull()).orderBy("due", "tier", "profile_id", *KEY)


def actions_per_day(judged: DataFrame, tiers: tuple[str, ...] = ("A", "B")) -> DataFrame:
    due = judged.filter(F.col("tier").isin(*tiers)).withColumn("due", as_date(F.col("apply_end")))
    return due.filter(F.col("due").isNotNull()).groupBy("due", "tier").agg(
        F.count("*").alias("applications")
    )


def _deadline_order() -> list[Column]:
    return [F.coalesce(as_date(F.col("apply_end")), F.lit("9999-12-31").cast("date")),
            F.col("source"), F.col("id")]


def rank_in_tier(judged: DataFrame) -> DataFrame:
    """Position by deadline inside a profile's tier, unknown deadlines last."""
    return row_number_by_range(judged, ["profile_id", "tier"], _deadline_order(), "position")


def top_in_tier(judged: DataFrame, k: int, tier: str = "A") -> DataFrame:
    """The k next deadlines per profile; each task passes on at most k rows per profile."""
    window = Window.partitionBy("profile_id").orderBy(*_deadline_order())
    return (
        judged.filter(F.col("tier") == tier)
        .withColumn("position", F.row_number().over(window))
        .filter(F.col("position") <= k)
    )


def absent_programs(watch: DataFrame, open_items: DataFrame, n: int = 3) -> DataFrame:
    """Expected programs that no open title contains, white space ignored.

    watch: program, pattern. Titles meet a pattern only on the pattern's rarest n-gram, counted over
    the titles, so this is an equi-join without frequent keys where a pattern has any rare part; the
    containment test runs on what met.
    """

    def packed(c: Column) -> Column:
        return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))

    sought = watch.select("program", packed(F.col("pattern")).alias("pattern")).filter(
        F.col("pattern") != ""
    )
    titles = open_items.select(packed(F.col("title")).alias("title")).distinct()
    starts = F.sequence(F.lit(1), F.greatest(F.char_length("title"), F.lit(1)))
    # A pattern shorter than n is its own gram, so shorter pieces of a title take part too.
    pieces = F.flatten(F.transform(
        starts, lambda i: F.transform(
            F.sequence(F.lit(1), F.lit(n)), lambda m: F.substring(F.col("title"), i, m)
        )
    ))
    grams = titles.select("title", F.explode(F.array_distinct(pieces)).alias("gram"))
    own = F.when(F.char_length("pattern") <= n, F.array("pattern")).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length("pattern") - n + 1, F.lit(1))),
        lambda i: F.substring(F.col("pattern"), i, n),
    ))
    counted = sought.select("program", "pattern", F.explode(F.array_distinct(own)).alias("gram")).join(
        grams.groupBy("gram").agg(F.count("*").alias("_n")), "gram", "left"
    ).withColumn("_n", F.coalesce("_n", F.lit(0)))
    # A gram that no title has settles the matter without a join.
    rarest = counted.groupBy("program", "pattern").agg(
        F.min(F.struct("_n", "gram")).alias("_r")
    ).filter("_r._n > 0").select("program", "pattern", "_r.gram")
    met = grams.join(rarest, "gram")
    present = met.filter(F.contains("title", "pattern")).select("program").distinct()
    return watch.select("program", "pattern").join(present, "program", "left_anti")


def missing_urls(report: DataFrame) -> DataFrame:
    """Reported rows without a URL: a check that should find nothing."""
    return report.filter(F.coalesce("url", F.lit("")) == "")


def space_options(df: DataFrame) -> DataFrame:
    """Announcements that offer rooms. `offers` is an array of needs."""
    return df.filter(F.array_contains("offers", "space"))


def always_open(df: DataFrame) -> DataFrame:
    return df.filter(F.contains("apply_end", F.lit(ALWAYS_OPEN)))
