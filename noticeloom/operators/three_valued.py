"""Matching that keeps what it does not know: yes, no and unknown, with ranges.

A pair is dropped only where both sides are known and do not fit. What one side does not say is a
token of its own that the other side also carries, so unknown pairs come out of the same equi-join as
known ones, without a cross join. Ranges meet values in bins of their own size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.intervals import contains, interval
from ..schemas import KEY
from ..session import cut_lineage
from ..sources.profiles import need_codes
from .match import NATIONWIDE
from .scaling import spread_join, spread_members

YES, NO, UNKNOWN = "yes", "no", "unknown"
# Tokens of what a side wants all of, does not say, or matches whatever is said.
ALL, UNSAID, SILENT = "*", "?", "-"
# Ranges shorter than 2 ** LEAST_LEVEL share its bins.
LEAST_LEVEL = -10


def state(known: Column) -> Column:
    """yes, no or unknown of a condition that is null where it is not known."""
    return F.when(known.isNull(), UNKNOWN).when(known, YES).otherwise(NO)


def interval_join(values: DataFrame, ranges: DataFrame, on: list[str], value: str, bounds: str) -> DataFrame:
    """Rows of both sides that agree in `on` and whose value lies in the range or may do so.

    values: `on`, `value` (double or null) and more; ranges: `on`, `bounds` (see `interval`, null is
    unknown) and more; other names differ. Adds `state`: yes, or unknown where a side is null.

    A range lies in at most two bins of the level (power of two) that is no smaller than itself; open
    sides end at the least and greatest value. A value has one bin per level that occurs, so every pair
    meets once, and a long range costs no more than a short one.
    """
    number = F.col(value).cast("double")
    edge = values.agg(F.min(number).alias("low"), F.max(number).alias("high")).first()
    least, most = (edge["low"], edge["high"]) if edge["low"] is not None else (0.0, 0.0)
    b = F.col(bounds)
    low, high = (F.coalesce(b[s], F.lit(e).cast("double")) for s, e in (("low", least), ("high", most)))
    level = F.greatest(F.ceil(F.log2(F.greatest(high - low, F.lit(2.0 ** LEAST_LEVEL)))), F.lit(LEAST_LEVEL)).cast("int")
    # One level is added where rounding of the logarithm could leave a range larger than its bins.
    placed = ranges.withColumn("_level", F.when(b.isNotNull() & (low <= high), level + 1))
    levels = [r["_level"] for r in placed.filter("_level is not null").select("_level").distinct().collect()]
    place = lambda at, of: F.floor(at / F.pow(F.lit(2.0), of)).cast("bigint")
    token = lambda of, at: F.struct(of.cast("int").alias("level"), at.cast("bigint").alias("bin"))
    nowhere, anywhere = token(F.lit(1000), F.lit(0)), token(F.lit(1001), F.lit(0))
    # Level 1000 holds ranges that are not known, for known values; 1001 all ranges, for unknown values.
    covered = F.when(F.col(bounds).isNull(), F.array(nowhere, anywhere)).when(
        F.col("_level").isNull(), F.array(anywhere)).otherwise(F.concat(
            F.transform(F.array_distinct(F.array(place(low, F.col("_level")), place(high, F.col("_level")))),
                        lambda x: token(F.col("_level"), x)), F.array(anywhere)))
    bins = [token(F.lit(n), place(number, F.lit(float(n)))) for n in levels]
    held = F.when(number.isNull(), F.array(anywhere)).otherwise(F.array(*bins, nowhere))
    # Level and bin are columns of their own: as structs of unlike nullability they would be dealt twice.
    flat = lambda df: df.withColumns({"_level": F.col("_token.level"), "_bin": F.col("_token.bin")}).drop("_token")
    left = flat(values.withColumn("_token", F.explode(held)))
    right = flat(placed.withColumn("_token", F.explode(covered)))
    met = spread_join(left, right, [*on, "_level", "_bin"]).withColumn("state", state(contains(F.col(bounds), number)))
    return met.filter(F.col("state") != NO).drop("_level", "_bin")


def _wanted(profiles: DataFrame) -> DataFrame:
    """(profile_class, wanted, scope, value) per class, and the class of every profile."""
    none = F.array().cast("array<string>")
    needs = F.array_sort(F.array_distinct(need_codes(F.coalesce("needs", none))))
    scope = F.array_sort(F.array_distinct(F.concat(
        F.coalesce("regions", none), F.coalesce("movable_regions", none), F.array(F.lit(NATIONWIDE)))))
    value = F.col("years").cast("double") if "years" in profiles.columns else F.lit(None).cast("double")
    return profiles.select(
        "profile_id", needs.alias("needs"), scope.alias("scope"), value.alias("value"),
    ).withColumn("profile_class", F.sha2(F.to_json(F.struct("needs", "scope", "value")), 256))


def _offered(calls: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    clean = lambda c: F.array_sort(F.array_distinct(F.filter(F.coalesce(c, none), lambda x: x.isNotNull() & (x != ""))))
    known = F.coalesce("nationwide", F.lit(False)) if "nationwide" in calls.columns else F.lit(False)
    named = clean(F.col("regions"))
    places = F.when(F.size(named) > 0, named).when(known, F.array(F.lit(NATIONWIDE))).otherwise(F.array(F.lit(UNSAID)))
    bounds = F.col("years") if "years" in calls.columns else F.lit(None).cast("string")
    return calls.select(
        *KEY, clean(F.col("offers")).alias("offers"), places.alias("places"), bounds.alias("span"),
    ).withColumn("call_class", F.sha2(F.to_json(F.struct("offers", "places", "span")), 256))


def match_states(
    profiles: DataFrame, calls: DataFrame, by_years: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profile_class, call_class, need_state, region_state, years_state), and the class of every
    profile (profile_id, profile_class) and call (source, id, call_class).

    profiles: profile_id, needs, regions, movable_regions, perhaps years. calls: source, id, offers,
    regions, and perhaps nationwide (true where the text says so) and years (an interval).

    A need is known to fit if it is offered; a call that says nothing on what it offers, or a profile
    without needs, is unknown; a profile that wants everything (need `coverage`) fits all. A region fits
    if it is one of the profile's or the call is nationwide; a call that says neither is unknown. With
    `by_years`, calls whose bounds on the age of a company are known not to fit drop out as well.
    Null and empty lists say nothing.

    Classes are joined, not members, on (need, region, bin of years): no key holds all calls of a need.
    """
    members, items = cut_lineage(_wanted(profiles)), cut_lineage(_offered(calls))
    want, give = F.col("needs"), F.col("offers")
    tokens = F.when(F.array_contains(want, "coverage"), F.array(F.lit(ALL))).when(
        F.size(want) == 0, F.array(F.lit(UNSAID))).otherwise(F.concat(want, F.array(F.lit(SILENT))))
    offers = F.concat(give, F.array(F.lit(ALL), F.lit(UNSAID)), F.when(F.size(give) == 0, F.array(F.lit(SILENT))).otherwise(
        F.array().cast("array<string>")))
    left = members.select("profile_class", "needs", "scope", "value").distinct().select(
        "profile_class", "value", F.explode(tokens).alias("need"), "scope").select(
        "profile_class", "value", "need", F.explode(F.concat("scope", F.array(F.lit(UNSAID)))).alias("place"))
    right = items.select("call_class", "offers", "places", "span").distinct().select(
        "call_class", "span", interval(F.col("span")).alias("bounds"), F.explode(offers).alias("need"), "places").select(
        "call_class", "span", "bounds", "need", F.explode("places").alias("place"))
    if by_years:
        met = interval_join(left, right, ["need", "place"], "value", "bounds")
    else:
        met = left.join(right, ["need", "place"]).withColumn("state", state(contains(F.col("bounds"), F.col("value"))))
    # A pair meets on several needs and regions; what is known to fit counts before what is unknown.
    unsaid = lambda c, *names: F.max(F.when(F.col(c).isin(*names), 0).otherwise(1))
    said = lambda c: F.when(F.col(c) == 1, YES).otherwise(UNKNOWN).alias(f"{c}_state")
    pairs = met.groupBy("profile_class", "call_class").agg(
        unsaid("need", UNSAID, SILENT).alias("need"), unsaid("place", UNSAID).alias("region"),
        F.first("state").alias("years_state"))
    return (
        pairs.select("profile_class", "call_class", said("need"), said("region"), "years_state"),
        members.select("profile_id", "profile_class"), items.select(*KEY, "call_class"))


def match_known(profiles: DataFrame, calls: DataFrame, by_years: bool = False) -> DataFrame:
    """(profile_id, source, id, need_state, region_state, years_state): the pairs of members.

    It has a row per pair and grows with both sides, though what is shuffled does not; `match_states`
    gives the same by classes.
    """
    pairs, members, items = match_states(profiles, calls, by_years)
    return spread_members(pairs, members, items, "profile_class", "call_class").select(
        "profile_id", *KEY, "need_state", "region_state", "years_state")
