"""From announcements and their detail texts to tiers: offers, regions, requirements, judgement.

The word lists are ours, as in `signals`: they annotate, and what no rule finds is not required.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import is_open
from ..functions.text import let
from ..schemas import KEY
from ..session import cut_lineage
from .match import evaluate, reframing_candidates, tiers
from .scaling import spread_members
from .signals import CAPITAL_AREA, REGIONS, RULES_VERSION, signals_wide
from .three_valued import match_known

# What a category or title offers, as the codes of needs.
OFFERS = {
    "funding": r"자금|사업화|지원금|융자|바우처",
    "space": r"공간|입주|보육|사무실",
    "rnd": r"(?i)r&d|연구개발|기술개발",
    "content": r"콘텐츠|제작\s*지원",
    "ai_ict": r"(?i)\bai\b|ict|인공지능|소프트웨어|\bsw\b|클라우드|데이터",
    "mentoring": r"멘토링|컨설팅|교육",
    "market": r"판로|수출|마케팅|해외\s*진출",
}
COMPANY_STAGES = "sole_owner|corporation"
# What is read of profiles and of described calls when they are judged.
ASKING = ("stage", "years", "needs", "regions", "movable_regions")
ASKED = ("offers", "regions", "nationwide", "years", "sales", "pre_founder", "location_rule", "trigger", "exclusion")


def offers_of(*texts: Column) -> Column:
    """Codes of what the texts of a call (category, title ...) offer."""
    whole = F.concat_ws("\n", *texts)

    def found(text: Column) -> Column:
        hits = F.array(*[F.when(text.rlike(p), F.lit(code)) for code, p in OFFERS.items()])
        return F.filter(hits, lambda h: h.isNotNull())

    return let(whole, found)


def describe_calls(announcements: DataFrame, details: DataFrame) -> DataFrame:
    """(source, id, field, apply_end, offers, nationwide, and the wide signals) of every announcement.

    announcements: source, id, title, field, apply_end; details: source, id, text, unique. `regions` are
    those that applicants have to be in; a call without them is `nationwide` only if its text says so.
    Announcements without details, or with a null key, keep empty signals. Only texts of announcements
    are read, and these once: the result is a stage, as it is used several times.
    """
    offers = offers_of(F.col("field"), F.col("title"))
    described = announcements.select(*KEY, "field", "apply_end", offers.alias("offers"))
    asked = details.select(*KEY, "text").join(announcements.select(*KEY), KEY, "left_semi")
    return cut_lineage(described.join(signals_wide(asked), KEY, "left").withColumn(
        "nationwide", F.coalesce(F.col("apply_region") == "nationwide", F.lit(False))))


def requirements_of(calls: DataFrame) -> DataFrame:
    """(source, id, requirement, op, needed, kind) from described calls.

    Founding, investment, sales and moving are triggers: an applicant can bring them about.
    """
    outside = "|".join(r for r in REGIONS if r not in CAPITAL_AREA)

    def row(requirement: str, op: str, needed: Column, kind: str) -> Column:
        return F.struct(
            F.lit(requirement).alias("requirement"), F.lit(op).alias("op"),
            needed.cast("string").alias("needed"), F.lit(kind).alias("kind"))

    rules = [
        F.when(F.col("pre_founder") == "no", row("stage", "in", F.lit(COMPANY_STAGES), "trigger")),
        F.when(F.col("years").isNotNull(), row("years", "within", F.col("years"), "fixed")),
        F.when(F.col("sales").isNotNull(), row("sales_won", "within", F.col("sales"), "trigger")),
        F.when(F.col("location_rule") == "non_capital", row("region", "in", F.lit(outside), "trigger")),
        F.when(F.col("location_rule") == "capital", row("region", "in", F.lit("|".join(CAPITAL_AREA)), "trigger")),
    ]
    rules += [
        F.when(F.array_contains("trigger", name), row(fact, "eq", F.lit("yes"), "trigger"))
        for name, fact in (("investment", "investment"), ("sales", "sales"), ("incorporation", "incorporated"), ("relocation", "relocated"))
    ]
    rules += [
        F.when(F.array_contains("exclusion", name), row(name, "eq", F.lit("no"), "fixed"))
        for name in ("duplicate_benefit", "graduates")
    ]
    asked = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return calls.select(*KEY, F.explode(asked).alias("r")).select(*KEY, "r.*")


def facts_of(profiles: DataFrame) -> DataFrame:
    """(profile_id, requirement, value) of parsed profiles; regions are several values."""
    def rows(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("requirement"), v.alias("value")))

    none = F.array().cast("array<string>")
    places = F.concat(F.coalesce("regions", none), F.coalesce("movable_regions", none))
    founded = F.when(F.col("stage") == "corporation", "yes").when(
        F.col("stage").isin("pre_founder", "sole_owner"), "no").otherwise("unknown")
    facts = F.concat(
        rows("stage", F.array("stage")), rows("years", F.array(F.col("years").cast("string"))),
        rows("incorporated", F.array(founded)), rows("region", places))
    return profiles.select("profile_id", F.explode(facts).alias("f")).select("profile_id", "f.*")


def classes_of(rows: DataFrame, keys: list[str], said: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(`keys`, `name`) of every key without nulls, and (`name`, `said`) with all rows that a key of the class has.

    Keys whose rows say the same are one class; a key may have several rows. Both are stages.
    """
    digest = lambda: F.sha2(F.to_json(F.struct(*said)), 256)
    whole = rows.dropna(subset=keys)
    members = cut_lineage(
        whole.select(*keys, digest().alias("_row")).groupBy(*keys).agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
        .withColumn(name, F.sha2(F.array_join("_rows", ","), 256)))
    kinds = whole.select(*said).distinct().withColumn("_row", digest())
    classes = members.select(name, "_rows").distinct().select(name, F.explode("_rows").alias("_row"))
    return members.select(*keys, name), cut_lineage(classes.join(kinds, "_row").select(name, *said))


def judge(
    profiles: DataFrame, announcements: DataFrame, details: DataFrame, as_of: Column | None = None,
    more_facts: DataFrame | None = None, themes: DataFrame | None = None,
) -> DataFrame:
    """(profile_id, source, id, tier, unknowns, unmet, need_state, region_state, rules_version).

    Parsed profiles are matched with the calls that are open on `as_of`, see `match_states`: a call
    drops out only where its offer or its region is known not to fit. Then every requirement is
    evaluated. `more_facts` adds what the profile file does not say, e.g. sales. With `themes`
    (from_field, to_field, theme) and a `field` in profiles, what could be reframed is tier C.

    Profiles that say the same are judged once, and so are calls; members get what their class got,
    and become rows last. Rows with a null key are not judged.
    """
    if as_of is not None:
        announcements = announcements.filter(is_open(F.col("apply_end"), as_of))
    calls = describe_calls(announcements, details)
    field = ["field"] if themes is not None else []
    asking = [*(c for c in ASKING if c in profiles.columns), *field]
    if more_facts is not None:
        told = more_facts.groupBy("profile_id").agg(
            F.sort_array(F.collect_set(F.struct("requirement", "value"))).alias("_more"))
        profiles, asking = profiles.join(told, "profile_id", "left"), [*asking, "_more"]
    people, applicants = classes_of(profiles, ["profile_id"], asking, "_profile_class")
    items, offered = classes_of(calls, KEY, [*ASKED, *field], "_call_class")
    applicants = applicants.withColumnRenamed("_profile_class", "profile_id")
    offered = offered.withColumnRenamed("_call_class", "id").withColumn("source", F.lit(""))
    facts = facts_of(applicants)
    if more_facts is not None:
        facts = facts.unionByName(applicants.select("profile_id", F.inline("_more")))
    matched = match_known(applicants, offered).drop("years_state")
    reframable = None
    if themes is not None:
        reframable = reframing_candidates(applicants, offered, themes).select("profile_id", *KEY).distinct()
    judged = tiers(evaluate(matched.select("profile_id", *KEY), requirements_of(offered), facts), reframable)
    known = cut_lineage(judged.join(matched, ["profile_id", *KEY]).select(
        F.col("profile_id").alias("_profile_class"), F.col("id").alias("_call_class"),
        "tier", "unknowns", "unmet", "need_state", "region_state"))
    return spread_members(known, people, items, "_profile_class", "_call_class").select(
        "profile_id", *KEY, "tier", "unknowns", "unmet", "need_state", "region_state",
        F.lit(RULES_VERSION).alias("rules_version"))
