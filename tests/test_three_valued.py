"""Matching that keeps what it does not know, and ranges with open and closed ends."""

import random

import pytest
from pyspark.sql import functions as F

from noticeloom.functions.intervals import contains, interval
from noticeloom.operators import judge as jd, three_valued as tv

PROFILE = "profile_id string, needs array<string>, regions array<string>, movable_regions array<string>, years int"
CALL = "source string, id string, offers array<string>, regions array<string>, nationwide boolean, years string"


def plain_contains(text, value):
    if text is None or value is None:
        return None
    low, high = text[1:-1].split(",")
    above = low == "" or value > float(low) or (text[0] == "[" and value == float(low))
    below = high == "" or value < float(high) or (text[-1] == "]" and value == float(high))
    return above and below


def test_intervals(spark):
    texts = ["[3,7)", "(3,7]", "(,3]", "(,3)", "[5,)", "(,)", "[2.5,2.5]", None, "3-7", "[a,7)", ""]
    values = [None, 0.0, 2.5, 3.0, 5.0, 7.0, 8.0]
    rows = spark.createDataFrame([(t, v) for t in texts for v in values], "t string, v double").select(
        "t", "v", contains(interval(F.col("t")), F.col("v")).alias("c")).collect()
    good = set(texts[:7])
    assert all(r.c == (plain_contains(r.t, r.v) if r.t in good else None) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join(spark, seed):
    """Short, long, open, empty and unknown ranges; every pair that may fit comes out once."""
    rng = random.Random(seed)
    values = [(k % 3, k, rng.choice([None, 0.0, float(rng.randrange(-50, 50)), rng.random() * 1e6])) for k in range(80)]
    ranges = []
    for k in range(60):
        low, high = rng.choice(["", rng.randrange(-50, 50)]), rng.choice(["", rng.randrange(-50, 50), rng.randrange(10 ** 6)])
        ranges.append((k % 3, k, rng.choice([None, f"{rng.choice('[(')}{low},{high}{rng.choice('])')}"])))
    left = spark.createDataFrame(values, "g int, v_id int, value double")
    right = spark.createDataFrame(ranges, "g int, r_id int, span string").withColumn("bounds", interval(F.col("span")))
    got = sorted((r.v_id, r.r_id, r.state) for r in tv.interval_join(left, right, ["g"], "value", "bounds").collect())
    want = []
    for g, v, value in values:
        for h, r, span in ranges:
            fits = plain_contains(span, value)
            if g == h and fits is not False:
                want.append((v, r, "unknown" if fits is None else "yes"))
    assert got == sorted(want)


def test_nothing_drops_out_for_lack_of_knowledge(spark):
    profiles = spark.createDataFrame([
        ("funds", ["자금"], ["부산"], None, 3), ("all", ["전부"], ["부산"], None, 8), ("silent", [], ["부산"], None, None)], PROFILE)
    calls = spark.createDataFrame([
        ("s", "fits", ["funding"], ["부산", "서울"], False, "(,3]"), ("s", "young", ["funding"], [], True, "(,3)"),
        ("s", "far", ["funding"], ["서울"], True, None), ("s", "other", ["rnd"], [], True, None),
        ("s", "nothing", [], None, None, None), (None, "null key", ["funding"], [], True, None)], CALL)
    got = {(r.profile_id, r.id): (r.need_state, r.region_state, r.years_state) for r in tv.match_known(profiles, calls).collect()}
    yes, no, unknown = "yes", "no", "unknown"
    assert got == {
        ("funds", "fits"): (yes, yes, yes), ("funds", "young"): (yes, yes, no), ("funds", "nothing"): (unknown, unknown, unknown),
        ("funds", "null key"): (yes, yes, unknown), ("all", "null key"): (yes, yes, unknown), ("silent", "null key"): (unknown, yes, unknown),
        ("all", "fits"): (yes, yes, no), ("all", "young"): (yes, yes, no), ("all", "other"): (yes, yes, unknown),
        ("all", "nothing"): (yes, unknown, unknown), ("silent", "fits"): (unknown, yes, unknown),
        ("silent", "young"): (unknown, yes, unknown), ("silent", "other"): (unknown, yes, unknown),
        ("silent", "nothing"): (unknown, unknown, unknown)}
    fitting = tv.match_known(profiles, calls, by_years=True).collect()
    assert {(r.profile_id, r.id) for r in fitting} == {k for k, v in got.items() if v[2] != no}
    assert len(fitting) == len({(r.profile_id, r.id) for r in fitting})


def test_judge_keeps_what_it_does_not_know(spark):
    """A contact in Seoul, the state of the economy and a title without an offer exclude nobody."""
    profiles = spark.createDataFrame(
        [("one", "corporation", 3, ["자금"], ["부산"], None), ("all", "corporation", 3, ["전부"], ["부산"], None)],
        "profile_id string, stage string, years int, needs array<string>, regions array<string>, movable_regions array<string>")
    texts = {
        "contact": ("사업화 자금", "문의: 서울특별시 강남구"), "economy": ("사업화 자금", "경기 침체를 이겨낼 기업"),
        "title": ("도약 프로그램", ""), "strict": ("사업화 자금", "업력 3년 미만"), "loose": ("사업화 자금", "업력 3년 이하"),
        "seoul": ("사업화 자금", "서울 소재 기업"), "rnd": ("연구개발", "전국 접수"), "sales": ("사업화 자금", "매출액 10억원 이상")}
    items = spark.createDataFrame([("s", i, t, "", "") for i, (t, _) in texts.items()], "source string, id string, title string, field string, apply_end string")
    details = spark.createDataFrame([("s", i, t) for i, (_, t) in texts.items()], "source string, id string, text string")
    facts = spark.createDataFrame([("one", "sales_won", "900000000"), ("all", "sales_won", "1000000000")], "profile_id string, requirement string, value string")
    got = {(r.profile_id, r.id): (r.tier, r.need_state, r.region_state) for r in jd.judge(profiles, items, details, more_facts=facts).collect()}
    assert {i for p, i in got if p == "one"} == {"contact", "economy", "title", "strict", "loose", "sales"}
    assert {i for p, i in got if p == "all"} == {"contact", "economy", "title", "strict", "loose", "sales", "rnd"}
    assert got["one", "contact"] == ("A", "yes", "unknown") and got["one", "title"] == ("A", "unknown", "unknown")
    assert (got["one", "strict"][0], got["one", "loose"][0]) == ("rejected", "A")
    assert got["all", "rnd"] == ("A", "yes", "yes")
    assert (got["one", "sales"][0], got["all", "sales"][0]) == ("B", "A")


def test_reframing_is_a_tier(spark):
    profiles = spark.createDataFrame(
        [("p", "corporation", 9, ["자금"], ["부산"], None, "voice")],
        "profile_id string, stage string, years int, needs array<string>, regions array<string>, movable_regions array<string>, field string")
    items = spark.createDataFrame([("s", "1", "자금", "welfare", ""), ("s", "2", "자금", "art", "")], "source string, id string, title string, field string, apply_end string")
    details = spark.createDataFrame([("s", "1", "업력 3년 미만"), ("s", "2", "업력 3년 미만")], "source string, id string, text string")
    themes = spark.createDataFrame([("voice", "welfare", "care calls")], "from_field string, to_field string, theme string")
    got = {r.id: (r.tier, r.rules_version) for r in jd.judge(profiles, items, details, themes=themes).collect()}
    assert {k: v[0] for k, v in got.items()} == {"1": "C", "2": "rejected"} and {v[1] for v in got.values()} == {3}


def test_interval_join_of_one_key_is_spread(spark):
    values = spark.range(400).select((F.col("id") % 1).alias("g"), F.col("id").alias("v_id"), F.col("id").cast("double").alias("value"))
    ranges = spark.range(100).select((F.col("id") % 1).alias("g"), F.col("id").alias("r_id"), interval(F.concat(F.lit("(,"), F.col("id") % 1 + 400, F.lit(")"))).alias("bounds"))
    met = tv.interval_join(values, ranges, ["g"], "value", "bounds")
    assert met.count() == met.distinct().count() == 400 * 100
    assert met.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_texts_of_calls_are_read_once(spark):
    """Described calls are a stage: what follows reads no text, and texts without a call are not read."""
    calls = spark.createDataFrame(
        [("s", "1", "t", "자금", None), ("s", "2", "t", "자금", None), (None, "3", "t", "자금", None)],
        "source string, id string, title string, field string, apply_end string")
    details = spark.createDataFrame(
        [("s", "1", "신청대상: 충청남도 소재 창업 3년 미만 기업"), ("s", "9", "전국"), (None, "3", "전국")], "source string, id string, text string")
    described = jd.describe_calls(calls, details)
    plan = described._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "RLIKE" not in plan
    assert [(r.id, r.regions, r.years, r.nationwide) for r in described.orderBy("id").collect()] == [
        ("1", ["충남"], "(,3)", False), ("2", None, None, False), ("3", None, None, False)]


def test_classes_are_judged_once_and_members_get_it(spark, monkeypatch):
    """Pairs that are evaluated are those of classes; a repeated key counts its rows, a null key is not judged."""
    seen = []
    monkeypatch.setattr(jd, "evaluate", lambda pairs, *rest, run=jd.evaluate: seen.append(pairs.count()) or run(pairs, *rest))
    people = [(f"p{k}", "corporation", 5, ["자금"], ["부산"], None) for k in range(30)]
    people += [("twice", "sole_owner", None, ["자금"], ["부산"], None)] * 2 + [(None, "corporation", 5, ["자금"], ["부산"], None)]
    profiles = spark.createDataFrame(
        people, "profile_id string, stage string, years int, needs array<string>, regions array<string>, movable_regions array<string>")
    ids = [f"c{k}" for k in range(20)] + [None]
    calls = spark.createDataFrame(
        [("s", i, "t", "사업화 자금", "") for i in ids] + [("s", "again", "t", "사업화 자금", "")] * 2,
        "source string, id string, title string, field string, apply_end string")
    details = spark.createDataFrame(
        [("s", i, f"업력 3년 이하. 법인 설립 예정자. 문의: 02-{i}") for i in [*ids, "again"]], "source string, id string, text string")
    rows = jd.judge(profiles, calls, details).collect()
    got = {(r.profile_id, r.id): (r.tier, r.unknowns, r.unmet) for r in rows}
    assert len(rows) == 32 * 22 and len(got) == 31 * 21
    # One class of 30 profiles, one of the repeated one; one class of 20 calls, one of the repeated one.
    assert seen == [(1 + 2) * (1 + 2)]
    assert got["p3", "c7"] == ("rejected", 0, 1) and got["twice", "c7"] == ("B", 2, 2)
    assert got["p3", "again"] == ("rejected", 0, 4) and got["twice", "again"] == ("B", 8, 8)
