from pyspark.sql import functions as F

from noticeloom.operators import signals as sg
from noticeloom.plans.catalog import QUERIES

TEXTS = [
    ("yes", "신청대상: 예비창업자 및 창업 3년 이내 기업"),
    ("implied", "제출서류: 사업자등록증, 재무제표"),
    ("file", "자세한 내용은 첨부파일(HWP) 참조"),
    ("region", "전국 접수, 비수도권 소재 기업만"),
    ("one", "최대 1억 원 지원, 협약기간: 6개월. 창업 3개월"), ("five", "5천만원"), ("mixed", "총 1억 5천만원"),
    ("plain", "300,000원"), ("man", "2,500만 원"), ("none", "1234567890123 points"),
    ("close", "10:00 설명회, 7월 18일 16:00 마감"), ("until", "마감일시: 2026.7.18 18:00"), ("noon", "12:00 점심"),
    ("two", "투자유치 또는 법인 설립, 중복수혜 불가, 수료자 제외"), ("young", "업력 7년 이하, 창업 6개월"), ("contact", "문의: 02-123-4567, help@x.kr, help@x.kr"),
    ("excluded", "예비창업자 제외. 중복수혜 불가"), ("empty", None),
]


def details(spark):
    return spark.createDataFrame([("s", i, t) for i, t in TEXTS], "source string, id string, text string")


def test_wide(spark):
    rows = {r.id: r for r in sg.signals_wide(details(spark)).collect()}
    assert len(rows) == len(TEXTS)
    assert [rows[i].pre_founder for i in ("yes", "implied", "file", "excluded", "empty")] == [
        "yes", "no", "unknown", "no", "unknown"
    ]
    assert rows["file"].attachment_only and not rows["yes"].attachment_only
    assert (rows["region"].apply_region, rows["region"].location_rule) == ("nationwide", "non_capital")
    assert [rows[i].amount for i in ("one", "five", "mixed", "plain", "man", "none")] == [
        100_000_000, 50_000_000, 150_000_000, 300_000, 25_000_000, None
    ]
    assert rows["one"].months == 6 and rows["close"].close_time == "16:00"
    assert [rows[i].close_time for i in ("until", "noon")] == ["18:00", ""]
    assert (rows["young"].months, rows["young"].max_years, rows["yes"].max_years, rows["one"].max_years) == (None, 7, 3, None)
    assert rows["excluded"].exclusion == ["duplicate_benefit"] and rows["yes"].exclusion == []
    assert rows["two"].trigger == ["investment", "incorporation"] and rows["two"].exclusion == ["duplicate_benefit", "graduates"]
    assert {r.rules_version for r in rows.values()} == {sg.RULES_VERSION}


def test_long_form_has_every_signal(spark):
    rows = sg.extract_signals(details(spark)).collect()
    assert len(rows) == len(TEXTS) * len(sg.SIGNALS) + 2
    assert {(r.signal, r.value) for r in rows if r.id == "two" and r.signal in sg.MANY} == {
        ("trigger", "investment"), ("trigger", "incorporation"), ("exclusion", "duplicate_benefit"), ("exclusion", "graduates")}
    hit = next(r for r in rows if r.id == "excluded" and r.signal == "exclusion")
    assert (hit.value, hit.evidence) == ("duplicate_benefit", "중복수혜 불가")
    assert all(r.value == "unknown" for r in rows if r.id == "empty")


def test_contacts_and_regions(spark):
    got = sorted((r.kind, r.contact) for r in sg.contacts(details(spark)).collect())
    assert got == [("email", "help@x.kr"), ("phone", "02-123-4567")]
    text = "서울특별시 또는 부산, 서울, 충청남도 소재, 경상북도"
    df = spark.createDataFrame([("s", "1", text), ("s", "2", None)], "source string, id string, text string")
    assert sorted(r.region for r in sg.named_regions(df).collect()) == ["경북", "부산", "서울", "충남"]


def test_fill_unknown(spark):
    known = spark.createDataFrame([("s", "yes", "x", "1")], "source string, id string, signal string, value string")
    got = sg.fill_unknown(details(spark), known, ("x", "y"))
    assert got.count() == 2 * len(TEXTS)
    assert got.filter(F.col("value") != "unknown").count() == 1


def test_digits_do_not_slow_the_amount(spark):
    text = "1" * 20_000 + "," + "2," * 20_000
    df = spark.createDataFrame([("s", "1", text)], "source string, id string, text string")
    assert sg.signals_wide(df).first().amount is None


def test_short_names_of_regions_are_one_lookup(spark):
    """The condition of a long name does not hold that of the one before twice."""
    texts = spark.createDataFrame([("충청남도, 충남, 전북특별자치도 서울",), (None,)], "t string").select(sg.regions_in(F.col("t")).alias("r"))
    assert [x.r for x in texts.collect()] == [["충남", "전북", "서울"], None]
    assert texts._jdf.queryExecution().optimizedPlan().toString().count("충청남도") < 5


def test_call_texts_are_dealt_to_all_tasks(spark, tmp_path):
    """Few bytes are much work here: adaptive execution leaves the tasks apart."""
    spark.range(1, 401).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(260000.0).alias("o_totalprice"), F.lit("2026-07-01").cast("date").alias("o_orderdate"),
        F.lit("2-HIGH").alias("o_orderpriority")).write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["signal_evidence"](spark, str(tmp_path)).select("id", F.spark_partition_id().alias("p")).collect()
    assert len({r.id for r in found}) == 400 and len({r.p for r in found}) >= 4


def test_only_scopes_of_the_rules_are_read(spark):
    df = spark.createDataFrame([("s", "1", "문의: 예비창업자 02-1. 전국 접수")], "source string, id string, text string")
    one = [r for r in sg.SIGNAL_RULES if r.signal == "apply_region"]
    whole = {tuple(r) for r in sg.extract_signals(df).collect() if r.signal == "apply_region"}
    own = sg.extract_signals(df, tuple(one))
    assert {tuple(r) for r in own.collect()} == whole and len(whole) == 1
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert "right" in plan and "turnover" not in plan and "other sum" not in plan


def test_words_of_rules_lose_no_match(spark):
    """A text is searched only if it has a word that the pattern needs: the same values come out without the words."""
    bare = tuple(sg.SignalRule(r.signal, r.value, r.pattern, r.scope) for r in sg.SIGNAL_RULES)
    assert all(r.words for r in sg.SIGNAL_RULES)
    proofs = ["예비 창업자는 제외", "예비창업자 가능", "사업자등록증", "4대 보험", "재무제표", "전국 접수", "접수 비수도권", "접수 수도권 지역",
              "접수 관내 소재", "입주 공간", "사무공간", "입주지원", "중복 지원 금지", "수료기업 제외", "투자 유치", "매출액 3", "법인  설립", "사업장 이전"]
    df = spark.createDataFrame([("s", str(k), t) for k, t in enumerate(proofs)] + details(spark).collect(), "source string, id string, text string")
    for read in (sg.signals_wide, sg.extract_signals):
        assert sorted(map(str, read(df).collect())) == sorted(map(str, read(df, bare).collect()))
    found = {(r.signal, r.value) for r in sg.extract_signals(df).collect()}
    assert found >= {(r.signal, r.value) for r in sg.SIGNAL_RULES}
