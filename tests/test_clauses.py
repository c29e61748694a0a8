"""Clauses and signals against labelled texts: what each signal says, and how often it is right."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from noticeloom.functions.clauses import clauses
from noticeloom.operators import signals as sg

# text, regions of applicants, right to apply, closing time, sum, bounds on the age of a company
LABELS = [
    ("신청대상: 서울 소재 창업 3년 미만 기업\n문의: 부산광역시 해운대구 051-123-4567", "서울", "", "", None, "(,3)"),
    ("문의: 서울특별시 강남구 테헤란로 1", "", "", "", None, None),
    ("경기 침체를 이겨낼 예비창업자", "", "", "", None, None),
    ("경기 소재 기업, 경기 회복 지원", "경기", "", "", None, None),
    ("접수마감 7월 10일, 설명회 14:00", "", "", "", None, None),
    ("10:00 설명회, 7월 18일 16:00 마감", "", "", "16:00", None, None),
    ("설명회: 7월 5일 14:00\n마감일시: 7월 10일 18:00", "", "", "18:00", None, None),
    ("접수기간: 7.1 09:00 ~ 7.10 17:00까지, 발표평가 7.20 10:00", "", "", "17:00", None, None),
    ("전국 지자체가 후원, 서울 소재 기업만", "서울", "", "", None, None),
    ("전국 접수, 비수도권 소재 기업만", "", "nationwide", "", None, None),
    ("신청대상: 전국 예비창업자", "", "nationwide", "", None, None),
    ("주최: 전국경제인연합회\n신청자격: 부산 거주 예비창업자", "부산", "", "", None, None),
    ("총 사업비 10억원, 기업당 최대 1억원 지원", "", "", "", 100_000_000, None),
    ("자부담 2천만원. 지원금액: 5천만원", "", "", "", 50_000_000, None),
    ("매출액 10억원 이상 기업. 지원규모: 3억원", "", "", "", 300_000_000, None),
    ("300,000원", "", "", "", 300_000, None),
    ("창업 3년 이내 기업", "", "", "", None, "(,3]"), ("업력 7년 미만", "", "", "", None, "(,7)"),
    ("창업 3년 이상 7년 미만 기업", "", "", "", None, "[3,7)"), ("설립 3년 초과 7년 이하", "", "", "", None, "(3,7]"),
    ("업력 5년 이상", "", "", "", None, "[5,)"),
    ("장소: 대전 컨벤션센터 3층\n신청대상\n - 충청남도 또는 충북 소재 기업", "충남,충북", "", "", None, None),
    ("교육장: 서울 코엑스 접수: 전국", "", "nationwide", "", None, None),
    ("부산물 재활용 기업 소재, 세종대왕 기념 행사", "", "", "", None, None),
    ("제출처: 세종 소재 진흥원, 문의 13:00 이후", "", "", "", None, None),
    ("관내 소재 기업, 충청남도 또는 대전", "충남,대전", "", "", None, None),
    ("", "", "", "", None, None), (None, "", "", "", None, None),
]


@pytest.fixture(scope="module")
def read(spark):
    rows = [("s", f"{k:03}", row[0]) for k, row in enumerate(LABELS)]
    details = spark.createDataFrame(rows, "source string, id string, text string")
    return sorted(sg.signals_wide(details).collect(), key=lambda r: r.id)


SIGNALS = {
    "regions": lambda r: ",".join(r.regions), "apply_region": lambda r: "" if r.apply_region == "unknown" else r.apply_region,
    "close_time": lambda r: r.close_time, "amount": lambda r: r.amount, "years": lambda r: r.years,
}


@pytest.mark.parametrize("k, signal", list(enumerate(SIGNALS, start=1)))
def test_precision_and_recall(read, k, signal):
    """Every signal is right wherever it speaks, and speaks wherever the label does."""
    counts = Counter()
    for row, label in zip(read, LABELS):
        got, wanted = SIGNALS[signal](row), label[k]
        if got not in ("", None) or wanted not in ("", None):
            counts["right" if got == wanted else f"wrong: {label[0]!r} gives {got!r}, not {wanted!r}"] += 1
    assert set(counts) == {"right"} and counts["right"] >= 3


def owners(spark, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    rows = df.select("k", clauses(F.col("t")).alias("c")).orderBy("k").collect()
    return [[(c.role, c.text) for c in r.c] for r in rows]


def test_owners(spark):
    label, postfix, prefix, heading, joined, none = owners(
        spark, "문의: 서울 강남, 장소: 부산", "10:00 설명회, 16:00 마감", "마감 7월 10일 설명회 14:00",
        "■ 신청 대상\n - 서울 기업", "관내 소재 기업, 충청남도", None)
    assert label == [("contact", "문의: 서울 강남"), ("venue", "장소: 부산")]
    assert postfix == [("event", "10:00 설명회"), ("reception", "16:00 마감")]
    assert prefix == [("reception", "마감 7월 10일"), ("event", "설명회 14:00")]
    assert heading == [("applicant", "■ 신청 대상: - 서울 기업")]
    assert joined == [("applicant", "관내 소재 기업, 충청남도")] and none == []


def test_regions_by_role(spark):
    df = spark.createDataFrame([("s", "1", "서울 소재 기업. 문의: 부산\n주최: 대전")], "source string, id string, text string")
    assert sorted((r.role, r.region) for r in sg.regions_by_role(df).collect()) == [
        ("applicant", "서울"), ("contact", "부산"), ("organiser", "대전")]


def test_long_texts_take_one_pass(spark):
    text = "서울 소재 기업, " * 20_000 + "10:00 설명회, " * 20_000 + "a, " * 50_000
    [found] = owners(spark, text)
    assert len(found) > 30_000
