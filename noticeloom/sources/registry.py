"""Known sources and the rules that pick sources for a need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_SOURCE = "kstartup"

# Source, name, host, verified, reason for its state.
SOURCES = (
    ("kstartup", "K-Startup", "k-startup.go.kr", True, "board reader"),
    ("bizinfo", "기업마당", "bizinfo.go.kr", True, "board reader"),
    ("nipa", "정보통신산업진흥원", "nipa.kr", True, "board reader"),
    ("kocca", "한국콘텐츠진흥원", "kocca.kr", True, "board reader"),
    ("smtech", "중소기업 기술개발사업", "smtech.go.kr", True, "board reader"),
    ("nia", "한국지능정보사회진흥원", "nia.or.kr", False, "not verified"),
    ("iitp", "정보통신기획평가원", "iitp.kr", False, "not verified"),
    ("iris", "범부처 국가 R&D 통합", "iris.go.kr", False, "not verified"),
    ("ctia", "충남콘텐츠진흥원", "ctia.kr", False, "not verified"),
    ("sba", "서울산업진흥원", "", False, "not verified, site not recorded"),
    ("gcon", "경기콘텐츠진흥원", "", False, "not verified, site not recorded"),
    ("dip", "대구디지털혁신진흥원", "", False, "not verified, site not recorded"),
    ("technopark", "지역 테크노파크", "", False, "one per region, not verified"),
    ("region_body", "지역 경제·산업진흥원", "", False, "one per region, not verified"),
    ("ccei", "창조경제혁신센터", "ccei.creativekorea.or.kr", False, "list is loaded by script"),
    ("gov24", "보조금24", "gov.kr", False, "needs a login"),
    ("bizwello", "웰로비즈", "bizwello.com", False, "private service"),
    ("nextunicorn", "넥스트유니콘", "nextunicorn.kr", False, "private service"),
)

# Need of a profile, source to add.
SOURCE_RULES = (
    ("coverage", "bizinfo"),
    ("ai_ict", "nipa"),
    ("ai_ict", "nia"),
    ("content", "kocca"),
    ("rnd", "smtech"),
)

# Region of a profile, regional body to add.
REGION_RULES = (("충남", "ctia"), ("서울", "sba"), ("경기", "gcon"), ("대구", "dip"))


def read_sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(SOURCES), "source string, name string, host string, verified boolean, note string"
    )


def read_source_rules(spark: SparkSession, regional: bool = False) -> DataFrame:
    """(need, source); with `regional`, regions of a profile are needs of their own."""
    rules = [*SOURCE_RULES, *REGION_RULES] if regional else list(SOURCE_RULES)
    return spark.createDataFrame(rules, "need string, source string")
