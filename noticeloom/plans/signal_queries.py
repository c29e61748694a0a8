"""Queries on eligibility signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.clauses import clauses
from ..functions.intervals import interval
from ..functions.text import strip_html
from ..operators import judge as j, report as r, signals as sg, three_valued as tv
from ..session import shuffle_tasks
from .derived import SQL_HOST, day
from .registry import query, table
from .text_queries import SQL_TEXT


def _call_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the text of a call: (source, id, text).

    Every text has the address of a contact and the time of a briefing; some name supporters from all
    over the country, or the state of the economy by the name of a region.
    """
    status, price, odd = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_custkey") % 2 == 1
    target = (
        F.when((status == "O") & odd, "신청대상: 예비창업자 및 창업 3년 미만 기업")
        .when(status == "O", "신청대상: 예비창업자 및 창업 3년 이내 기업")
        .when(status == "F", "제출서류: 사업자등록증, 재무제표")
        .otherwise("자세한 내용은 첨부파일(HWP) 참조")
    )
    region = F.when(price > 250000, "전국 접수, 비수도권 소재 기업만").when(
        F.col("o_custkey") % 3 == 0, "관내 소재 기업, 충청남도 또는 대전").otherwise("전국 지자체가 후원")
    man = F.floor(price / 10000).cast("string")
    money = F.concat(
        F.lit("총 사업비 90억원, 최대 "), man, F.lit("만원, 지원기간 "), (F.col("o_orderkey") % 12 + 1).cast("string"), F.lit("개월"))
    rest = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "투자유치 기업 우대. 매출 실적 보유. 중복수혜 불가. 수료자 제외")
        .when(F.col("o_orderpriority") == "2-HIGH", "법인 설립 예정자. 본사 이전 기업. 입주공간 제공")
        .otherwise("경기 침체 극복")
    )
    close = F.when(odd, F.concat(F.lit("접수마감 "), day("o_orderdate"), F.lit(" 16:00, 설명회 14:00"))).otherwise(
        F.concat(F.lit("10:00 설명회, "), day("o_orderdate"), F.lit(" 16:00 마감")))
    phone = F.concat(F.lit("문의: 서울특별시 강남구 02-123-"), F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"))
    # Reading a text costs far more than moving the few columns it is made of, and the table is one file:
    # these columns are dealt to as many tasks as a shuffle has, the texts are made and read there. The number
    # is given, or adaptive execution would join the tasks by the few bytes they read.
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    ).repartition(shuffle_tasks(spark), "o_orderkey")
    return orders.select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderkey").cast("string").alias("id"),
        F.concat_ws("\n", target, region, money, rest, close, phone).alias("text"),
    )


SQL_CALLS = """
calls AS (
  SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id,
    CASE o_orderstatus WHEN 'O' THEN 'yes' WHEN 'F' THEN 'no' ELSE 'unknown' END AS pre_founder,
    CASE WHEN o_totalprice > 250000 THEN 'nationwide' ELSE 'unknown' END AS apply_region,
    CASE WHEN o_totalprice > 250000 THEN 'non_capital' WHEN o_custkey % 3 = 0 THEN 'local' ELSE 'unknown' END AS location_rule,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'yes' ELSE 'unknown' END AS space,
    CASE WHEN o_orderpriority = '1-URGENT' THEN ['duplicate_benefit', 'graduates'] ELSE ['unknown'] END AS exclusions,
    CASE o_orderpriority WHEN '1-URGENT' THEN ['investment', 'sales'] WHEN '2-HIGH' THEN ['incorporation', 'relocation']
                         ELSE ['unknown'] END AS triggers,
    CAST(floor(o_totalprice / 10000) * 10000 AS BIGINT) AS amount, CAST(o_orderkey % 12 + 1 AS BIGINT) AS months,
    CASE WHEN o_orderstatus = 'O' THEN 3 END AS max_years,
    CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_custkey % 2 = 1 THEN '(,3)' ELSE '(,3]' END END AS years, CAST(NULL AS VARCHAR) AS sales,
    '16:00' AS close_time, CASE WHEN o_totalprice <= 250000 AND o_custkey % 3 = 0 THEN '충남,대전' ELSE '' END AS regions,
    3 AS rules_version, CASE WHEN o_orderstatus = 'P' THEN 'yes' ELSE 'no' END AS attachment_only
  FROM orders)
"""


@query(f"""WITH {SQL_CALLS} SELECT * EXCLUDE (exclusions, triggers),
  array_to_string(list_filter(exclusions, lambda v: v <> 'unknown'), ',') AS exclusion,
  array_to_string(list_filter(triggers, lambda v: v <> 'unknown'), ',') AS trigger FROM calls""")
def call_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = sg.signals_wide(_call_texts(spark, sf_dir))
    return wide.withColumns({
        "exclusion": F.array_join("exclusion", ","), "trigger": F.array_join("trigger", ","),
        "regions": F.array_join("regions", ","),
        "amount": F.col("amount").cast("bigint"), "months": F.col("months").cast("bigint"),
        "attachment_only": F.when(F.col("attachment_only"), "yes").otherwise("no"),
    })


@query(f"""WITH {SQL_CALLS}, long AS (
  SELECT source, id, years, signal, value FROM calls UNPIVOT (value FOR signal IN
    (pre_founder, apply_region, location_rule, space))
  UNION ALL SELECT source, id, years, 'exclusion', unnest(exclusions) FROM calls
  UNION ALL SELECT source, id, years, 'trigger', unnest(triggers) FROM calls)
SELECT source, id, signal, value, 3 AS rules_version,
  CASE WHEN value = 'unknown' THEN ''
    WHEN signal = 'pre_founder' AND value = 'yes' THEN '신청대상: 예비창업자 및 창업 3년 ' || CASE WHEN years = '(,3)' THEN '미만' ELSE '이내' END || ' 기업'
    WHEN signal = 'pre_founder' THEN '제출서류: 사업자등록증, 재무제표'
    WHEN signal = 'apply_region' OR value = 'non_capital' THEN '전국 접수, 비수도권 소재 기업만'
    WHEN signal = 'location_rule' THEN '관내 소재 기업, 충청남도 또는 대전'
    WHEN signal = 'space' THEN '입주공간 제공'
    WHEN value = 'duplicate_benefit' THEN '중복수혜 불가' WHEN value = 'graduates' THEN '수료자 제외'
    WHEN value = 'investment' THEN '투자유치 기업 우대' WHEN value = 'sales' THEN '매출 실적 보유'
    WHEN value = 'relocation' THEN '본사 이전 기업'
    ELSE '법인 설립 예정자' END AS evidence FROM long""")
def signal_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signal of every text, with the sentence that shows it."""
    return sg.extract_signals(_call_texts(spark, sf_dir))


@query("""
SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id, region FROM (
  SELECT *, unnest(['충남', '대전']) AS region FROM orders WHERE o_totalprice <= 250000 AND o_custkey % 3 = 0
  UNION ALL SELECT *, '서울' FROM orders)""")
def named_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region a text names, in whatever role."""
    return sg.named_regions(_call_texts(spark, sf_dir))


@query("""
SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id, role, region FROM (
  SELECT *, 'applicant' AS role, unnest(['충남', '대전']) AS region FROM orders WHERE o_totalprice <= 250000 AND o_custkey % 3 = 0
  UNION ALL SELECT *, 'contact', '서울' FROM orders)""")
def region_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whose region it is: that of applicants, or that of a contact."""
    return sg.regions_by_role(_call_texts(spark, sf_dir))


@query("""
WITH owners AS (
  SELECT CASE o_orderstatus WHEN 'O' THEN ['applicant'] WHEN 'F' THEN ['documents'] ELSE [''] END
    || CASE WHEN o_totalprice > 250000 THEN ['reception', 'applicant'] WHEN o_custkey % 3 = 0 THEN ['applicant'] ELSE ['organiser'] END
    || ['budget', 'support']
    || CASE o_orderpriority WHEN '1-URGENT' THEN ['budget', 'budget', '', ''] WHEN '2-HIGH' THEN ['', '', ''] ELSE [''] END
    || CASE WHEN o_custkey % 2 = 1 THEN ['reception', 'event'] ELSE ['event', 'reception'] END || ['contact'] AS roles, o_orderpriority
  FROM orders)
SELECT source, role, count(*) AS n FROM (SELECT o_orderpriority AS source, unnest(roles) AS role FROM owners) GROUP BY ALL""")
def clause_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many clauses each owner has, per source."""
    texts = _call_texts(spark, sf_dir)
    return texts.select("source", F.explode(F.transform(clauses(F.col("text")), lambda c: c["role"])).alias("role")).groupBy(
        "source", "role").agg(F.count("*").alias("n"))


@query(r"""
SELECT doc_id AS id, kind, contact FROM (
  SELECT doc_id, 'email' AS kind, unnest(list_distinct(regexp_extract_all(text,
    '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}'))) AS contact FROM documents
  UNION ALL
  SELECT doc_id, 'phone', unnest(list_distinct(regexp_extract_all(text, '\b0\d{1,2}-\d{3,4}-\d{4}\b'))) FROM documents)""")
def document_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("id"), "text")
    return sg.contacts(docs).drop("source")


@query("""
SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id,
       '02-123-' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS contact FROM orders""")
def call_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.contacts(_call_texts(spark, sf_dir)).drop("kind")


@query("""
WITH known AS (SELECT doc_id, 'quality' AS signal, CAST(quality AS VARCHAR) AS value FROM labels
               UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels)
SELECT d.source, d.doc_id AS id, d.signal, coalesce(k.value, 'unknown') AS value
FROM (SELECT source, doc_id, unnest(['quality', 'toxic']) AS signal FROM documents) d
LEFT JOIN known k ON k.doc_id = d.doc_id AND k.signal = d.signal""")
def unknown_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("id"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.explode(F.array(*[
            F.struct(F.lit(s).alias("signal"), F.col(s).cast("string").alias("value"))
            for s in ("quality", "toxic")
        ])).alias("hit"),
    ).select("id", "hit.*")
    known = labels.join(docs, "id").select("source", "id", "signal", "value")
    return sg.fill_unknown(docs, known, ("quality", "toxic"))


@query(f"""
SELECT page_id, CAST(length(text) AS BIGINT) AS n_chars,
  CASE WHEN length(text) < 1500 AND regexp_matches(text, '첨부\\s*파일|붙임|HWP|hwp|PDF|pdf') THEN 'yes' ELSE 'no' END AS attachment_only
FROM (SELECT page_id, {SQL_TEXT} || '붙임.pdf' AS text FROM pages)""")
def attachment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page texts with a mention of a file: only the short ones are attachment-only."""
    text = F.concat(strip_html(F.col("html")), F.lit("붙임.pdf"))
    return table(spark, sf_dir, "pages").select("page_id", text.alias("text")).select(
        "page_id", F.char_length("text").cast("bigint").alias("n_chars"),
        F.when(sg.attachment_only(F.col("text"), 1500), "yes").otherwise("no").alias("attachment_only"),
    )


@query(f"""
SELECT d.doc_id AS id, CASE WHEN p.url IS NULL THEN 'no url' ELSE p.url END AS url
FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id WHERE p.url IS NULL""")
def missing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows whose page is not known: the check names every one of them."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    urls = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    return r.missing_urls(docs.join(urls, "id", "left")).select("id", F.lit("no url").alias("url"))


@query(f"""
SELECT p.page_id AS id, {SQL_HOST} AS source, coalesce(md5(d.text), 'none') AS digest
FROM pages p LEFT JOIN documents d ON d.doc_id = p.page_id""")
def attached_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as candidates with the document of the same number as detail text."""
    host = F.regexp_replace("url", "^https?://([^/]+).*", "$1")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), host.alias("source"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    details = docs.join(pages, "id").select("source", "id", "text")
    return r.attach_details(pages, details).select(
        "id", "source", F.coalesce(F.md5("text"), F.lit("none")).alias("digest")
    )


# Judging: nations are applicants with needs, a stage and a region, one wants everything and one does
# not say; orders are announcements whose priority names the field, with the call texts above as
# details. The field of low orders names no offer that a rule knows.
SQL_JUDGED_CALLS = f"""
{SQL_CALLS},
applicant AS (
  SELECT n_name AS profile_id, n_nationkey AS k,
         CASE n_nationkey % 3 WHEN 0 THEN 'pre_founder' WHEN 1 THEN 'sole_owner' ELSE 'corporation' END AS stage,
         CASE WHEN n_nationkey = 24 THEN [] WHEN n_regionkey = 0 THEN ['funding'] WHEN n_regionkey = 1 THEN ['space']
              WHEN n_regionkey = 2 THEN ['mentoring'] WHEN n_regionkey = 3 THEN ['funding', 'space'] ELSE ['coverage'] END AS needs,
         CASE WHEN n_nationkey % 2 = 0 THEN '충남' ELSE '서울' END AS home,
         CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey % 7 END AS age FROM nation),
offer AS (
  SELECT c.*, CASE c.source WHEN '1-URGENT' THEN 'funding' WHEN '2-HIGH' THEN 'space' WHEN '5-LOW' THEN 'none' ELSE 'mentoring' END AS offers
  FROM calls c JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = c.id AND o.o_orderdate >= DATE '1995-06-17'),
pair AS (
  SELECT a.*, c.*,
         CASE WHEN list_contains(a.needs, 'coverage') OR list_contains(a.needs, c.offers) THEN 'yes' ELSE 'unknown' END AS need_state,
         CASE WHEN c.regions <> '' OR c.apply_region = 'nationwide' THEN 'yes' ELSE 'unknown' END AS region_state
  FROM applicant a JOIN offer c
  ON (list_contains(a.needs, 'coverage') OR list_contains(a.needs, c.offers) OR len(a.needs) = 0 OR c.offers = 'none')
     AND (c.regions = '' OR a.home = '충남')),
state AS (
  SELECT profile_id, source, id, need_state, region_state, unnest([
    CASE WHEN pre_founder = 'no' THEN CASE WHEN stage = 'pre_founder' THEN 'unmet_trigger' ELSE 'met' END END,
    CASE WHEN years IS NOT NULL THEN
      CASE WHEN age IS NULL THEN 'unknown' WHEN age < 3 OR (age = 3 AND years = '(,3]') THEN 'met' ELSE 'unmet_fixed' END END,
    CASE WHEN location_rule = 'non_capital' THEN CASE WHEN home = '충남' THEN 'met' ELSE 'unmet_trigger' END END,
    CASE WHEN source = '1-URGENT' THEN 'unknown' END, CASE WHEN source = '1-URGENT' THEN 'unknown' END,
    CASE WHEN source = '1-URGENT' THEN 'unknown' END, CASE WHEN source = '1-URGENT' THEN 'unknown' END,
    CASE WHEN source = '2-HIGH' THEN CASE WHEN stage = 'corporation' THEN 'met' ELSE 'unmet_trigger' END END,
    CASE WHEN source = '2-HIGH' THEN 'unknown' END]) AS state FROM pair),
judged AS (
  SELECT profile_id, source, id, need_state, region_state, count(*) FILTER (state = 'unknown') AS unknowns,
         count(*) FILTER (state LIKE 'unmet%') AS unmet, count(*) FILTER (state = 'unmet_fixed') AS fixed
  FROM state GROUP BY ALL)
"""


def _applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    words = F.when(key == 24, F.array().cast("array<string>"))
    for k, names in enumerate((("자금",), ("공간",), ("멘토링",), ("자금", "공간"), ("전부",))):
        words = words.when(region == k, F.array(*map(F.lit, names)))
    stage = F.when(key % 3 == 0, "pre_founder").when(key % 3 == 1, "sole_owner").otherwise("corporation")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("profile_id"), stage.alias("stage"),
        F.when(key % 3 != 0, (key % 7).cast("int")).alias("years"), words.alias("needs"),
        F.array(F.when(key % 2 == 0, "충남").otherwise("서울")).alias("regions"),
        F.lit(None).cast("array<string>").alias("movable_regions"),
    )


def _announced(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = F.col("o_orderpriority")
    field = F.when(field == "1-URGENT", "사업화 자금").when(field == "2-HIGH", "입주 공간").when(
        field == "5-LOW", "도약 프로그램").otherwise("멘토링")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Call "), "o_orderkey").alias("title"), field.alias("field"), day("o_orderdate").alias("apply_end"),
    )


@query(f"""WITH {SQL_JUDGED_CALLS}
SELECT profile_id, source, CASE WHEN unmet = 0 THEN 'A' WHEN fixed = 0 THEN 'B' ELSE 'rejected' END AS tier, need_state, region_state,
       count(*) AS items, CAST(sum(unknowns) AS BIGINT) AS unknowns, CAST(sum(unmet) AS BIGINT) AS unmet, 3 AS rules_version
FROM judged GROUP BY ALL""")
def judged_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From announcements and their texts to tiers, counted per applicant, source, tier and what is known."""
    judged = j.judge(
        _applicants(spark, sf_dir), _announced(spark, sf_dir), _call_texts(spark, sf_dir), F.lit("1995-06-17").cast("date"))
    return judged.groupBy("profile_id", "source", "tier", "need_state", "region_state", "rules_version").agg(
        F.count("*").alias("items"), F.sum("unknowns").alias("unknowns"), F.sum("unmet").alias("unmet"))


@query(f"""WITH {SQL_JUDGED_CALLS}
SELECT profile_id, source, need_state, region_state,
       CASE WHEN years IS NULL OR age IS NULL THEN 'unknown' ELSE 'yes' END AS years_state, count(*) AS items
FROM pair WHERE years IS NULL OR age IS NULL OR age < 3 OR (age = 3 AND years = '(,3]') GROUP BY ALL""")
def known_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-valued match by need, region and age: less than and up to three years differ."""
    announced = _announced(spark, sf_dir).filter(F.col("apply_end") >= "1995-06-17")
    calls = j.describe_calls(announced, _call_texts(spark, sf_dir))
    found = tv.match_known(_applicants(spark, sf_dir), calls, by_years=True)
    return found.groupBy("profile_id", "source", "need_state", "region_state", "years_state").agg(F.count("*").alias("items"))


SQL_SPAN = """CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '[' || s_suppkey * 10 || ',' || s_suppkey * 10 + 2000 || ')'
  WHEN 2 THEN '(' || s_suppkey * 10 || ',)' WHEN 3 THEN '(,' || s_suppkey * 10 || ']' ELSE '(' || s_suppkey * 20 - 900 || ',' || s_suppkey * 20 || ']' END"""


@query(f"""
WITH s AS (SELECT s_suppkey, s_nationkey, {SQL_SPAN} AS span, s_suppkey * 10 AS k FROM supplier),
c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 0 THEN round(c_acctbal) END AS v FROM customer)
SELECT c_custkey AS customer, s_suppkey AS supplier, CASE WHEN v IS NULL OR span IS NULL THEN 'unknown' ELSE 'yes' END AS state
FROM c JOIN s ON c_nationkey = s_nationkey
WHERE v IS NULL OR span IS NULL OR CASE s_suppkey % 5 WHEN 1 THEN v >= k AND v < k + 2000 WHEN 2 THEN v > k WHEN 3 THEN v <= k
      ELSE v > 2 * k - 900 AND v <= 2 * k END""")
def range_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of customers in ranges of suppliers of their nation, with open, closed and unknown bounds."""
    k = F.col("s_suppkey")
    parts = [
        F.lit(None).cast("string"), F.format_string("[%d,%d)", k * 10, k * 10 + 2000), F.format_string("(%d,)", k * 10),
        F.format_string("(,%d]", k * 10), F.format_string("(%d,%d]", k * 20 - 900, k * 20)]
    ranges = table(spark, sf_dir, "supplier").select(
        k.alias("supplier"), F.col("s_nationkey").alias("nation"), interval(F.get(F.array(*parts), (k % 5).cast("int"))).alias("bounds"))
    values = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("nation"),
        F.when(F.col("c_acctbal") > 0, F.round("c_acctbal")).alias("value"))
    return tv.interval_join(values, ranges, ["nation"], "value", "bounds").select("customer", "supplier", "state")
