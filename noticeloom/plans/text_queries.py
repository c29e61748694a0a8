"""Queries on text, dates, URLs and page scans."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dates, text as tx
from ..operators.boards import BIZINFO_URL, KOCCA_SITE, KSTARTUP_URL, NIPA_SITE, SMTECH_SITE
from ..operators.boards import detail_url
from ..operators.match import in_region, meets_need
from ..operators.report import open_on, with_days_left
from ..session import fresh_dir
from ..sources import pages as pg
from .derived import (
    SQL_EVENT_ROWS, SQL_HOST, SQL_TITLE, day, event_rows, page_titles, sql_clean, sql_unescape,
)
from .registry import query, table

AS_OF = datetime.date(1998, 6, 1)
SQL_AS_OF = "DATE '1998-06-01'"
SQL_TEXT = (
    r"regexp_replace(" + sql_unescape(
        r"regexp_replace(regexp_replace(html, '<script[\s\S]*?</script>|<style[\s\S]*?</style>', '', 'g'),"
        r" '<[^>]+>', chr(10), 'g')"
    ) + r", '\n\s*\n+', chr(10), 'g')"
)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table with a status: a URL with a fragment was not found."""
    status = F.when(F.col("url").contains("#"), 404).otherwise(200)
    return pg.read_pages(spark, f"{sf_dir}/pages.parquet").withColumn("status", status)


@query("SELECT page_id, url, length(html) AS n_chars FROM pages WHERE url NOT LIKE '%#%'")
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = pg.only_ok(_pages(spark, sf_dir))
    return ok.select("page_id", "url", F.char_length("html").cast("bigint").alias("n_chars"))


@query("SELECT page_id, 'HTTP 404' AS reason FROM pages WHERE url LIKE '%#%'")
def rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.rejected_pages(_pages(spark, sf_dir)).select("page_id", "reason")


@query(f"SELECT page_id, md5(url || chr(10) || chr(10) || {SQL_TEXT}) AS digest "
       "FROM pages WHERE url NOT LIKE '%#%'")
def detail_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = pg.detail_texts(_pages(spark, sf_dir))
    return texts.select("page_id", F.md5("text").alias("digest"))


@query(f"SELECT {SQL_HOST} AS source, count(*) AS texts, "
       f"CAST(sum(length({SQL_TEXT})) AS BIGINT) AS n_chars FROM pages GROUP BY 1")
def detail_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail texts written by source and read back."""
    pages = table(spark, sf_dir, "pages").withColumn("status", F.lit(200)).withColumn(
        "source", tx.url_host(F.col("url"))
    )
    path = fresh_dir(spark, "details")
    pg.write_details(pg.detail_texts(pages, header=False), path)
    return spark.read.parquet(path).groupBy("source").agg(
        F.count("*").alias("texts"), F.sum(F.char_length("text")).alias("n_chars")
    )


@query(f"SELECT page_id, md5({SQL_TEXT}) AS digest FROM pages")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = tx.strip_html(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text).alias("digest"))


@query(f"SELECT page_id AS id, {sql_clean(SQL_TITLE)} AS title FROM pages")
def clean_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = page_titles(spark, sf_dir)
    return titles.select("id", tx.clean(F.col("title")).alias("title"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f\x0b]+', ' ', 'g'))) AS digest FROM documents")
def collapsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(tx.collapse(F.col("text"))).alias("digest"))


@query(f"SELECT page_id AS id, 'x' || chr(160) || "
       f"{sql_unescape(f'''trim(regexp_replace({SQL_TITLE}, '{chr(92)}s+', ' ', 'g'))''')} AS title FROM pages")
def late_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unescaped last: the no-break space that a reference stands for is kept."""
    titles = page_titles(spark, sf_dir)
    padded = F.concat(F.lit(" x&nbsp;"), F.trim("title"), F.lit(" "))
    return titles.select("id", tx.clean_late(padded).alias("title"))


@query(r"SELECT page_id, md5(regexp_replace(regexp_replace(html, '<!--[\s\S]*?-->', '', 'g'), "
       r"'<[^>]+>', ' ', 'g')) AS digest FROM pages")
def inline_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = tx.strip_tags(tx.strip_comments(F.col("html")))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(bare).alias("digest"))


@query(f"SELECT {SQL_HOST} AS host, count(*) AS pages FROM pages GROUP BY 1")
def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = table(spark, sf_dir, "pages").select(tx.url_host(F.col("url")).alias("host"))
    return hosts.groupBy("host").agg(F.count("*").alias("pages"))


@query(r"SELECT page_id, substring(regexp_replace(split_part(url, '://', 2), '[^\p{L}\p{N}_]+', '_', 'g'), 1, 80) "
       "AS slug FROM pages")
def page_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", tx.slug(F.col("url")).alias("slug"))


@query(r"SELECT page_id, regexp_replace(url, '[?#].*$', '') AS bare, "
       r"regexp_replace(url, '([?#].*)?$', '') || coalesce('?' || nullif(regexp_extract(url, '\?(.*)$', 1), ''), '') AS stable "
       "FROM pages")
def stable_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session id put into each URL is removed again; a fragment goes with it."""
    url = F.col("url")
    bare = tx.drop_session(url, r"[?#].*$")
    asked = F.regexp_extract(url, r"\?(.*)$", 1)
    with_session = F.concat(
        bare, F.lit(";jsessionid=AB.n"), F.lit("1"),
        F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", bare.alias("bare"), tx.drop_session(with_session).alias("stable")
    )


SQL_SOURCES = ("kstartup", "bizinfo", "nipa", "kocca", "smtech")


@query(f"""
SELECT o_orderkey, CASE left(o_orderpriority, 1)
  WHEN '1' THEN '{KSTARTUP_URL}' || o_orderkey WHEN '2' THEN '{BIZINFO_URL}' || o_orderkey
  WHEN '3' THEN '{NIPA_SITE}/p/' || o_orderkey WHEN '4' THEN '{KOCCA_SITE}/p/' || o_orderkey
  ELSE '{SMTECH_SITE}/p/' || o_orderkey || '?k=1' END AS url FROM orders""")
def detail_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    names = F.array(*[F.lit(s) for s in SQL_SOURCES])
    source = F.element_at(names, F.substring("o_orderpriority", 1, 1).cast("int"))
    path = F.concat(F.lit("/p/"), "o_orderkey")
    path = F.when(source == "smtech", F.concat(path, F.lit(";jsessionid=A1?k=1"))).otherwise(path)
    return orders.select(
        "o_orderkey", detail_url(source, F.col("o_orderkey").cast("string"), path).alias("url")
    )


@query("""
SELECT n_nationkey, CASE WHEN r_name = 'ASIA' THEN n_name ELSE r_name || ' / ' || n_name END AS org,
       CASE WHEN r_name = 'ASIA' THEN '?' ELSE r_name END AS region
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def organisation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cells joined, an empty one left out; a default for what is missing."""
    named = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    region = F.when(F.col("r_name") == "ASIA", "").otherwise(F.col("r_name"))
    return named.select(
        "n_nationkey", tx.join_nonempty(F.array(region, "n_name")).alias("org"),
        tx.or_default(region, "?").alias("region"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y%m%d')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS other FROM orders""")
def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates printed in several forms are read back; a form without separators stays."""
    when, status = F.col("o_orderdate"), F.col("o_orderpriority")
    printed = (
        F.when(status == "1-URGENT", F.date_format(when, "yyyy.M.d"))
        .when(status == "2-HIGH", F.date_format(when, "yyyy. MM. dd."))
        .when(status == "5-LOW", F.date_format(when, "yyyy/MM/dd 16:00"))
        .otherwise(F.concat(F.lit("&nbsp;"), F.date_format(when, "yyyy-MM-dd"), F.lit("&nbsp;")))
    )
    other = F.when(F.col("o_orderstatus") == "P", F.date_format(when, "yyyyMMdd")).otherwise(
        F.date_format(when, "yyyy-M-d")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.norm_date(printed).alias("day"), dates.norm_date(other).alias("other")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       '20' || strftime(l_shipdate, '%y-%m-%d') AS day FROM lineitem""")
def short_year_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-digit years are years of this century."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        dates.norm_date(F.date_format("l_shipdate", "yy.M.d")).alias("day"),
    )


@query("""
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS apply_start,
  CASE o_orderstatus WHEN 'P' THEN CASE WHEN o_totalprice > 200000 THEN '상시' ELSE strftime(o_orderdate, '%Y-%m-%d') END
    ELSE strftime(CAST(o_orderdate AS DATE) + 10, '%Y-%m-%d') END AS apply_end,
  CASE WHEN o_orderstatus = 'P' AND o_totalprice <= 200000 THEN 3
       WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END::BIGINT AS parts
FROM orders""")
def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = day("o_orderdate"), F.date_format(F.date_add("o_orderdate", 10), "yyyy.MM.dd")
    status = F.col("o_orderstatus")
    period = (
        F.when(status == "O", F.concat(start, F.lit(" ~ "), end))
        .when(status == "F", F.concat(start, F.lit(" ∼ "), end))
        .when(F.col("o_totalprice") > 200000, "상시")
        .otherwise(F.concat_ws("~", start, end, end))
    )
    span = dates.split_period(period)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", span["apply_start"].alias("apply_start"), span["apply_end"].alias("apply_end"),
        dates.period_parts(period).cast("bigint").alias("parts"),
    )


def _deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as announcements: a pending one has no date but a word."""
    end = F.when(F.col("o_orderstatus") == "P", "상시").otherwise(day("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", end.alias("apply_end"))


SQL_END = "CASE WHEN o_orderstatus = 'P' THEN '상시' ELSE strftime(o_orderdate, '%Y-%m-%d') END"


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -99999
         ELSE date_diff('day', {SQL_AS_OF}, CAST(o_orderdate AS DATE)) END AS days_left,
  CASE WHEN o_orderstatus <> 'P' AND date_diff('day', {SQL_AS_OF}, CAST(o_orderdate AS DATE)) BETWEEN 0 AND 3
       THEN 'yes' ELSE 'no' END AS imminent FROM orders""")
def days_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = with_days_left(_deadlines(spark, sf_dir), AS_OF)
    return flagged.select(
        "o_orderkey", F.coalesce("days_left", F.lit(-99999)).cast("bigint").alias("days_left"),
        F.when(F.col("imminent"), "yes").otherwise("no").alias("imminent"),
    )


@query(f"SELECT o_orderkey, {SQL_END} AS apply_end FROM orders "
       f"WHERE o_orderstatus = 'P' OR CAST(o_orderdate AS DATE) >= {SQL_AS_OF}")
def open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past deadlines go, unknown ones stay."""
    return open_on(_deadlines(spark, sf_dir), AS_OF)


@query(r"SELECT page_id, regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) AS id FROM pages "
       r"WHERE regexp_matches(url, '/[0-9]+(?:[?#].*)?$')")
def valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"/([^/?#]*)(?:[?#].*)?$", 1).alias("id")
    )
    return ids.filter(pg.valid_id(F.col("id")))


@query(rf"SELECT page_id, url FROM pages "
       rf"WHERE regexp_matches({SQL_HOST}, '(^|\.)example\.(com|net)$')")
def allowed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pg.allowed_host(pages, ["example.com", "example.net"])


@query("""
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE') OR c_mktsegment = 'BUILDING'""")
def region_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as announcements: the segment BUILDING is nationwide, others have a region."""
    placed = (
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    region = F.when(F.col("c_mktsegment") == "BUILDING", "전국").otherwise(F.col("r_name"))
    home, movable = F.array(F.lit("ASIA")), F.array(F.lit("EUROPE"))
    return placed.filter(in_region(region, home, movable)).select("c_custkey", "n_name")


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_name, '(^| )(ring|bolt)( |$)')")
def need_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    needs = F.array(F.lit("ring"), F.lit("bolt"))
    offers = F.split("p_name", " ")
    return table(spark, sf_dir, "part").filter(meets_need(offers, needs)).select("p_partkey")


@query(f"WITH {SQL_EVENT_ROWS} SELECT source, page_no, count(*) AS n FROM crawled "
       "WHERE (source <> 'click' OR page_no <= 10) AND (source <> 'view' OR page_no <= 20) GROUP BY 1, 2")
def capped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources have caps inside their range of pages, the others none."""
    capped = pg.page_cap(event_rows(spark, sf_dir), {"click": 10, "view": 20})
    return capped.groupBy("source", "page_no").agg(F.count("*").alias("n"))
