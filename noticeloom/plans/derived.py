"""Survey tables derived from the given tables, as DataFrames and as the same SQL.

Every derivation covers its whole table: a row is given to one run or to both, never to none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import url_host
from .registry import table

TITLE = r"<title>((?s:.*?))</title>"


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def sql_unescape(text: str) -> str:
    """SQL for the references that occur in the page table; `&amp;` last, `;` may be cut off."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def sql_clean(text: str) -> str:
    return f"trim(regexp_replace({sql_unescape(text)}, '\\s+', ' ', 'g'))"


SQL_TITLE = r"regexp_extract(html, '<title>([\s\S]*?)</title>', 1)"
SQL_HOST = r"regexp_replace(url, '^https?://([^/]+).*', '\1')"


# Page runs: mobile hosts were crawled in the current run only, blogs in the previous run only.
# Of the other pages those with a query string are current, those with a fragment previous, and
# the rest is in both. French pages got a later deadline.

def page_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, sf_dir, "pages").select(
        url_host(F.col("url")).alias("source"), F.col("page_id").cast("string").alias("id"),
        F.col("page_id").alias("pos"), "url",
    )
    mobile, blog = F.col("source").startswith("m."), F.col("source").startswith("blog.")
    asked, marked = F.col("url").contains("?"), F.col("url").contains("#")
    in_prev = blog | (~mobile & ~asked)
    in_curr = mobile | (~blog & (asked | ~marked))
    start, later = F.lit("2026-07-01").cast("date"), F.col("url").contains("/fr/")
    days = (F.col("pos") % 30).cast("int")
    ends = F.date_add(start, days)
    moved = F.date_add(start, days + F.when(later, 3).otherwise(0))
    return (
        pages.filter(in_prev).withColumn("apply_end", ends.cast("string")),
        pages.filter(in_curr).withColumn("apply_end", moved.cast("string")),
    )


SQL_DIFF = """
coverage AS (
  SELECT source, max(p) AS in_prev, max(c) AS in_curr FROM (
    SELECT source, 1 AS p, 0 AS c FROM prev UNION ALL SELECT source, 0, 1 FROM curr) GROUP BY source),
diff AS (
  SELECT k.source, k.id, k.old_end, k.new_end, k.pos,
    CASE WHEN k.p = 1 AND k.c = 1 THEN
           CASE WHEN coalesce(old_end, '') <> coalesce(new_end, '')
                THEN 'deadline_changed' ELSE 'unchanged' END
         WHEN v.in_prev = 1 AND v.in_curr = 1 THEN CASE WHEN k.c = 1 THEN 'new' ELSE 'closed' END
         WHEN k.c = 1 THEN 'first_time' ELSE 'not_recrawled' END AS status
  FROM (SELECT coalesce(prev.source, curr.source) AS source, coalesce(prev.id, curr.id) AS id,
               prev.apply_end AS old_end, curr.apply_end AS new_end,
               coalesce(curr.pos, prev.pos) AS pos,
               CASE WHEN prev.id IS NULL THEN 0 ELSE 1 END AS p,
               CASE WHEN curr.id IS NULL THEN 0 ELSE 1 END AS c
        FROM prev FULL OUTER JOIN curr ON prev.source = curr.source AND prev.id = curr.id) k
  JOIN coverage v ON v.source = k.source)
"""

SQL_PAGE_RUNS = rf"""
page AS (
  SELECT {SQL_HOST} AS source, CAST(page_id AS VARCHAR) AS id, page_id AS pos, url FROM pages),
prev AS (
  SELECT *, strftime(DATE '2026-07-01' + CAST(pos % 30 AS INTEGER), '%Y-%m-%d') AS apply_end FROM page
  WHERE source LIKE 'blog.%' OR (source NOT LIKE 'm.%' AND url NOT LIKE '%?%')),
curr AS (
  SELECT *, strftime(DATE '2026-07-01' + CAST(pos % 30 AS INTEGER)
      + CASE WHEN url LIKE '%/fr/%' THEN 3 ELSE 0 END, '%Y-%m-%d') AS apply_end FROM page
  WHERE source LIKE 'm.%' OR (source NOT LIKE 'blog.%' AND (url LIKE '%?%' OR url NOT LIKE '%#%')))
"""


# Order runs: urgent orders are a source of the current run only, low ones of the previous run
# only. Of the others, filled ones are previous, open ones current, pending ones in both; a large
# pending order got a deadline three days later.

def order_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Order "), "o_orderkey").alias("title"),
        F.col("o_orderkey").alias("pos"), "o_orderdate", "o_orderstatus", "o_totalprice",
    )
    urgent, low = F.col("source") == "1-URGENT", F.col("source") == "5-LOW"
    in_prev = low | (~urgent & (F.col("o_orderstatus") != "O"))
    in_curr = urgent | (~low & (F.col("o_orderstatus") != "F"))
    large = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000)
    later = F.date_add("o_orderdate", F.when(large, 3).otherwise(0)).cast("string")
    url = F.concat(F.lit("https://orders.example/"), "id")
    fields = ["source", "id", "title", "apply_end", "url", "pos"]
    return (
        orders.filter(in_prev).withColumn("apply_end", day("o_orderdate"))
        .withColumn("url", url).select(*fields),
        orders.filter(in_curr).withColumn("apply_end", later)
        .withColumn("url", url).select(*fields),
    )


SQL_ORDER_RUNS = """
prev AS (
  SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS pos,
         strftime(o_orderdate, '%Y-%m-%d') AS apply_end FROM orders
  WHERE o_orderpriority = '5-LOW' OR (o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'O')),
curr AS (
  SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS pos,
         strftime(CAST(o_orderdate AS DATE)
           + CASE WHEN o_orderstatus = 'P' AND o_totalprice > 200000 THEN 3 ELSE 0 END, '%Y-%m-%d')
         AS apply_end FROM orders
  WHERE o_orderpriority = '1-URGENT' OR (o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F'))
"""


def order_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of an earlier survey: the market segment of the buyer is the profile."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"
    )
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    tier = (
        F.when(F.col("o_totalprice") > 300000, "A")
        .when(F.col("o_totalprice") > 150000, "B").otherwise("C")
    )
    return orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("profile_id"), F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").cast("string").alias("id"), tier.alias("tier"),
    )


SQL_VERDICTS = """
verdicts AS (
  SELECT c_mktsegment AS profile_id, o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_totalprice > 300000 THEN 'A' WHEN o_totalprice > 150000 THEN 'B' ELSE 'C' END AS tier
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, title) of all pages, the title still escaped."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), url_host(F.col("url")).alias("source"),
        F.regexp_extract("html", TITLE, 1).alias("title"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as crawled rows: type = source, day = page, user = id."""
    first = F.lit("2024-01-01").cast("date")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        (F.date_diff("ts", first) + 1).alias("page_no"),
        F.col("user_id").cast("string").alias("id"),
    )


SQL_EVENT_ROWS = """
crawled AS (
  SELECT event_type AS source, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS page_no,
         CAST(user_id AS VARCHAR) AS id FROM events)
"""
