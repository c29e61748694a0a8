"""Queries that cut records out of pages: the link pages, and board pages made from tables.

The board pages are list pages in the markup of a board, written by Spark from whole tables, up to
15 records each. What is read from them must be what the table says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import markup as mk
from ..operators import boards as b
from ..operators.crawl import kept_rows, page_yield as yields, stop_pages as stops
from ..operators.dedup import dedup_last
from ..operators.extract import extract_rows
from ..session import fresh_dir
from ..sources.pages import read_pages
from .derived import SQL_EVENT_ROWS, SQL_HOST, day, event_rows
from .registry import query, table
from .survey import collect

LINK = r'<li><a href="[^"]*">(?s:.*?)</a></li>'
PAGE_ROWS = 15


@query(r"""
SELECT page_id, CAST(n - 1 AS BIGINT) AS pos, regexp_extract(links[n], 'href="([^"]*)"', 1) AS href,
       regexp_extract(links[n], '>([^<]+)</a>', 1) AS label
FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS n FROM (
  SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[\s\S]*?</a></li>') AS links FROM pages))
WHERE links[n] LIKE '%href="/%'""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks by pattern, an anchor test, then fields by capture group."""
    found = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(mk.match_blocks(F.col("html"), LINK)).alias("pos", "block")
    )
    block = F.col("block")
    return found.filter(mk.has_anchor(block, 'href="/')).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"),
        mk.field(block, r'href="([^"]*)"').alias("href"), mk.field(block, ">([^<]+)</a>").alias("label"),
    )


@query(r"""
SELECT page_id, CAST(n - 2 AS BIGINT) AS pos, regexp_extract(parts[n], '^<a href="([^"]*)"', 1) AS href
FROM (SELECT page_id, parts, unnest(range(2, len(parts) + 1)) AS n FROM (
  SELECT page_id, string_split(substring(html, instr(html, '<nav>') + 5), '<li>') AS parts FROM pages
  WHERE html LIKE '%<nav>%'))""")
def region_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the markup after the marker, split at a delimiter."""
    region = mk.cut_region(F.col("html"), "<nav>")
    found = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(mk.split_blocks(region, "<li>")).alias("pos", "block")
    )
    return found.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"),
        mk.field(F.col("block"), r'^<a href="([^"]*)"').alias("href"),
    )


@query(r"""SELECT page_id, coalesce(regexp_extract_all(html, 'href="([^"]*)"', 1)[-1], '') AS href FROM pages""")
def last_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", mk.last_match(F.col("html"), r'href="([^"]*)"').alias("href")
    )


@query(rf"""
WITH links AS (
  SELECT {SQL_HOST} AS source, page_id, n, regexp_extract(links[n], 'href="([^"]*)"', 1) AS href
  FROM (SELECT url, page_id, links, unnest(range(1, len(links) + 1)) AS n FROM (
    SELECT url, page_id, regexp_extract_all(html, '<li><a href="[^"]*">[\s\S]*?</a></li>') AS links FROM pages)))
SELECT source, href, max(page_id) AS last_page, min(page_id) AS first_page FROM links GROUP BY 1, 2""")
def distinct_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a host once, with the value of the last page and the place of the first."""
    found = table(spark, sf_dir, "pages").select(
        F.regexp_replace("url", "^https?://([^/]+).*", "$1").alias("source"), "page_id",
        F.posexplode(mk.match_blocks(F.col("html"), LINK)).alias("pos", "block"),
    ).select(
        "source", mk.field(F.col("block"), r'href="([^"]*)"').alias("href"), "page_id", "pos"
    )
    once = dedup_last(found, ["source", "href"], ["page_id", "pos"])
    return once.select(
        "source", "href", F.col("page_id").alias("last_page"),
        F.col("first_pos.page_id").alias("first_page"),
    )


@query("""
SELECT c_custkey, CAST(4 AS BIGINT) AS n, c_name AS name, 'A & ' || c_mktsegment AS segment,
       '' AS beyond, CASE WHEN c_acctbal < 0 THEN '' ELSE '~' || c_nationkey END AS marked
FROM customer""")
def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a table row: tags blanked, references decoded, white space collapsed."""
    marked = F.when(F.col("c_acctbal") < 0, "-").otherwise(F.concat(F.lit("~"), "c_nationkey"))
    row = F.concat(
        F.lit("<tr><td>"), "c_custkey", F.lit('</td><td class="n"><b>'), "c_name",
        F.lit("</b></td>\n<td>A &amp;\n&nbsp; "), "c_mktsegment", F.lit("</td><td>"), marked,
        F.lit("</td></tr>"),
    )
    cut = table(spark, sf_dir, "customer").select("c_custkey", mk.cells(row).alias("cells"))
    cells = F.col("cells")
    return cut.select(
        "c_custkey", F.size(cells).cast("bigint").alias("n"), mk.cell(cells, 1).alias("name"),
        mk.cell(cells, 2).alias("segment"), mk.cell(cells, 3, 6).alias("beyond"),
        mk.first_where(cells, lambda c: c.contains("~")).alias("marked"),
    )


def _list_pages(rows: DataFrame, key: str, block: Column, head: str, tail: str) -> DataFrame:
    """Blocks as list pages (page_no, status, html). A page holds at most PAGE_ROWS of a key range."""
    page = F.floor(F.col(key) / PAGE_ROWS).cast("int") + 1
    return (
        rows.select(page.alias("page_no"), F.struct(F.col(key), block.alias("block")).alias("b"))
        .groupBy("page_no").agg(F.array_sort(F.collect_list("b")).alias("bs"))
        .select(
            "page_no", F.lit(200).alias("status"),
            F.concat(F.lit(head), F.array_join("bs.block", "\n"), F.lit(tail)).alias("html"),
        )
    )


def _html(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def kstartup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    block = _html(
        '<li class="notice"><a href="javascript:go_view(', key, ')"><span class="flag type02">\n A&amp;',
        F.col("o_orderpriority"), ' </span><span class="flag day"> D-7</span><p class="tit">\n Order&nbsp;',
        key, '  call</p><span class="list"><i class="x"></i>Prog &lt;', F.col("o_orderstatus"),
        '&gt;</span><span class="list"><i></i>Org  ', F.col("o_custkey").cast("string"),
        '</span><span class="list"><i></i>시작일자 ', day("o_orderdate"),
        '</span><span class="list"><i></i>마감일자 ', F.date_format("o_orderdate", "yyyy.MM.dd"),
        '</span><span class="flag_agency">public</span></li><li>no link</li>',
    )
    head = '<li><a onclick="go_view(9)"><p class="tit">Featured</p></a></li><ul id="bizPbancList">'
    return _list_pages(_orders(spark, sf_dir), "o_orderkey", block, head, "</ul>")


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "pbancSn", 'A&' || o_orderpriority AS category, 'D-7' AS dday,
  'Order' || chr(160) || o_orderkey || ' call' AS title, 'Prog <' || o_orderstatus || '>' AS program,
  'Org ' || o_custkey AS org, strftime(o_orderdate, '%Y-%m-%d') AS start,
  strftime(o_orderdate, '%Y.%m.%d') AS deadline, 'public' AS agency_type,
  '{b.KSTARTUP_URL}' || o_orderkey AS url FROM orders""")
def kstartup_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_rows(kstartup_pages(spark, sf_dir), b.KSTARTUP).drop("page_no", "pos")


def bizinfo_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    agency = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name"))
    period = F.when(F.col("c_mktsegment") == "BUILDING", "상시").otherwise(
        "2026-07-07 ~ 2026. 7. 17."
    )
    block = _html(
        "<tr><td>1</td><td>", F.col("c_mktsegment"), '</td><td><a href="/sii/view.do?pblancId=PBLN_',
        number, '&amp;x=1">\n  Fund&nbsp;&amp; <b>', F.col("c_name"), "</b></a></td><td>", period,
        "</td><td>Ministry</td><td> ", agency, " </td><td>2026.07.01</td><td>5</td></tr>",
    )
    return _list_pages(
        table(spark, sf_dir, "customer"), "c_custkey", block,
        "<table><tr><th>no</th></tr><tr><td>no link</td></tr>", "</table>",
    )


@query(f"""
SELECT 'bizinfo' AS source, 'PBLN_' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS id,
  'Fund & <b>' || c_name || '</b>' AS title, c_mktsegment AS field,
  CASE WHEN c_acctbal < 0 THEN 'Ministry' ELSE 'Ministry / ' || c_name END AS org,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '2026-07-07' END AS apply_start,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '상시' ELSE '2026-07-17' END AS apply_end,
  '2026.07.01' AS reg_date,
  '{b.BIZINFO_URL}PBLN_' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS url FROM customer""")
def bizinfo_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_rows(bizinfo_pages(spark, sf_dir), b.BIZINFO).drop("page_no", "pos")


def nipa_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    registered = F.when(
        F.col("p_size") > 25, '<span class="bco">2026-06-30</span><span class="bco"> 2026-07-02 </span>'
    ).otherwise("")
    block = _html(
        '<tr><td>3</td><td><a href="/home/2-2/', key, '"><!-- new -->', F.col("p_name"), "&amp;AI",
        '</a><span class="box blue">', F.col("p_type"), "</span><p>신청기간 : 2026.07.01 ~ 2026.",
        F.col("p_size").cast("string"), ".20</p></td><td>", registered, "</td></tr>",
    )
    return _list_pages(table(spark, sf_dir, "part"), "p_partkey", block, "<table>", "</table>")


@query("""
SELECT 'nipa' AS source, CAST(p_partkey AS VARCHAR) AS id, p_name || '&AI' AS title, p_type AS field,
  'NIPA' AS org, '2026-07-01' AS apply_start, '2026-' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-20' AS apply_end,
  CASE WHEN p_size > 25 THEN '2026-07-02' ELSE '' END AS reg_date,
  'https://www.nipa.kr/home/2-2/' || p_partkey AS url FROM part""")
def nipa_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_rows(nipa_pages(spark, sf_dir), b.NIPA).drop("page_no", "pos")


def kocca_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _html("326X", F.col("o_orderkey").cast("string"))
    short = F.date_format("o_orderdate", "yy.MM.dd")
    block = _html(
        '<tr><td><span class="category_color3">', F.col("o_orderpriority"),
        '</span></td><td><a href="/kocca/pims/view.do?intcNo=', key, '&amp;menuNo=204104">Audio  ',
        F.col("o_custkey").cast("string"), '</a></td><td data-label="공고일">', short,
        '</td><td data-label="접수기간"> ', short, " ~ ",
        F.date_format(F.date_add("o_orderdate", 14), "yy.MM.dd"), "</td></tr>",
    )
    return _list_pages(_orders(spark, sf_dir), "o_orderkey", block, "<table>", "</table>")


@query("""
SELECT 'kocca' AS source, '326X' || o_orderkey AS id, 'Audio ' || o_custkey AS title,
  o_orderpriority AS field, 'KOCCA' AS org, '20' || strftime(o_orderdate, '%y-%m-%d') AS apply_start,
  '20' || strftime(CAST(o_orderdate AS DATE) + 14, '%y-%m-%d') AS apply_end,
  '20' || strftime(o_orderdate, '%y-%m-%d') AS reg_date,
  'https://www.kocca.kr/kocca/pims/view.do?intcNo=326X' || o_orderkey || '&menuNo=204104' AS url
FROM orders""")
def kocca_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_rows(kocca_pages(spark, sf_dir), b.KOCCA).drop("page_no", "pos")


def smtech_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _html("S", F.col("o_orderkey").cast("string"))
    mark = F.when(F.col("o_orderstatus") == "P", " ∼ ").otherwise(" ~ ")
    block = _html(
        "<tr><td>Program</td><td>", F.col("o_orderpriority"),
        '</td><td><a href="/front/ifg/no/notice02_detail.do;jsessionid=AB12.n1?ancmId=', key,
        '&amp;buclCd=1">R&amp;D ', F.col("o_custkey").cast("string"), "</a></td><td>", day("o_orderdate"),
        mark, day("o_orderdate"), "</td><td>2026-06-25</td></tr>",
    )
    return _list_pages(_orders(spark, sf_dir), "o_orderkey", block, "<table>", "</table>")


@query(f"""
SELECT 'smtech' AS source, 'S' || o_orderkey AS id, 'R&D ' || o_custkey AS title,
  o_orderpriority AS field, '{b.SMTECH_ORG}' AS org,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS apply_start,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS apply_end,
  '2026-06-25' AS reg_date,
  'https://www.smtech.go.kr/front/ifg/no/notice02_detail.do?ancmId=S' || o_orderkey || '&buclCd=1' AS url
FROM orders""")
def smtech_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_rows(smtech_pages(spark, sf_dir), b.SMTECH).drop("page_no", "pos")


def _board_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages of all boards, kept as a page table by source."""
    made = {
        "kstartup": kstartup_pages, "bizinfo": bizinfo_pages, "nipa": nipa_pages,
        "kocca": kocca_pages, "smtech": smtech_pages,
    }
    pages = b.union_sources(
        *[make(spark, sf_dir).withColumn("source", F.lit(name)) for name, make in made.items()]
    )
    path = fresh_dir(spark, "board_pages")
    pages.write.partitionBy("source").parquet(path)
    return read_pages(spark, path)


@query("""
SELECT source, count(*) AS items, min(id) AS first_id, max(title) AS last_title FROM (
  SELECT 'kstartup' AS source, CAST(o_orderkey AS VARCHAR) AS id, 'Order' || chr(160) || o_orderkey || ' call' AS title FROM orders
  UNION ALL SELECT 'bizinfo', 'PBLN_' || lpad(CAST(c_custkey AS VARCHAR), 12, '0'), 'Fund & <b>' || c_name || '</b>' FROM customer
  UNION ALL SELECT 'nipa', CAST(p_partkey AS VARCHAR), p_name || '&AI' FROM part
  UNION ALL SELECT 'kocca', '326X' || o_orderkey, 'Audio ' || o_custkey FROM orders
  UNION ALL SELECT 'smtech', 'S' || o_orderkey, 'R&D ' || o_custkey FROM orders) GROUP BY source""")
def united_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All boards of one page table as one announcement table."""
    return b.extract_all(_board_pages(spark, sf_dir)).groupBy("source").agg(
        F.count("*").alias("items"), F.min("id").alias("first_id"), F.max("title").alias("last_title")
    )


# Pages of a board are those that the key range of its table fills; the crawl finds a gap behind
# the last page.

@query(f"""
WITH rows AS (
  SELECT 'kstartup' AS source, o_orderkey // {PAGE_ROWS} + 1 AS page_no FROM orders
  UNION ALL SELECT 'bizinfo', c_custkey // {PAGE_ROWS} + 1 FROM customer
  UNION ALL SELECT 'nipa', p_partkey // {PAGE_ROWS} + 1 FROM part
  UNION ALL SELECT 'kocca', o_orderkey // {PAGE_ROWS} + 1 FROM orders
  UNION ALL SELECT 'smtech', o_orderkey // {PAGE_ROWS} + 1 FROM orders)
SELECT source, count(*) AS items, CAST(max(page_no) + 1 AS BIGINT) AS stop_page, 'gap' AS stop_reason
FROM rows GROUP BY source""")
def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole crawl of all pages: extract, yield, stop pages, dedup."""
    made = collect(_board_pages(spark, sf_dir))
    items = made.announcements.groupBy("source").agg(F.count("*").alias("items"))
    return made.stops.join(items, "source").select(
        "source", "items", F.col("stop_page").cast("bigint").alias("stop_page"), "stop_reason"
    )


SQL_YIELD = f"""
{SQL_EVENT_ROWS},
firsts AS (SELECT source, id, min(page_no) AS page_no FROM crawled GROUP BY 1, 2),
yields AS (
  SELECT source, page_no, parsed, new_rows, CAST(sum(ids) OVER (PARTITION BY source ORDER BY page_no) AS BIGINT) AS total
  FROM (SELECT c.source, c.page_no, count(*) AS parsed, count(f.id) AS new_rows, count(DISTINCT f.id) AS ids
        FROM crawled c LEFT JOIN firsts f ON f.source = c.source AND f.id = c.id AND f.page_no = c.page_no
        GROUP BY 1, 2)),
stops AS (
  SELECT source, min(code) AS code FROM (
    SELECT source, page_no * 8 + 2 AS code FROM yields WHERE new_rows = 0
    UNION ALL SELECT y.source, (y.page_no + 1) * 8 + 3 FROM yields y
      WHERE NOT EXISTS (SELECT 1 FROM yields z WHERE z.source = y.source AND z.page_no = y.page_no + 1)
    UNION ALL SELECT source, 1 * 8 + 3 FROM yields GROUP BY source HAVING min(page_no) > 1
    ) GROUP BY source)
"""


@query(f"WITH {SQL_YIELD} SELECT source, page_no, parsed, new_rows, total FROM yields")
def page_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as pages, event types as sources: rows, new rows and ids so far per page."""
    return yields(event_rows(spark, sf_dir))


def _event_stops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = event_rows(spark, sf_dir)
    pages = rows.select("source", "page_no").distinct().withColumn("status", F.lit(200))
    return rows, stops(pages, yields(rows))


@query(f"""WITH {SQL_YIELD} SELECT source, CAST(code // 8 AS BIGINT) AS stop_page,
  CASE code % 8 WHEN 2 THEN 'no_new' ELSE 'gap' END AS stop_reason,
  CASE code % 8 WHEN 2 THEN 'yes' ELSE 'no' END AS complete FROM stops""")
def stop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_stops(spark, sf_dir)[1].select(
        "source", F.col("stop_page").cast("bigint").alias("stop_page"), "stop_reason",
        F.when(F.col("crawl_complete"), "yes").otherwise("no").alias("complete"),
    )


@query(f"""WITH {SQL_YIELD} SELECT c.source, c.page_no, c.id, count(*) AS n
FROM crawled c JOIN stops s ON s.source = c.source WHERE c.page_no <= s.code // 8 GROUP BY 1, 2, 3""")
def kept_crawl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows up to the stop page of their source, the stop page included."""
    kept = kept_rows(*_event_stops(spark, sf_dir))
    return kept.groupBy("source", "page_no", "id").agg(F.count("*").alias("n"))
