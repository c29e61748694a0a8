"""Queries on profiles, tiers and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import match as m, report as r
from ..sources import profiles as pf
from ..sources.registry import SOURCES, read_source_rules, read_sources
from .derived import (
    SQL_ORDER_RUNS, SQL_PAGE_RUNS, SQL_VERDICTS, day, order_runs, order_verdicts, page_runs,
)
from .registry import query, table


def _placed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS profile_id, c_name AS target, '음성 ' || c_mktsegment AS item,
  CASE WHEN c_acctbal < 0 THEN 'pre_founder' WHEN c_acctbal < 5000 THEN 'sole_owner' ELSE 'corporation' END AS stage,
  CASE WHEN c_acctbal < 5000 THEN -1 ELSE c_nationkey END AS years,
  r_name AS home, CASE WHEN c_acctbal < 0 THEN '' ELSE '서울+대전' END AS movable,
  '청년' AS age_band, '여성' AS gender, '대학' AS affiliation, '자금+' || c_mktsegment AS needs,
  'runs/' || c_custkey AS last_run, '2026-07-11' AS last_run_date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def profile_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles written as markdown lines from customers, read back into columns."""
    stage = (
        F.when(F.col("c_acctbal") < 0, "예비창업자").when(F.col("c_acctbal") < 5000, "개인사업자")
        .otherwise(F.concat(F.lit("법인 "), "c_nationkey", F.lit("년차")))
    )
    movable = F.when(F.col("c_acctbal") < 0, "").otherwise(" (이전 가능: 서울, 대전)")
    text = F.concat(
        F.lit("# 프로필\n- 대상: "), "c_name", F.lit(" (음성 "), "c_mktsegment", F.lit(")\n- 창업 단계: "), stage,
        F.lit("\n- 지역 연고: "), "r_name", movable, F.lit("\n- 대표자: 청년 / 여성 / 대학\n- 필요한 것: 자금, "),
        "c_mktsegment", F.lit("\n- 마지막 조사: runs/"), "c_custkey", F.lit(" (2026-07-11)\n"),
    )
    texts = _placed_customers(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("profile_id"), text.alias("text")
    )
    return pf.parse_profiles(texts).select(
        "profile_id", "target", "item", "stage", F.coalesce("years", F.lit(-1)).alias("years"),
        F.array_join("regions", "+").alias("home"), F.array_join("movable_regions", "+").alias("movable"),
        "age_band", "gender", "affiliation", F.array_join("needs", "+").alias("needs"),
        "last_run", "last_run_date",
    )


@query("""
SELECT target, run_id, strftime(run_date, '%Y-%m-%d') AS run_date FROM (
  SELECT o_custkey AS target, o_orderkey AS run_id, o_orderdate AS run_date,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01') WHERE n = 1""")
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run of each target before a date: a customer's orders are its runs."""
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("target"), F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("run_date"),
    )
    newest = pf.latest_run(runs, F.lit("1998-06-01").cast("timestamp"))
    return newest.withColumn("run_date", day("run_date"))


NEEDS = {"AUTOMOBILE": "rnd", "BUILDING": "coverage", "FURNITURE": "content", "MACHINERY": "ai_ict"}
SQL_NEED = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NEEDS.items()) + " ELSE 'none' END"


def _needs_of_segment() -> Column:
    need = F.lit("none")
    for segment, name in NEEDS.items():
        need = F.when(F.col("c_mktsegment") == segment, name).otherwise(need)
    return need


@query(f"""
WITH asked AS (SELECT c_custkey AS profile_id, {SQL_NEED} AS need FROM customer)
SELECT profile_id, 'kstartup' AS source FROM asked UNION ALL
SELECT profile_id, CASE need WHEN 'coverage' THEN 'bizinfo' WHEN 'ai_ict' THEN 'nipa'
                             WHEN 'content' THEN 'kocca' ELSE 'smtech' END
FROM asked WHERE need <> 'none'
UNION ALL SELECT profile_id, 'nia' FROM asked WHERE need = 'ai_ict'""")
def source_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("profile_id"), F.array(_needs_of_segment(), F.lit("space")).alias("needs")
    )
    return m.choose_sources(profiles, read_source_rules(spark))


@query("SELECT c_custkey AS profile_id, unnest([" + ", ".join(f"'{s[0]}'" for s in SOURCES if s[3]) + "]) AS source FROM customer")
def every_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The override that takes all verified sources of the registry."""
    profiles = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("profile_id"))
    return m.choose_sources(profiles, read_source_rules(spark), [s[0] for s in SOURCES if s[3]])


@query("""
WITH p AS (SELECT c_custkey, c_mktsegment, r_name, CASE WHEN c_acctbal > 5000 THEN 'ASIA' ELSE r_name END AS movable
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
a AS (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE r_name END AS region,
             CASE WHEN s_acctbal > 5000 THEN ['BUILDING', 'MACHINERY'] ELSE ['FURNITURE', 'HOUSEHOLD', 'BUILDING'] END AS offers
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey AS profile_id, 'supplier' AS source, s_suppkey AS id FROM p JOIN a
ON (region IS NULL OR region = r_name OR region = movable)
   AND (list_contains(offers, c_mktsegment) OR list_contains(offers, 'HOUSEHOLD'))""")
def matched_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as profiles, suppliers as announcements, by need and region."""
    profiles = _placed_customers(spark, sf_dir).select(
        F.col("c_custkey").alias("profile_id"),
        F.array("c_mktsegment", F.lit("HOUSEHOLD")).alias("needs"), F.array("r_name").alias("regions"),
        F.array(F.when(F.col("c_acctbal") > 5000, "ASIA").otherwise(F.col("r_name"))).alias("movable_regions"),
    )
    rich = F.array(F.lit("BUILDING"), F.lit("MACHINERY"))
    other = F.array(F.lit("FURNITURE"), F.lit("HOUSEHOLD"), F.lit("BUILDING"))
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"),
            F.when(F.col("s_acctbal") >= 0, F.col("r_name")).alias("region"),
            F.when(F.col("s_acctbal") > 5000, rich).otherwise(other).alias("offers"),
        )
    )
    return m.match_profiles(profiles, suppliers)


# Tiers: an order is an announcement, its customer the profile. What a call demands follows from
# the order's priority and status, what the profile has from segment and balance.

def _judging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(evaluated, reframable, announcements)."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("profile_id"), "o_orderstatus", "o_totalprice",
        day("o_orderdate").alias("apply_end"),
        F.concat(F.lit("https://orders.example/"), "o_orderkey").alias("url"),
    )
    segment = (
        F.when(F.col("source") == "1-URGENT", "BUILDING").when(F.col("source") == "2-HIGH", "MACHINERY")
        .otherwise("unknown")
    )
    company = (
        F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no")
        .otherwise("unknown")
    )
    demands = F.array(
        F.struct(F.lit("segment").alias("requirement"), segment.alias("needed"), F.lit("fixed").alias("kind")),
        F.struct(
            F.lit("incorporated").alias("requirement"), company.alias("needed"),
            F.lit("trigger").alias("kind"),
        ),
    )
    requirements = orders.select("source", "id", F.explode(demands).alias("d")).select("source", "id", "d.*")
    state = F.when(F.col("c_acctbal") > 5000, "yes").when(F.col("c_acctbal") > 0, "no").otherwise("unknown")
    has = F.array(
        F.struct(F.lit("segment").alias("requirement"), F.col("c_mktsegment").alias("value")),
        F.struct(F.lit("incorporated").alias("requirement"), state.alias("value")),
    )
    facts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("profile_id"), F.explode(has).alias("h")
    ).select("profile_id", "h.*")
    pairs = orders.select("profile_id", "source", "id")
    reframable = orders.filter(F.col("o_totalprice") > 250000).select("profile_id", "source", "id")
    return m.evaluate(pairs, requirements, facts), reframable, orders


SQL_JUDGED = """
evaluated AS (
  SELECT o_custkey AS profile_id, o_orderpriority AS source, o_orderkey AS id, requirement, needed, value,
         strftime(o_orderdate, '%Y-%m-%d') AS apply_end, o_totalprice,
         CASE WHEN needed = 'unknown' OR value = 'unknown' THEN 'unknown' WHEN needed = value THEN 'met'
              WHEN requirement = 'incorporated' THEN 'unmet_trigger' ELSE 'unmet_fixed' END AS state
  FROM (SELECT *, 'segment' AS requirement, c_mktsegment AS value,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'BUILDING' WHEN '2-HIGH' THEN 'MACHINERY' ELSE 'unknown' END AS needed
        FROM orders JOIN customer ON o_custkey = c_custkey
        UNION ALL
        SELECT *, 'incorporated', CASE WHEN c_acctbal > 5000 THEN 'yes' WHEN c_acctbal > 0 THEN 'no' ELSE 'unknown' END,
          CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE 'unknown' END
        FROM orders JOIN customer ON o_custkey = c_custkey)),
judged AS (
  SELECT profile_id, source, id, apply_end, unknowns, unmet,
    CASE WHEN unmet = 0 THEN 'A' WHEN fixed = 0 THEN 'B' WHEN o_totalprice > 250000 THEN 'C' ELSE 'rejected' END AS tier
  FROM (SELECT profile_id, source, id, apply_end, o_totalprice, count(*) FILTER (state = 'unknown') AS unknowns,
          count(*) FILTER (state LIKE 'unmet%') AS unmet, count(*) FILTER (state = 'unmet_fixed') AS fixed
        FROM evaluated GROUP BY ALL))
"""


@query(f"WITH {SQL_JUDGED} SELECT profile_id, source, id, requirement, state FROM evaluated")
def evaluated_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judging(spark, sf_dir)[0].drop("needed", "value")


@query(f"WITH {SQL_JUDGED} SELECT profile_id, source, id, tier, unknowns, unmet FROM judged")
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated, reframable, _ = _judging(spark, sf_dir)
    return m.tiers(evaluated, reframable)


@query(f"""WITH {SQL_JUDGED}
SELECT e.profile_id, e.source, e.id, e.requirement, e.needed, e.value, 'https://orders.example/' || e.id AS url
FROM evaluated e JOIN judged j ON j.id = e.id WHERE j.tier = 'rejected' AND e.state LIKE 'unmet%'""")
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated, reframable, orders = _judging(spark, sf_dir)
    judged = m.tiers(evaluated, reframable)
    return m.with_reasons(evaluated, judged, orders.select("source", "id", "url"))


@query(f"""WITH {SQL_JUDGED} SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source,
  CASE WHEN grouping(tier) = 1 THEN 'all' ELSE tier END AS tier, count(*) AS items
FROM judged GROUP BY ROLLUP (source, tier)""")
def tier_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated, reframable, _ = _judging(spark, sf_dir)
    return r.tier_rollup(m.tiers(evaluated, reframable))


def _dated_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts per market segment with deadlines; pending orders have none."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "상시").otherwise(day("o_orderdate")).alias("apply_end"),
    )
    return order_verdicts(spark, sf_dir).join(orders, "id")


SQL_DATED = f"""
{SQL_VERDICTS},
dated AS (SELECT v.*, CASE WHEN o_orderstatus = 'P' THEN '9999-12-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS due
          FROM verdicts v JOIN orders ON CAST(o_orderkey AS VARCHAR) = v.id)
"""


@query(f"WITH {SQL_DATED} SELECT profile_id, tier, source, id, row_number() OVER "
       "(PARTITION BY profile_id, tier ORDER BY due, source, id) AS position FROM dated")
def rank_in_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few profiles with very many verdicts each: ranks are found without one task per profile."""
    ranked = r.rank_in_tier(_dated_verdicts(spark, sf_dir))
    return ranked.select("profile_id", "tier", "source", "id", "position")


@query(f"WITH {SQL_DATED} SELECT * FROM (SELECT profile_id, source, id, CAST(row_number() OVER "
       "(PARTITION BY profile_id ORDER BY due, source, id) AS BIGINT) AS position FROM dated WHERE tier = 'A') WHERE position <= 10")
def top_in_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = r.top_in_tier(_dated_verdicts(spark, sf_dir), 10)
    return top.select("profile_id", "source", "id", F.col("position").cast("bigint").alias("position"))


@query(f"WITH {SQL_DATED} SELECT due, tier, profile_id, source, id FROM dated "
       "WHERE tier IN ('A', 'B') AND due <> '9999-12-31'")
def action_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = r.action_calendar(_dated_verdicts(spark, sf_dir))
    return actions.select(F.col("due").cast("string").alias("due"), "tier", "profile_id", "source", "id")


@query(f"WITH {SQL_DATED} SELECT due, tier, count(*) AS applications FROM dated "
       "WHERE tier IN ('A', 'B') AND due <> '9999-12-31' GROUP BY 1, 2")
def actions_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = r.actions_per_day(_dated_verdicts(spark, sf_dir))
    return counted.withColumn("due", F.col("due").cast("string"))


@query("SELECT event_type AS source, count(DISTINCT user_id) AS items FROM events GROUP BY 1")
def items_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), F.col("user_id").alias("id")
    )
    return r.items_per_source(events)


@query(f"WITH {SQL_PAGE_RUNS} SELECT DISTINCT source FROM page")
def source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = page_runs(spark, sf_dir)
    return r.source_names(prev.select("source").unionByName(curr.select("source")))


@query("SELECT o_orderpriority AS category, count(*) AS items, "
       "round(count(*) / (SELECT count(*) FROM orders), 9) AS share FROM orders GROUP BY 1")
def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = r.category_share(table(spark, sf_dir, "orders"), "o_orderpriority")
    return shares.withColumn("share", F.round("share", 9))


@query("""
SELECT d.source, count(*) AS collected, count(l.doc_id) AS candidates,
       count(*) FILTER (l.quality = 1) AS verified, count(*) FILTER (l.quality = 1 AND l.toxic = 1) AS unknown, 'yes' AS refreshed
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1
UNION ALL SELECT DISTINCT o_orderpriority, 0, 0, 0, 0, 'no' FROM orders""")
def survey_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are collected, labelled ones candidates, good ones verified; order priorities are
    sources of an earlier run that were not read again."""
    docs = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("id"))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id").join(docs, "id")
    verified = labels.filter(F.col("quality") == 1).withColumn("unknowns", F.col("toxic"))
    before = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source"))
    found = r.survey_coverage(labels, docs, verified, before)
    return found.withColumn("refreshed", F.when(F.col("refreshed"), "yes").otherwise("no"))


@query("""
WITH watch AS (SELECT DISTINCT p_brand AS program, p_type || lower(p_brand[1:3]) AS pattern FROM part
               UNION SELECT DISTINCT p_name, p_name FROM part),
titles AS (SELECT DISTINCT lower(replace(p_name, ' ', '')) AS title FROM part WHERE p_retailprice < 1500)
SELECT program, pattern FROM watch w WHERE NOT EXISTS (
  SELECT 1 FROM titles t WHERE contains(t.title, lower(replace(w.pattern, ' ', ''))))
  AND NOT EXISTS (SELECT 1 FROM titles t JOIN watch x ON x.program = w.program
                  WHERE contains(t.title, lower(replace(x.pattern, ' ', ''))))""")
def absent_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the part table are watched for among the names of cheap parts."""
    parts = table(spark, sf_dir, "part")
    pattern = F.concat("p_type", F.lower(F.substring("p_brand", 1, 3)))
    watch = parts.select(F.col("p_brand").alias("program"), pattern.alias("pattern")).union(
        parts.select("p_name", "p_name")
    ).distinct()
    titles = parts.filter(F.col("p_retailprice") < 1500).select(F.col("p_name").alias("title"))
    return r.absent_programs(watch, titles)


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"), F.col("p_type").alias("field"),
        F.split("p_name", " ").alias("offers"),
    )


@query("""
WITH themes AS (SELECT DISTINCT c_mktsegment AS from_field, p_type AS to_field, 'size' || p_size AS theme
                FROM customer JOIN part ON c_nationkey = p_size AND c_custkey = p_partkey)
SELECT DISTINCT c_mktsegment AS profile_id, 'part' AS source, p_partkey AS id, theme
FROM (SELECT DISTINCT c_mktsegment FROM customer) JOIN themes ON from_field = c_mktsegment
JOIN part ON p_type = to_field""")
def reframing_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market segments reach part types by themes found in customer and part."""
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    same = (F.col("c_nationkey") == F.col("p_size")) & (F.col("c_custkey") == F.col("p_partkey"))
    themes = customers.join(parts, same).select(
        F.col("c_mktsegment").alias("from_field"), F.col("p_type").alias("to_field"),
        F.concat(F.lit("size"), "p_size").alias("theme"),
    ).distinct()
    profiles = customers.select(
        F.col("c_mktsegment").alias("profile_id"), F.col("c_mktsegment").alias("field")
    ).distinct()
    return m.reframing_candidates(profiles, _fields(spark, sf_dir), themes)


@query("SELECT p_partkey AS id FROM part WHERE p_name LIKE '%ring'")
def space_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name ends in ring stand for calls that offer rooms."""
    offers = F.transform("offers", lambda o: F.when(o == "ring", "space").otherwise(o))
    return r.space_options(_fields(spark, sf_dir).withColumn("offers", offers)).select("id")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P'")
def always_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderstatus") == "P", "상시 접수").otherwise(day("o_orderdate"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), end.alias("apply_end"))
    return r.always_open(orders).select("id")


@query("""
WITH RECURSIVE edges AS (
  SELECT DISTINCT c_mktsegment AS a, o_orderpriority AS b FROM orders JOIN customer ON o_custkey = c_custkey
  UNION SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders
  UNION SELECT DISTINCT o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey),
walk AS (
  SELECT DISTINCT c_mktsegment AS start, c_mktsegment AS here, [c_mktsegment] AS path FROM customer
  UNION ALL
  SELECT start, b, list_append(path, b) FROM walk JOIN edges ON a = here
  WHERE NOT list_contains(path, b))
SELECT start, here AS goal, array_to_string(path, '>') AS path, CAST(len(path) - 1 AS BIGINT) AS steps
FROM walk WHERE here IN ('F', 'O', 'P') AND len(path) > 1""")
def roadmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chains of triggers from a segment to a status."""
    found = m.roadmap(*_trigger_graph(spark, sf_dir))
    return found.select(
        "start", "goal", F.array_join("path", ">").alias("path"), F.col("steps").cast("bigint").alias("steps")
    )


def _trigger_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Segment -> priority -> status -> segment: a cyclic graph, its starts and goals."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sold = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    edges = (
        sold.select(F.col("c_mktsegment").alias("from_state"), F.col("o_orderpriority").alias("to_state"))
        .union(orders.select("o_orderpriority", "o_orderstatus"))
        .union(sold.select("o_orderstatus", "c_mktsegment"))
    )
    starts = buyers.select(F.col("c_mktsegment").alias("state"))
    goals = orders.select(F.col("o_orderstatus").alias("state"))
    return edges, starts, goals


@query("""
WITH RECURSIVE edges AS (
  SELECT DISTINCT c_mktsegment AS a, o_orderpriority AS b FROM orders JOIN customer ON o_custkey = c_custkey
  UNION SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders
  UNION SELECT DISTINCT o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey),
walk AS (
  SELECT DISTINCT c_mktsegment AS start, c_mktsegment AS here, [c_mktsegment] AS path FROM customer
  UNION ALL
  SELECT start, b, list_append(path, b) FROM walk JOIN edges ON a = here WHERE NOT list_contains(path, b))
SELECT start, here AS goal, array_to_string(path, '>') AS path, CAST(len(path) - 1 AS BIGINT) AS steps
FROM walk WHERE here IN ('F', 'O', 'P') AND len(path) > 1
QUALIFY row_number() OVER (PARTITION BY start, here ORDER BY len(path), path) = 1""")
def shortest_roadmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest chain of triggers per start and goal in the same graph."""
    found = m.shortest_roadmap(*_trigger_graph(spark, sf_dir))
    return found.select(
        "start", "goal", F.array_join("path", ">").alias("path"), F.col("steps").cast("bigint").alias("steps")
    )


@query(f"""WITH {SQL_ORDER_RUNS}
SELECT s.source, s.name, coalesce(c.items, 0) AS items FROM (VALUES
  {', '.join(f"('{a}', '{b}')" for a, b, *_ in SOURCES)}) s(source, name)
LEFT JOIN (SELECT CASE source WHEN '1-URGENT' THEN 'kstartup' WHEN '2-HIGH' THEN 'bizinfo' ELSE 'nipa' END AS source,
                  count(*) AS items FROM curr GROUP BY 1) c ON c.source = s.source""")
def registry_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All registered sources with the items that the current run has of them."""
    curr = order_runs(spark, sf_dir)[1]
    source = (
        F.when(F.col("source") == "1-URGENT", "kstartup").when(F.col("source") == "2-HIGH", "bizinfo")
        .otherwise("nipa")
    )
    counts = curr.groupBy(source.alias("source")).agg(F.count("*").alias("items"))
    return read_sources(spark).join(counts, "source", "left").select(
        "source", "name", F.coalesce("items", F.lit(0)).cast("bigint").alias("items")
    )
