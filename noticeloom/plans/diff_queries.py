"""Queries on snapshots and their differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import diff as d
from ..operators.dedup import dedup_last
from ..session import fresh_dir
from ..sources.snapshots import (
    read_snapshot, review_queue as queue, skipped_lines as skipped, write_review_queue,
    write_snapshot,
)
from ..operators.crawl import page_yield, stop_pages
from .derived import (
    SQL_DIFF, SQL_ORDER_RUNS, SQL_PAGE_RUNS, SQL_VERDICTS, day, order_runs, order_verdicts, page_runs,
)
from .registry import query, table

BIGINT = "bigint"
ORDER_DIFF = f"WITH {SQL_ORDER_RUNS}, {SQL_DIFF}"
PAGE_DIFF = f"WITH {SQL_PAGE_RUNS}, {SQL_DIFF}"


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = order_runs(spark, sf_dir)
    return d.snapshot_diff(prev, curr, ["pos"])


def _shown(diff: DataFrame) -> DataFrame:
    return diff.select(
        "source", "id", "status",
        F.coalesce("old_end", F.lit("")).alias("old_end"),
        F.coalesce("new_end", F.lit("")).alias("new_end"),
    )


SHOWN = "source, id, status, coalesce(old_end, '') AS old_end, coalesce(new_end, '') AS new_end"


@query(f"{PAGE_DIFF} SELECT {SHOWN} FROM diff")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = page_runs(spark, sf_dir)
    return _shown(d.snapshot_diff(prev, curr, ["pos"]))


@query(f"{ORDER_DIFF} SELECT {SHOWN} FROM diff")
def order_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_diff(spark, sf_dir))


@query(f"{ORDER_DIFF} SELECT source, id, status FROM diff")
def order_diff_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = order_runs(spark, sf_dir)
    return d.snapshot_diff_by_join(prev, curr)


LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
              "l_discount", "l_tax"]


@query(f"""
WITH ranked AS (
  SELECT l_returnflag AS source, l_orderkey || '-' || l_linenumber AS id, l_linestatus AS run,
         strftime(l_shipdate, '%Y-%m-%d') AS apply_end,
         row_number() OVER (PARTITION BY l_returnflag, l_orderkey, l_linenumber, l_linestatus
                            ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) AS n
  FROM lineitem),
prev AS (SELECT source, id, apply_end, 0 AS pos FROM ranked WHERE n = 1 AND run = 'O'),
curr AS (SELECT source, id, apply_end, 0 AS pos FROM ranked WHERE n = 1 AND run = 'F'),
{SQL_DIFF}
SELECT {SHOWN} FROM diff""")
def lineitem_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup and diff of the largest table in one shuffle: line status O is the previous run."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("source"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        day("l_shipdate").alias("apply_end"), "l_linestatus", *LINE_ORDER,
    )
    runs = [lines.filter(F.col("l_linestatus") == s).drop("l_linestatus") for s in ("O", "F")]
    return _shown(d.snapshot_diff(*runs, LINE_ORDER))


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
       strftime(first_ship, '%Y-%m-%d') AS first_shipped
FROM (SELECT *, row_number() OVER w AS n,
             min(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) AS first_ship
      FROM lineitem
      WINDOW w AS (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                            l_quantity DESC, l_discount DESC, l_tax DESC))
WHERE n = 1""")
def lineitem_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
             "l_discount", "l_tax"]
    latest = dedup_last(
        lines.select("l_orderkey", "l_linenumber", *order), ["l_orderkey", "l_linenumber"], order
    )
    return latest.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day("l_shipdate").alias("shipped"),
        day("first_pos.l_shipdate").alias("first_shipped"),
    )


def _one_status(status: str) -> str:
    return f"{ORDER_DIFF} SELECT {SHOWN} FROM diff WHERE status = '{status}'"


@query(_one_status("new"))
def new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(d.new_items(_diff(spark, sf_dir)))


@query(_one_status("closed"))
def closed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(d.closed(_diff(spark, sf_dir)))


@query(_one_status("deadline_changed"))
def deadline_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(d.deadline_changed(_diff(spark, sf_dir)))


@query(f"{ORDER_DIFF} SELECT count(*) AS items FROM diff WHERE status = 'unchanged'")
def unchanged_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.unchanged(_diff(spark, sf_dir)).agg(F.count("*").alias("items"))


@query(_one_status("first_time"))
def first_time_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(d.first_time(_diff(spark, sf_dir)))


@query(f"{ORDER_DIFF} SELECT source, count(*) AS items FROM diff "
       "WHERE status = 'not_recrawled' GROUP BY source")
def not_recrawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.not_recrawled(_diff(spark, sf_dir))


@query(f"{ORDER_DIFF} SELECT status, count(*) AS items FROM diff GROUP BY status")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.status_counts(_diff(spark, sf_dir))


@query(f"WITH {SQL_ORDER_RUNS} SELECT (SELECT count(*) FROM prev) AS prev_items, "
       "(SELECT count(*) FROM curr) AS curr_items, (SELECT count(DISTINCT prev.source) FROM prev JOIN curr ON prev.source = curr.source) AS compared_sources")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.run_totals(_diff(spark, sf_dir))


@query(f"WITH {SQL_ORDER_RUNS} SELECT coalesce(p.source, c.source) AS source, "
       "CASE WHEN c.source IS NULL THEN 'no' ELSE 'yes' END AS refreshed "
       "FROM (SELECT DISTINCT source FROM prev) p FULL OUTER JOIN (SELECT DISTINCT source FROM curr) c ON p.source = c.source")
def compared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of either run, and whether the current run read them again."""
    return d.compared_sources(_diff(spark, sf_dir)).withColumn(
        "refreshed", F.when(F.col("refreshed"), "yes").otherwise("no"))


@query(f"""
WITH {SQL_ORDER_RUNS}, {SQL_DIFF}
SELECT source, id, CASE WHEN status = 'closed' AND source <> '3-MEDIUM' THEN 'closed_unconfirmed' ELSE status END AS status FROM diff""")
def confirmed_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closures count only where the crawl was complete: one source ended by itself, the others
    have a page without a status."""
    sources = order_runs(spark, sf_dir)[1].select("source").distinct()
    last = F.when(F.col("source") != "3-MEDIUM", F.lit(None).cast("int")).otherwise(200)
    pages = sources.select("source", F.lit(1).alias("page_no"), F.lit(200).alias("status")).unionByName(
        sources.select("source", F.lit(2).alias("page_no"), last.alias("status")))
    rows = sources.select("source", F.lit(1).alias("page_no"), F.lit("x").alias("id"))
    stops = stop_pages(pages, page_yield(rows, pages))
    return d.confirm_closed(_diff(spark, sf_dir), stops).select("source", "id", "status")


@query(f"WITH {SQL_PAGE_RUNS} SELECT DISTINCT source FROM curr")
def run_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.run_sources(page_runs(spark, sf_dir)[1])


@query(f"WITH {SQL_PAGE_RUNS} SELECT source FROM prev INTERSECT SELECT source FROM curr")
def common_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.common_sources(*page_runs(spark, sf_dir))


@query(f"WITH {SQL_PAGE_RUNS} SELECT source FROM curr EXCEPT SELECT source FROM prev")
def added_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.added_sources(*page_runs(spark, sf_dir))


@query(f"WITH {SQL_PAGE_RUNS} SELECT source FROM prev EXCEPT SELECT source FROM curr")
def dropped_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dropped_sources(*page_runs(spark, sf_dir))


@query(f"""WITH {SQL_PAGE_RUNS}, {SQL_DIFF}
SELECT source, CAST(in_prev AS BIGINT) AS in_prev, CAST(in_curr AS BIGINT) AS in_curr,
       CASE WHEN in_prev + in_curr = 2 THEN 'common' WHEN in_curr = 1 THEN 'added'
            ELSE 'dropped' END AS coverage FROM coverage""")
def source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.source_coverage(*page_runs(spark, sf_dir)).select(
        "source", F.col("in_prev").cast(BIGINT), F.col("in_curr").cast(BIGINT), "coverage"
    )


@query(f"""{ORDER_DIFF}
SELECT source, id, new_end, row_number() OVER (
  ORDER BY coalesce(nullif(new_end, ''), '~'), pos, source, id) AS position
FROM diff WHERE status = 'new'""")
def ordered_new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed order of new items, with the position as a column."""
    from ..operators.scaling import row_number_by_range

    new = d.new_items(_diff(spark, sf_dir)).select("source", "id", "new_end", "curr_pos")
    end = F.coalesce(F.nullif("new_end", F.lit("")), F.lit("~"))
    return row_number_by_range(
        new.withColumn("run", F.lit("curr")), ["run"],
        [end, F.col("curr_pos.pos"), F.col("source"), F.col("id")], "position",
    ).select("source", "id", "new_end", "position")


@query(f"{ORDER_DIFF} SELECT source, id, status, new_end AS apply_end FROM diff "
       "WHERE status IN ('new', 'first_time')")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue(_diff(spark, sf_dir)).select(
        "source", "id", "status", F.get_json_object("value", "$.apply_end").alias("apply_end")
    )


@query(f"{ORDER_DIFF} SELECT id, new_end AS apply_end, 'Order ' || id AS title FROM diff "
       "WHERE status IN ('new', 'first_time')")
def review_queue_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue written as lines and read back."""
    path = fresh_dir(spark, "review_queue")
    write_review_queue(_diff(spark, sf_dir), path)
    lines = spark.read.schema("id string, title string, apply_end string").json(path)
    return lines.select("id", "title", "apply_end")


def _order_lines(spark: SparkSession, sf_dir: str) -> str:
    """Orders as JSON lines of both record shapes, each order twice, with lines that hold none."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus"
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"

    def line(version: str, days: int):
        end = F.date_add("o_orderdate", days).cast("string")
        title = F.concat(F.lit(f"{version} 공고 "), "o_orderkey")
        first = F.to_json(F.struct(
            F.col("o_orderkey").alias("pbancSn"), title.alias("title"), end.alias("deadline")
        ))
        other = F.to_json(F.struct(
            F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("id"),
            title.alias("title"), end.alias("apply_end"), F.col("o_orderstatus").alias("more"),
        ))
        return F.when(urgent, first).otherwise(other)

    noise = F.when(F.col("o_orderstatus") == "P", '{"x": 1}').otherwise("{bad")
    lines = F.array(line("T1", 0), noise, F.lit(""), line("T2", 5))
    path = fresh_dir(spark, "order_lines")
    orders.select(F.explode(lines).alias("value")).write.text(path)
    return path


@query("""
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'kstartup' ELSE o_orderpriority END AS source,
       CAST(o_orderkey AS VARCHAR) AS id, 'T2 공고 ' || o_orderkey AS title,
       strftime(CAST(o_orderdate AS DATE) + 5, '%Y-%m-%d') AS apply_end
FROM orders""")
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of two shapes, conformed and deduplicated by line order."""
    records = read_snapshot(spark, _order_lines(spark, sf_dir), "*.txt")
    return dedup_last(records, ["source", "id"], ["pos"]).select("source", "id", "title", "apply_end")


@query("""
SELECT 'blank' AS shape, count(*) AS lines FROM orders UNION ALL
SELECT CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE 'malformed' END, count(*)
FROM orders GROUP BY 1""")
def skipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skipped(spark, _order_lines(spark, sf_dir), "*.txt")


@query("""
SELECT 'cust-' || c_nationkey AS source, CAST(c_custkey AS VARCHAR) AS id, c_name AS title,
       c_mktsegment AS field, row_number() OVER (ORDER BY c_custkey) AS position FROM customer""")
def snapshot_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot written in order and read back in that order."""
    from ..operators.scaling import row_number_by_range

    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust-"), "c_nationkey").alias("source"),
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("field"), "c_custkey",
    )
    path = fresh_dir(spark, "snapshot")
    write_snapshot(rows, path, ["c_custkey"], ["source", "id", "title", "field"])
    back = read_snapshot(spark, path, "*.json").withColumn("run", F.lit("r"))
    return row_number_by_range(back, ["run"], [F.col("pos")], "position").select(
        "source", "id", "title", "field", "position"
    )


@query(f"""
WITH {SQL_ORDER_RUNS}, {SQL_DIFF}, {SQL_VERDICTS}
SELECT d.source, d.id, d.status, v.profile_id, d.new_end AS apply_end,
       CASE WHEN d.status IN ('unchanged', 'deadline_changed') THEN v.tier ELSE 'none' END AS tier,
       CASE WHEN d.status IN ('unchanged', 'deadline_changed') THEN 'carried' ELSE 'unreviewed' END AS review
FROM diff d JOIN verdicts v ON v.source = d.source AND v.id = d.id
WHERE d.status NOT IN ('closed', 'not_recrawled')""")
def carried_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    carried = d.carry_verdicts(_diff(spark, sf_dir), order_verdicts(spark, sf_dir))
    return carried.withColumn("tier", F.coalesce("tier", F.lit("none")))


@query(f"""
WITH {SQL_ORDER_RUNS}, {SQL_DIFF}, {SQL_VERDICTS}
SELECT v.profile_id, d.source, d.id, d.old_end, d.new_end
FROM diff d JOIN verdicts v ON v.source = d.source AND v.id = d.id
WHERE d.status = 'deadline_changed' AND v.tier = 'A'""")
def recheck_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.recheck_queue(_diff(spark, sf_dir), order_verdicts(spark, sf_dir))


@query(f"""
WITH {SQL_ORDER_RUNS}, {SQL_DIFF}, {SQL_VERDICTS}
SELECT v.profile_id, d.source, d.id, d.old_end
FROM diff d JOIN verdicts v ON v.source = d.source AND v.id = d.id
WHERE d.status = 'closed' AND v.tier = 'A'""")
def lost_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.lost_opportunities(_diff(spark, sf_dir), order_verdicts(spark, sf_dir))


@query(f"""
WITH {SQL_ORDER_RUNS}, {SQL_DIFF}, {SQL_VERDICTS}
SELECT v.profile_id, d.status, coalesce(v.tier, 'none') AS tier_before,
       CASE WHEN v.tier IS NOT NULL AND d.status IN ('unchanged', 'deadline_changed') THEN v.tier ELSE 'none' END AS tier_now,
       count(*) AS items
FROM diff d LEFT JOIN verdicts v ON v.source = d.source AND v.id = d.id AND v.tier <> 'C'
GROUP BY ALL""")
def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the lowest tier stand for items that nobody has judged."""
    diff, before = _diff(spark, sf_dir), order_verdicts(spark, sf_dir).filter("tier <> 'C'")
    carried = d.carry_verdicts(diff, before).filter(F.col("review") == "carried")
    return d.incremental_report(diff, before, carried)
