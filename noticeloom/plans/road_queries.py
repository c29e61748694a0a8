"""Queries on ranked roadmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import roads
from .registry import query, table

# Segment -> priority -> line number -> return flag -> line status; returned goods are a first line again,
# so that one component has two states and the rest is layered.
SQL_LAYERS = """
edges AS (
  SELECT DISTINCT c_mktsegment AS a, o_orderpriority AS b FROM orders JOIN customer ON o_custkey = c_custkey
  UNION SELECT DISTINCT o_orderpriority, 'line ' || l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION SELECT DISTINCT 'line ' || l_linenumber, 'flag ' || l_returnflag FROM lineitem
  UNION SELECT DISTINCT 'flag ' || l_returnflag, 'status ' || l_linestatus FROM lineitem
  UNION SELECT DISTINCT 'flag ' || l_returnflag, 'line 1' FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)"""


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges, starts and goals."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    flag, status = F.concat(F.lit("flag "), "l_returnflag"), F.concat(F.lit("status "), "l_linestatus")
    line = F.concat(F.lit("line "), "l_linenumber")
    back = items.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
    edges = (
        orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("c_mktsegment").alias("from_state"), F.col("o_orderpriority").alias("to_state"))
        .union(items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderpriority", line))
        .union(items.select(line, flag)).union(items.select(flag, status)).union(back.select(flag, line)))
    return edges, buyers.select(F.col("c_mktsegment").alias("state")), items.select(status.alias("state"))


@query(f"""
WITH RECURSIVE {SQL_LAYERS},
walk AS (
  SELECT DISTINCT c_mktsegment AS start, c_mktsegment AS here, [c_mktsegment] AS path FROM customer
  UNION ALL SELECT start, b, list_append(path, b) FROM walk JOIN edges ON a = here WHERE NOT list_contains(path, b)),
ranked AS (
  SELECT start, here AS goal, row_number() OVER (PARTITION BY start, here ORDER BY len(path), path) AS rank, path,
         count(*) OVER (PARTITION BY start, here) AS ways
  FROM walk WHERE here LIKE 'status %')
SELECT start, goal, rank, array_to_string(path, '>') AS path, CAST(len(path) - 1 AS BIGINT) AS steps, ways FROM ranked WHERE rank <= 5""")
def ranked_roadmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five shortest ways per start and goal, and how many there are."""
    found = roads.ranked_roadmap(*_layers(spark, sf_dir), k=5)
    return found.select(
        "start", "goal", F.col("rank").cast("bigint").alias("rank"), F.array_join("path", ">").alias("path"), "steps",
        F.col("ways").cast("bigint").alias("ways"))


@query(f"""
WITH RECURSIVE {SQL_LAYERS},
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
states AS (SELECT a AS s FROM edges UNION SELECT b FROM edges)
SELECT s AS state, greatest(s, coalesce((SELECT max(r.b) FROM reach r JOIN reach q ON q.a = r.b AND q.b = r.a WHERE r.a = s), s)) AS component
FROM states""")
def trigger_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States that reach each other; the greatest name is that of the component."""
    found = roads.strong_components(_layers(spark, sf_dir)[0])
    names = found.groupBy("component").agg(F.max("state").alias("name"))
    return found.join(names, "component").select("state", F.col("name").alias("component"))
