"""Queries that fold the same program across sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import fold
from .derived import SQL_HOST, SQL_TITLE, page_titles, sql_clean
from .registry import query, table

SQL_PAGE_ITEMS = f"""
items AS (SELECT page_id AS key, {SQL_HOST} AS source, lower({sql_clean(SQL_TITLE)}) AS name FROM pages)
"""
SQL_PART_ITEMS = "items AS (SELECT p_partkey AS key, p_brand AS source, lower(p_name) AS name FROM part)"
SQL_PAIRS = """
nodes AS (SELECT name, min(source) AS lo, max(source) AS hi, min(key) AS key FROM items
          WHERE name <> '' GROUP BY name),
grams AS (SELECT DISTINCT name, substring(name, i, 3) AS gram FROM (
  SELECT name, unnest(range(1, greatest(length(name) - 2, 1) + 1)) AS i FROM nodes)),
sizes AS (SELECT name, count(*) AS n FROM grams GROUP BY name),
pairs AS (
  SELECT p.a, p.b, p.common / (x.n + y.n - p.common) AS sim FROM (
    SELECT g.name AS a, h.name AS b, count(*) AS common FROM grams g JOIN grams h
    ON g.gram = h.gram AND g.name < h.name GROUP BY 1, 2) p
  JOIN sizes x ON x.name = p.a JOIN sizes y ON y.name = p.b
  JOIN nodes na ON na.name = p.a JOIN nodes nb ON nb.name = p.b
  WHERE p.common / (x.n + y.n - p.common) >= 0.8
    AND NOT (na.lo = na.hi AND nb.lo = nb.hi AND na.lo = nb.lo))
"""
SQL_GROUPS = f"""
{SQL_PAIRS},
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT name AS root, name FROM nodes
          UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.name),
firsts AS (SELECT r.root AS name, min(n.key) AS key FROM reach r JOIN nodes n ON n.name = r.name GROUP BY 1),
shared AS (SELECT n.name, f.key FROM nodes n JOIN firsts f ON f.name = n.name
           WHERE n.lo <> n.hi OR n.name IN (SELECT a FROM links)),
grouped AS (SELECT i.key, i.source, coalesce(s.key, i.key) AS "group"
            FROM items i LEFT JOIN shared s ON s.name = i.name)
"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("source"),
        F.col("p_name").alias("title"),
    )


@query(f"WITH {SQL_PAGE_ITEMS}, {SQL_PAIRS} SELECT a, b, round(sim, 6) AS sim FROM pairs")
def similar_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fold.similar_titles(page_titles(spark, sf_dir))
    return pairs.select("a", "b", F.round("sim", 6).alias("sim"))


@query(f'WITH RECURSIVE {SQL_PAGE_ITEMS}, {SQL_GROUPS} SELECT key, "group" FROM grouped')
def folded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_titles(page_titles(spark, sf_dir))


@query(f'WITH RECURSIVE {SQL_PART_ITEMS}, {SQL_GROUPS} SELECT key, "group" FROM grouped')
def folded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few names with very many copies each."""
    return fold.fold_titles(_parts(spark, sf_dir))


@query(f'WITH RECURSIVE {SQL_PAGE_ITEMS}, {SQL_GROUPS} '
       'SELECT "group", source, count(*) AS items FROM grouped GROUP BY 1, 2')
def folded_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = page_titles(spark, sf_dir)
    return fold.fold_sources(items, fold.fold_titles(items))
