"""Queries on records of any shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import fields as fd
from .registry import query, table


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as JSON records of two runs.

    Pending orders got dearer, every seventh buyer has another number, every fifth lost its segment,
    high orders have a new nested field.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.floor("o_totalprice").cast("bigint").alias("price"))
    buyers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = orders.join(buyers, "o_custkey")

    def record(price: Column, key: Column, segment: Column, note: Column) -> Column:
        buyer = F.struct(key.alias("key"), segment.alias("segment"))
        extra = F.when(note, F.struct(F.struct(F.array(F.lit(1), F.lit(2)).alias("tags")).alias("more")))
        return F.to_json(F.struct(F.col("o_orderstatus").alias("status"), price.alias("price"), buyer.alias("buyer"), extra.alias("note")))

    k, segment = F.col("o_custkey"), F.col("c_mktsegment")
    old = record(F.col("price"), k, segment, F.lit(False))
    new = record(
        F.when(F.col("o_orderstatus") == "P", F.col("price") + 1).otherwise(F.col("price")), F.when(k % 7 == 0, -k - 1).otherwise(k),
        F.when(k % 5 != 0, segment), F.col("o_orderpriority") == "2-HIGH")
    return tuple(
        joined.select(F.col("o_orderpriority").alias("source"), F.col("o_orderkey").cast("string").alias("id"), r.alias("record"))
        for r in (old, new))


SQL_FIELDS = """
j AS (SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS st, o_custkey AS k, c_mktsegment AS seg,
             CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""WITH {SQL_FIELDS}
SELECT source, id, 'price' AS path, 'changed' AS change, CAST(price AS VARCHAR) AS old, CAST(price + 1 AS VARCHAR) AS new FROM j WHERE st = 'P'
UNION ALL SELECT source, id, 'buyer.key', 'changed', CAST(k AS VARCHAR), CAST(-k - 1 AS VARCHAR) FROM j WHERE k % 7 = 0
UNION ALL SELECT source, id, 'buyer.segment', 'removed', '"' || seg || '"', '' FROM j WHERE k % 5 = 0
UNION ALL SELECT source, id, 'note.more.tags', 'added', '', '[1,2]' FROM j WHERE source = '2-HIGH'""")
def field_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per field that differs between two runs, nested and new fields included."""
    return fd.field_diff(*_runs(spark, sf_dir)).select(
        "source", "id", "path", "change", F.coalesce("old", F.lit("")).alias("old"), F.coalesce("new", F.lit("")).alias("new"))


@query(f"""WITH {SQL_FIELDS}
SELECT path, count(*) AS n FROM (
  SELECT unnest(['status', 'price', 'buyer.key'] || CASE WHEN k % 5 = 0 THEN [] ELSE ['buyer.segment'] END
                || CASE WHEN source = '2-HIGH' THEN ['note.more.tags'] ELSE [] END) AS path FROM j) GROUP BY path""")
def field_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of a run have each field."""
    rows = fd.field_rows(_runs(spark, sf_dir)[1], 3)
    return rows.groupBy("path").agg(F.count("*").alias("n"))
