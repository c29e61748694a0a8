"""Records of any shape as variants: the schema of a run, and differences field by field.

A record keeps whatever fields its source has. Objects are opened level by level, so a nested field is
a row with a path like `buyer.segment`; arrays and values are leaves, compared as their JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import KEY
from ..session import cut_lineage


def with_variant(records: DataFrame, record: str = "record", name: str = "fields") -> DataFrame:
    """The record as a variant; null where the text is no JSON."""
    return records.withColumn(name, F.try_parse_json(record))


def run_schema(records: DataFrame, record: str = "record") -> str:
    """The fields of all records of a run with their types, nested ones included; one partial aggregate."""
    found = with_variant(records, record).agg(F.schema_of_variant_agg("fields").alias("s")).first()["s"]
    return found or "VOID"


def nesting(record: Column) -> Column:
    """How many braces are open at once at most: no object of the record lies deeper."""
    braces = F.regexp_replace(F.regexp_replace(record, r'"(?:[^"\\]|\\.)*+"', ""), "[^{}]", "")

    def step(state: Column, brace: Column) -> Column:
        now = state["now"] + F.when(brace == "{", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(F.filter(F.split(braces, ""), lambda c: c != ""), start, step, lambda state: state["most"])


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT<")


def field_rows(records: DataFrame, depth: int, record: str = "record") -> DataFrame:
    """(source, id, path, value) of every leaf field, the value as JSON text.

    `depth`: levels that are opened, see `nesting`; what lies deeper stays one value. A field that is
    null is a leaf `null`; an empty object has no leaves. Rows that are no JSON object have no fields.
    """
    spark = records.sparkSession
    level = with_variant(records, record).filter(F.col("fields").isNotNull() & _is_object(F.col("fields"))).select(
        *KEY, F.lit("").alias("path"), "fields")
    leaves = None
    for k in range(depth):
        opened = level.lateralJoin(spark.tvf.variant_explode(F.col("fields").outer())).select(
            *KEY, F.concat("path", F.lit("." if k else ""), "key").alias("path"), F.col("value").alias("fields"))
        last = k == depth - 1
        ends = opened if last else opened.filter(~_is_object(F.col("fields")))
        found = ends.select(*KEY, "path", F.to_json("fields").alias("value"))
        leaves = found if leaves is None else leaves.unionByName(found)
        level = opened.filter(_is_object(F.col("fields")))
    return leaves if leaves is not None else level.select(*KEY, "path", F.to_json("fields").alias("value"))


def field_diff(prev: DataFrame, curr: DataFrame, record: str = "record", depth: int | None = None) -> DataFrame:
    """(source, id, path, change, old, new): a row per field that differs between two runs.

    prev, curr: source, id and the record as JSON text, unique by key. Only items of both runs are
    compared; `change` is added, removed or changed. Both runs are tagged and paired by one shuffle of
    leaves; a record whose text is the same in both runs is left out before it is opened. Without
    `depth`, records are opened to the last level that occurs.
    """
    tagged = prev.select(*KEY, F.lit(0).alias("run"), F.col(record).alias("record")).unionByName(
        curr.select(*KEY, F.lit(1).alias("run"), F.col(record).alias("record")))
    of = lambda run, value: F.max(F.when(F.col("run") == run, F.col(value)))
    pairs = tagged.groupBy(*KEY).agg(of(0, "record").alias("old"), of(1, "record").alias("new")).filter("old <> new")
    if depth is None:
        pairs = cut_lineage(pairs)
        depth = pairs.agg(F.max(F.greatest(nesting(F.col("old")), nesting(F.col("new"))))).first()[0] or 0
    both = None
    for run, side in enumerate(("old", "new")):
        rows = field_rows(pairs.select(*KEY, F.col(side).alias("record")), depth).withColumn("run", F.lit(run))
        both = rows if both is None else both.unionByName(rows)
    found = both.groupBy(*KEY, "path").agg(of(0, "value").alias("old"), of(1, "value").alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return found.filter("old is null or new is null or old <> new").select(*KEY, "path", change.alias("change"), "old", "new")
