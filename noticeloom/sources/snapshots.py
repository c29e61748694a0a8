"""Survey runs as JSON lines: ordered scan, conformance of two record shapes, sinks.

A line is placed by (file, block, line, piece). The block is the offset of the file split, the
line number grows inside a split, so files of any size are read in parallel and still have an
exact order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import SPACE_CHARACTERS
from ..schemas import RECORD, UNIFIED_FIELDS

JSON_LINES = "*.{jsonl,json}"
# Line ends beyond CR and LF, at which a text is also cut into lines.
OTHER_LINE_ENDS = r"[\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
FIRST_BOARD = "kstartup"
_END = "__end_of_record__"


def place_of_file() -> list[Column]:
    """File name and split offset of a text scan, read beside each line."""
    name = F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))
    return [F.url_decode(name).alias("file"), F.col("_metadata.file_block_start").alias("block")]


def number_lines(scan: DataFrame) -> DataFrame:
    """(value, file, block) straight from a scan to (pos, text)."""
    numbered = scan.withColumn("line", F.monotonically_increasing_id())
    return numbered.select(
        "file", "block", "line", F.posexplode(F.split("value", OTHER_LINE_ENDS)).alias("piece", "text")
    ).select(
        F.struct("file", "block", "line", "piece").alias("pos"),
        F.btrim("text", F.lit(SPACE_CHARACTERS)).alias("text"),
    )


def read_lines(spark: SparkSession, path: str, pattern: str = JSON_LINES) -> DataFrame:
    """Lines of all files of one run with their position. Fails when no file matches."""
    scan = spark.read.text(f"{path.rstrip('/')}/{pattern}")
    return number_lines(scan.select("value", *place_of_file()))


def _has(name: str) -> Column:
    return F.array_contains("keys", name)


def classify(lines: DataFrame) -> DataFrame:
    """Parse each line and name its shape: blank, malformed, board_one, unified, unknown."""
    # The line is parsed as a member of an outer object whose last key must be reached,
    # so text after the record makes it malformed.
    outer = F.concat(F.lit('{"r":'), F.col("text"), F.lit(f',"{_END}":1}}'))
    parsed = lines.select(
        "pos",
        "text",
        F.from_json(
            outer, f"r struct<{RECORD.simpleString()[7:-1]}>, {_END} int",
            {"allowSingleQuotes": "false"},
        ).alias("parsed"),
        F.json_object_keys("text").alias("keys"),
    )
    is_object = F.col("keys").isNotNull() & F.col("parsed.r").isNotNull()
    shape = (
        F.when(F.col("text") == "", "blank")
        .when(F.col(f"parsed.{_END}").isNull(), "malformed")
        .when(is_object & _has("pbancSn"), "board_one")
        .when(is_object & _has("source") & _has("id"), "unified")
        .otherwise("unknown")
    )
    return parsed.select("pos", "text", "keys", F.col("parsed.r").alias("r"), shape.alias("shape"))


def _member(name: str, value: Column) -> Column:
    """`,"name":value` as JSON text."""
    whole = F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"})
    return F.concat(F.lit(","), F.regexp_replace(whole, r"^\{|\}$", ""))


def conform(classified: DataFrame) -> DataFrame:
    """Both record shapes as one table keyed by (source, id).

    Missing fields are '' and JSON nulls stay null. `record` is the whole line as JSON, other
    fields included, with the two fields that a board-one record lacks added.
    """
    first = F.col("shape") == "board_one"

    def value(name: str) -> Column:
        return F.when(_has(name), F.col(f"r.{name}")).otherwise("")

    apply_end = F.when(first & ~_has("apply_end"), value("deadline")).otherwise(value("apply_end"))
    key_id = F.when(first, F.col("r.pbancSn")).otherwise(F.col("r.id"))
    columns = {
        "source": F.when(first, FIRST_BOARD).otherwise(F.coalesce(F.col("r.source"), F.lit(""))),
        "id": F.coalesce(key_id, F.lit("None")),
        **{n: value(n) for n in UNIFIED_FIELDS[2:]},
        "apply_end": apply_end,
    }
    added = F.concat(
        F.when(first & ~_has("source"), _member("source", F.lit(FIRST_BOARD))).otherwise(""),
        F.when(first & ~_has("apply_end"), _member("apply_end", value("deadline"))).otherwise(""),
    )
    record = F.concat(F.regexp_replace("text", r"\}$", ""), added, F.lit("}"))
    return classified.filter(F.col("shape").isin("board_one", "unified")).select(
        *[c.alias(n) for n, c in columns.items()], record.alias("record"), "pos"
    )


def read_snapshot(spark: SparkSession, path: str, pattern: str = JSON_LINES) -> DataFrame:
    """All records of a run, repeated keys included; see `dedup_last`."""
    return conform(classify(read_lines(spark, path, pattern)))


def skipped_lines(spark: SparkSession, path: str, pattern: str = JSON_LINES) -> DataFrame:
    """How many lines of a run carry no record, by reason."""
    shapes = classify(read_lines(spark, path, pattern)).select("shape")
    return (
        shapes.filter(~F.col("shape").isin("board_one", "unified"))
        .groupBy("shape").agg(F.count("*").alias("lines"))
    )


def write_snapshot(df: DataFrame, path: str, order: list[str], fields: list[str]) -> None:
    """One JSON object per line, in order: part files are numbered in sort order."""
    (
        df.orderBy(*order).select(*fields)
        .write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    )


def review_queue(diff: DataFrame) -> DataFrame:
    """New items, then first-time items, each in input order, as JSON text."""
    has_record = "record" in diff.schema["curr"].dataType.names
    line = F.col("curr.record") if has_record else F.to_json("curr", {"ignoreNullFields": "false"})
    return diff.filter(F.col("status").isin("new", "first_time")).select(
        "source", "id", F.col("status"), F.col("curr_pos").alias("pos"),
        (F.col("status") == "first_time").cast("int").alias("part"), line.alias("value"),
    )


def write_review_queue(diff: DataFrame, path: str) -> None:
    (
        review_queue(diff).orderBy("part", "pos", "source", "id").select("value")
        .write.mode("errorifexists").text(path)
    )
