"""Shared pieces: words, counted numbering inside hot keys, and dimension joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.scaling import join_dimension
from ..session import cut_lineage

# Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with columns c0, c1 ..., and these names by its own: no name inside an operator can clash."""
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def whole(text: str) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def accumulate(
    df: DataFrame, keys: list[str], buckets: list[Column], order: list[Column],
    totals: dict[str, Column],
) -> DataFrame:
    """Add, for each name of `totals`, the sum of its column over the rows of the key before the row.

    `buckets` cut a key into ordered pieces; `order` sorts inside a piece. The pieces are summed with
    partial aggregation and accumulated per key, then rows are accumulated inside their piece. So a
    key that owns a third of all rows is spread over all its pieces. Rows that `order` cannot tell
    apart get consecutive sums in any order. Null keys are a key of their own.
    """
    names = [f"_b{k}" for k in range(len(buckets))]
    # A struct is equal to another with the same nulls, and one key serves window, sums and join:
    # the rows are shuffled once.
    cut = df.withColumns({**dict(zip(names, buckets)), **{f"_v_{n}": c for n, c in totals.items()}}).withColumns({
        "_owner": F.struct(*keys), "_piece": F.struct(*keys, *names)})
    pieces = cut.groupBy("_piece").agg(*[F.sum(f"_v_{n}").alias(f"_p_{n}") for n in totals])
    order_of_pieces = [F.col(f"_piece.{n}") for n in names]
    before = Window.partitionBy("_owner").orderBy(*order_of_pieces).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    owners = pieces.withColumn("_owner", F.struct(*[F.col(f"_piece.{k}").alias(k) for k in keys]))
    shifts = owners.select(
        "_piece", *[F.coalesce(F.sum(f"_p_{n}").over(before), zero).alias(f"_s_{n}") for n in totals])
    left = cut.withColumns({f"_i_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), zero) for n in totals})
    return left.join(shifts, "_piece").select(
        *df.columns, *[(F.col(f"_i_{n}") + F.col(f"_s_{n}")).cast("bigint").alias(n) for n in totals])


__all__ = [
    "WORD", "SPACE", "table", "numbered", "whole", "let", "words", "n_words", "ascii_lower", "accumulate",
    "join_dimension", "cut_lineage",
]
