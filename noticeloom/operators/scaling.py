"""Joins, running totals and ranks that hold when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

BROADCAST_ROWS = 100_000
SALTS = 32
RUN_BLOCK = 4096
# Rows of a task, as a power of two, whose members are folded together, and members of an array. The rows
# of a pair of arrays are held at once, so arrays are short.
FOLD_BITS = 13
FOLDED = 128


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    salt_by: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join `facts` with a table that has one row per `on`.

    The dimension is counted first, up to `max_rows`. A small one is broadcast, so the facts are
    not shuffled. A larger one is repeated per salt and joined on the key and the salt, so the
    rows of one hot key are spread over many tasks.
    """
    if dim.limit(max_rows + 1).count() <= max_rows:
        return facts.join(F.broadcast(dim), on, how)
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)))
    salted_dim = dim.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    )
    return salted_facts.join(salted_dim, [*on, "_salt"], how).drop("_salt")


def spread_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on a few keys whose result is far larger than both sides.

    The rows of the larger side are dealt by their hash over SALTS parts of each key, those of the
    smaller side are repeated for every part, so that each pair meets once and no task gets a whole
    key. The parts go to a given number of tasks: adaptive merging of small partitions looks at the
    bytes of the sides, not of the result, and would leave the whole join to one task.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal_left = left.count() >= right.count()
    dealt, repeated = (left, right) if deal_left else (right, left)
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64(*dealt.columns), F.lit(SALTS)))
    repeated = repeated.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    left, right = (df.repartition(tasks, *on, "_salt") for df in ((dealt, repeated) if deal_left else (repeated, dealt)))
    # A broadcast would be chosen by the size before the repetition.
    return left.join(right.hint("merge"), [*on, "_salt"]).drop("_salt")


def fold_members(members: DataFrame, on: str, name: str) -> DataFrame:
    """(`on`, `name`): the other columns of the rows of a key as arrays of at most FOLDED structs.

    `members` has to be a stage: its rows are counted as they lie in the files, so a task that is run
    again folds the same rows. Only rows of one task meet, so they are folded before the shuffle.
    """
    rest = [c for c in members.columns if c != on]
    run = F.shiftright(F.monotonically_increasing_id(), FOLD_BITS)
    whole = members.withColumn("_run", run).groupBy(on, "_run").agg(F.collect_list(F.struct(*rest)).alias("_all"))
    starts = F.sequence(F.lit(1), F.size("_all"), F.lit(FOLDED))
    return whole.select(on, F.explode(F.transform(starts, lambda k: F.slice("_all", k, FOLDED))).alias(name))


def spread_members(pairs: DataFrame, left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """A row per pair of members for every pair of classes: `pairs` joined with `left` and `right`.

    pairs: `left_on`, `right_on` and more; left: `left_on` and more; right: `right_on` and more; both
    are stages, and other names differ. Members are dealt, sorted and kept as arrays, and become rows
    where the result is made, so shuffles and spills grow with the members and not with their pairs.
    """
    few = cut_lineage(fold_members(left, left_on, "_left"))
    many = cut_lineage(fold_members(right, right_on, "_right"))
    met = spread_join(pairs.join(few, left_on), many, [right_on])
    told = [F.col(c) for c in pairs.columns]
    rows = met.select(*told, "_right", F.inline("_left"))
    return rows.select(*told, *[c for c in left.columns if c != left_on], F.inline("_right"))


def running_total(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, block: int = RUN_BLOCK
) -> DataFrame:
    """Running sum of `value` per key by an integer `order`, unique per key.

    The order is cut into blocks: block sums are accumulated first, then rows inside each block.
    No task sees more than one block of a key.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    by_block = Window.partitionBy(*keys).orderBy("_block")
    before = (
        blocked.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.sum("_sum").over(by_block) - F.col("_sum"))
        .drop("_sum")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    placed = blocked.withColumn("_inside", F.sum(value).over(inside))
    total = (F.col("_before") + F.col("_inside")).alias(name)
    return _join_by_row_keys(placed, before, [*keys, "_block"]).select(
        *[F.col(f"l.{c}") for c in df.columns if c != name], total
    )


def _join_by_row_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join as `l` and `r`; a null key matches a null key, so no row of `left` is lost."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.alias("l").join(right.alias("r"), same)


def row_number_by_range(
    df: DataFrame, keys: list[str], order: list[Column], name: str
) -> DataFrame:
    """Exact row number per key without putting a key into one task.

    Rows are range partitioned by key and order, which also splits a hot key. The sorted rows are
    kept as files, numbered inside each partition, and shifted by the count of the partitions
    before. `order` must be total.
    """
    ranged = (
        df.repartitionByRange(*[F.col(k) for k in keys], *order)
        .sortWithinPartitions(*[F.col(k) for k in keys], *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    kept = cut_lineage(ranged)
    parts = kept.groupBy(*keys, "_part").agg(
        F.count("*").alias("_rows"), F.min("_seq").alias("_first")
    )
    # One row per key and partition, not per row of the data.
    earlier = Window.partitionBy(*keys).orderBy("_part")
    shifts = parts.withColumn("_shift", F.sum("_rows").over(earlier) - F.col("_rows")).drop("_rows")
    number = (F.col("_shift") + F.col("_seq") - F.col("_first") + 1).alias(name)
    return _join_by_row_keys(kept, shifts, [*keys, "_part"]).select(
        *[F.col(f"l.{c}") for c in df.columns if c != name], number
    )
