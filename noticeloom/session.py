"""Session helpers: shared scratch space and stage tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Where a shuffle of whole runs begins; adaptive execution puts small partitions together again.
FINE_PARTITIONS = 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Fewer tasks than this for a core leave cores idle while the last ones run.
TASKS_A_CORE = 4
# What a stage sends to Python at a time. The buffers of a batch double as it grows, and executor and
# worker both hold it; with the default of 64 MB, 10,000 texts come at once, however long they are.
STAGE_BATCH = "4m"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a folder of this machine, which is removed at the end.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="noticeloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/noticeloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and continue from the files.

    A table rather than `checkpoint()`: that computes its input twice, once for the action and
    once for the files, and what is read back cannot be pruned by column.
    """
    path = fresh_dir(df.sparkSession, "stage")
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    """Tasks for rows that are few bytes but much work: as many as a shuffle has, and some for every core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send STAGE_BATCH to Python at a time, unless the session has its own setting."""
    if spark.conf.get(BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(BATCH_BYTES, STAGE_BATCH)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES)


@contextmanager
def fine_shuffles(spark: SparkSession, partitions: int = FINE_PARTITIONS) -> Iterator[None]:
    """Shuffles of jobs that run inside begin with at least so many partitions.

    `spark.sql.shuffle.partitions` is the same for all tables, so what a task reads of a large one has
    no bound. The setting is that of the session, and is put back at the end.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(max(least, partitions)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
