"""New snapshot files as a stream: each folder of files is a run, compared with the run before it.

The records of a batch are added to their run below the name of the batch, so a repeated batch
overwrites itself and a late file loses nothing. Runs follow each other by name.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_last
from ..operators.diff import snapshot_diff
from ..schemas import KEY
from ..sources.snapshots import JSON_LINES, classify, conform, number_lines, place_of_file


RUN_OF_FILE = r"([^/]+)/[^/]+$"


def run_path(store: str, run: str) -> str:
    return f"{store}/runs/run={run}"


def diff_path(store: str, run: str) -> str:
    return f"{store}/diffs/run={run}"


def stored_run(session: SparkSession, store: str, run: str) -> DataFrame:
    """All records of a run that have arrived, the last one per key."""
    return dedup_last(session.read.parquet(run_path(store, run)).drop("batch"), KEY, ["pos"])


def _neighbours(session: SparkSession, store: str, run: str) -> tuple[str | None, str | None]:
    """The stored runs just before and after one. A row per run and batch is read, no record."""
    names = session.read.parquet(f"{store}/names").select("name").distinct()
    row = names.agg(
        F.max(F.when(F.col("name") < run, F.col("name"))).alias("b"), F.min(F.when(F.col("name") > run, F.col("name"))).alias("a"))
    return tuple(row.first())


def _compare(session: SparkSession, store: str, prev: str | None, curr: str) -> None:
    new = stored_run(session, store, curr)
    old = new.limit(0) if prev is None else stored_run(session, store, prev)
    snapshot_diff(old, new, ["first_pos"]).write.mode("overwrite").parquet(diff_path(store, curr))


def resurvey_arrivals(
    spark: SparkSession, incoming: str, store: str, checkpoint: str
) -> StreamingQuery:
    """Take all files that are new below `incoming`, then stop. Call it again for later files.

    The folder of a file names its run. A late file is added to its run; the run is then compared
    anew, and so is the run after it. Several runs in one batch are compared one after the other.
    """
    lines = (
        spark.readStream.option("pathGlobFilter", JSON_LINES).option("recursiveFileLookup", "true")
        .text(incoming).select(
            "value", *place_of_file(),
            F.url_decode(F.regexp_extract("_metadata.file_path", RUN_OF_FILE, 1)).alias("run"),
        )
    )

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # One name per run that arrived.
        arrived = sorted(r["run"] for r in batch.select("run").distinct().collect())
        for run in arrived:
            records = conform(classify(number_lines(batch.filter(F.col("run") == run))))
            records.write.mode("overwrite").parquet(f"{run_path(store, run)}/batch={number}")
            session.range(1).select(F.lit(run).alias("name")).write.mode("overwrite").parquet(
                f"{store}/names/run={quote(run, safe='')}/batch={number}")
        for run in arrived:
            before, after = _neighbours(session, store, run)
            _compare(session, store, before, run)
            if after is not None and after not in arrived:
                _compare(session, store, run, after)

    return (
        lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
