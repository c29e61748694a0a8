"""The history of every item as a stream with state: late files change their own items only.

Arrivals are records of any run in any order. The state of an item (source, id) is what each run said
of it; an arrival gives one row for its run, and one for the next run of the item, whose comparison it
changes. A timer on the deadline gives one imminent row per item and deadline, whether or not files
arrive. Nothing is collected: items are spread over the state store by key, a run is never held.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..schemas import KEY

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = (
    "source string, id string, kind string, run string, apply_end string, last_run string, last_end string, version long")
FIELDS = [f.split()[0] for f in EVENT.split(", ")]
IMMINENT_DAYS = 3
# The watermark lies a day behind, so that several calls on one day are not late.
DELAY = datetime.timedelta(days=1)


def _day(text: str | None) -> datetime.datetime | None:
    try:
        return datetime.datetime.strptime((text or "")[:10], "%Y-%m-%d").replace(tzinfo=datetime.timezone.utc)
    except ValueError:
        return None


class ItemHistory(StatefulProcessor):
    """State of one item: (place, apply_end) per run, rows given so far, deadline already announced."""

    def __init__(self, imminent_days: int = IMMINENT_DAYS):
        self.imminent = datetime.timedelta(days=imminent_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", "run string", "place string, apply_end string")
        self.version = handle.getValueState("version", "version long")
        self.announced = handle.getValueState("announced", "apply_end string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {k[0]: tuple(v) for k, v in self.runs.iterator()}
        changed = set()
        for frame in rows:
            for run, place, end in zip(frame["run"], frame["place"], frame["apply_end"]):
                end = "" if end is None or pd.isna(end) else end
                # The last record of a run counts, by place, whatever came first.
                if run not in held or held[run][0] < place:
                    held[run] = (place, end)
                    changed.add(run)
        for run in changed:
            self.runs.updateValue((run,), held[run])
        if not changed:
            return
        self._watch(held[max(held)][1])
        order = sorted(held)
        touched = sorted(changed | {order[k + 1] for k in range(len(order) - 1) if order[k] in changed})
        version = self.version.get()[0] if self.version.exists() else 0
        out = []
        for run in touched:
            version += 1
            at = order.index(run)
            before = order[at - 1] if at else None
            out.append((*key, "seen", run, held[run][1], before, held[before][1] if before else None, version))
        self.version.update((version,))
        yield pd.DataFrame(out, columns=FIELDS)

    def _watch(self, end: str) -> None:
        """One timer, on the deadline that the newest run gives."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = _day(end)
        if due is not None and not (self.announced.exists() and self.announced.get()[0] == end):
            self.handle.registerTimer(int((due - self.imminent - DELAY).timestamp() * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = {k[0]: tuple(v) for k, v in self.runs.iterator()}
        run = max(held)
        end = held[run][1]
        today = datetime.datetime.fromtimestamp(
            timerValues.getCurrentWatermarkInMs() / 1000, datetime.timezone.utc) + DELAY
        due = _day(end)
        if due is not None and today < due + datetime.timedelta(days=1):
            self.announced.update((end,))
            version = self.version.get()[0] + 1
            self.version.update((version,))
            yield pd.DataFrame([(*key, "imminent", run, end, None, None, version)], columns=FIELDS)

    def close(self) -> None:
        pass


def item_events(arrivals: DataFrame, as_of: str, imminent_days: int = IMMINENT_DAYS) -> DataFrame:
    """Rows EVENT of a stream of records (source, id, run, place, apply_end).

    `place` orders the records of a run; runs follow each other by name. `as_of`, the day of the call,
    is the clock of the timers and must not go back between calls by a day or more. A null deadline
    counts as '', records with a null source, id or run are left out.
    """
    timed = arrivals.filter("source is not null and id is not null and run is not null").select(
        *KEY, "run", "place", "apply_end", F.lit(as_of).cast("timestamp").alias("seen"))
    return timed.withWatermark("seen", f"{DELAY.days} day").groupBy(*KEY).transformWithStateInPandas(
        ItemHistory(imminent_days), EVENT, "Append", "EventTime")


def follow_items(
    spark: SparkSession, store: str, checkpoint: str, as_of: str, imminent_days: int = IMMINENT_DAYS,
) -> StreamingQuery:
    """Take the records that `resurvey_arrivals` stored below `store` since the last call, then stop.

    Events are appended to `store/events`. The timers of a call see `as_of`.
    """
    spark.conf.set(STATE_STORE, ROCKS_DB)
    stored = f"{store}/runs"
    schema = spark.read.parquet(stored).schema
    arrivals = spark.readStream.schema(schema).parquet(stored)
    place = F.concat(
        F.col("pos.file"), F.lit("\0"), *[F.lpad(F.col(f"pos.{c}").cast("string"), 20, "0") for c in ("block", "line", "piece")])
    known = arrivals.select("source", "id", F.col("run").cast("string").alias("run"), place.alias("place"), "apply_end")
    return (
        item_events(known, as_of, imminent_days).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(f"{store}/events")
    )


def item_diff(events: DataFrame, prev: str, curr: str) -> DataFrame:
    """(source, id, status, old_end, new_end) of two runs from events, as `snapshot_diff` has it.

    Only the rows of the two runs are read; the last version of an item in a run counts.
    """
    of_runs = events.filter((F.col("kind") == "seen") & F.col("run").isin(prev, curr))
    last = of_runs.groupBy(*KEY, "run").agg(F.max(F.struct("version", "apply_end", "last_run", "last_end")).alias("e"))
    item = last.groupBy(*KEY).agg(
        F.max(F.when(F.col("run") == prev, F.col("e"))).alias("p"), F.max(F.when(F.col("run") == curr, F.col("e"))).alias("c"))
    common = item.groupBy("source").agg(
        (F.max(F.col("p").isNotNull()) & F.max(F.col("c").isNotNull())).alias("common"))
    again = F.col("c").isNotNull() & (F.col("c.last_run") == prev)
    status = (
        F.when(again & (F.col("c.last_end") != F.col("c.apply_end")), "deadline_changed").when(again, "unchanged")
        .when(F.col("common"), F.when(F.col("c").isNotNull(), "new").otherwise("closed"))
        .when(F.col("c").isNotNull(), "first_time").otherwise("not_recrawled"))
    return item.join(common, "source").select(
        *KEY, status.alias("status"), F.col("p.apply_end").alias("old_end"), F.col("c.apply_end").alias("new_end"))
