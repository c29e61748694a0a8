"""Resharding by minimum-cost flow: even row counts while the fewest bytes change their shard.

Old shards are summed up as rows and bytes per size class, which is small. A minimum-cost flow over
that summary decides how many rows of which class leave each shard and where they go; in a shard the
smallest rows leave first. Rows are then ranked inside their old shard, which gives every row its
new shard and its slot. All shards are written: old shards are numbers of rows here, without files.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..session import fresh_dir
from .common import accumulate, cut_lineage, numbered

SHARDS = 16
CLASSES_PER_OCTAVE = 8
BUCKET_DIGITS = 2


@dataclass(frozen=True)
class Run:
    """Rows `first` to `last` (exclusive) of an old shard, in its order, go to `shard` from `slot` on."""

    old: int
    first: int
    last: int
    shard: int
    slot: int


class _Flow:
    """Minimum-cost flow by shortest augmenting paths with node potentials."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        self.arcs[a].append(len(self.to))
        self.arcs[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [room, 0]
        self.cost += [cost, -cost]
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        height = [0] * len(self.arcs)
        while True:
            far, came = [None] * len(self.arcs), [-1] * len(self.arcs)
            far[source] = 0
            queue = [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for k in self.arcs[a]:
                    if self.room[k]:
                        b, e = self.to[k], d + self.cost[k] + height[a] - height[self.to[k]]
                        if far[b] is None or e < far[b]:
                            far[b], came[b] = e, k
                            heapq.heappush(queue, (e, b))
            if far[sink] is None:
                return
            most = max(d for d in far if d is not None)
            height = [h + (most if d is None else d) for h, d in zip(height, far)]
            room, b = None, sink
            while b != source:
                room = self.room[came[b]] if room is None else min(room, self.room[came[b]])
                b = self.to[came[b] ^ 1]
            b = sink
            while b != source:
                self.room[came[b]] -= room
                self.room[came[b] ^ 1] += room
                b = self.to[came[b] ^ 1]


def plan(summary: list[tuple[int, int, int, int]], shards: int) -> list[Run]:
    """Runs for `summary` rows (old shard, size class, rows, bytes), old shards being 0 to any number.

    New shards hold floor(n / shards) or one more row each. A row that stays costs nothing; one that
    moves, or whose old shard is no new shard, costs the mean bytes of its class. Equal costs are
    decided by shard number.
    """
    total = sum(r[2] for r in summary)
    olds = sorted({r[0] for r in summary})
    least = total // shards
    # Nodes: source, sink, exchange, old shards, new shards. Filling the least comes before any cost.
    node_old = {s: 3 + k for k, s in enumerate(olds)}
    node_new = [3 + len(olds) + j for j in range(shards)]
    flow = _Flow(3 + len(olds) + shards)
    must = 1 + sum(r[3] // max(r[2], 1) + 1 for r in summary) + sum(r[3] for r in summary)
    held = {s: sum(r[2] for r in summary if r[0] == s) for s in olds}
    for s in olds:
        flow.arc(0, node_old[s], held[s], 0)
        if 0 <= s < shards:
            flow.arc(node_old[s], node_new[s], held[s], 0)
    leaving = []
    for s, size_class, rows, size in sorted(summary):
        leaving.append((s, rows, flow.arc(node_old[s], 2, rows, size // rows + 1)))
    arriving = [flow.arc(2, node_new[j], total, 0) for j in range(shards)]
    for j in range(shards):
        # Costs must not be negative: a full shard costs nothing, the row beyond it `must`.
        flow.arc(node_new[j], 1, least, 0)
        flow.arc(node_new[j], 1, 1, must)
    flow.run(0, 1)
    moved = {s: 0 for s in olds}
    for s, rows, k in leaving:
        moved[s] += rows - flow.room[k]
    into = [total - flow.room[k] for k in arriving]
    runs, slots = [], [0] * shards
    for s in olds:
        if held[s] > moved[s]:
            runs.append(Run(s, moved[s], held[s], s, 0))
            slots[s] = held[s] - moved[s]
    j = 0
    for s in olds:
        first = 0
        while first < moved[s]:
            while not into[j]:
                j += 1
            n = min(into[j], moved[s] - first)
            runs.append(Run(s, first, first + n, j, slots[j]))
            first, into[j], slots[j] = first + n, into[j] - n, slots[j] + n
    return runs


def assign(df: DataFrame, shards: int = SHARDS, old: str = "_old", size: str = "_size", order: str = "_order") -> DataFrame:
    """`df` with `_shard`, `_slot` and `_changed` (its new shard loses or gains rows).

    `old` is the present shard (an integer), `size` the bytes of a row, `order` a hexadecimal hash
    that orders rows of one class. Rows it cannot tell apart take neighbouring slots.
    """
    size_class = F.floor(F.log2(F.col(size).cast("double")) * CLASSES_PER_OCTAVE).cast("int")
    sized = df.withColumn("_class", size_class)
    summary = sized.groupBy(old, "_class").agg(F.count("*").alias("n"), F.sum(size).alias("b")).collect()
    runs = plan([tuple(map(int, r)) for r in summary], shards)
    ranked = accumulate(
        sized, [old], [F.col("_class"), F.substring(order, 1, BUCKET_DIGITS)], [F.col(order)],
        {"_rank": F.lit(1).cast("bigint")},
    )
    # One entry per run, fewer than old and new shards together.
    kind = "array<struct<old:int,first:bigint,last:bigint,shard:int,slot:bigint>>"
    listed = F.array(*[F.struct(
        F.lit(r.old).alias("old"), F.lit(r.first).cast("bigint").alias("first"),
        F.lit(r.last).cast("bigint").alias("last"), F.lit(r.shard).alias("shard"),
        F.lit(r.slot).cast("bigint").alias("slot")) for r in runs]).cast(kind)
    own = F.filter(listed, lambda r: (r["old"] == F.col(old)) & (r["first"] <= F.col("_rank")) & (F.col("_rank") < r["last"]))
    changed = {r.shard for r in runs if r.old != r.shard} | {r.old for r in runs if r.old != r.shard}
    found = ranked.withColumn("_run", F.get(own, F.lit(0)))
    return found.select(
        *df.columns, F.col("_run.shard").alias("_shard"),
        (F.col("_run.slot") + F.col("_rank") - F.col("_run.first")).alias("_slot"),
        F.col("_run.shard").isin(*sorted(changed)).alias("_changed") if changed else F.lit(False).alias("_changed"),
    )


def reshard(
    docs: DataFrame, shards: int = SHARDS, old: str = "_old", text: str = "text", id: str = "doc_id",
    folder: str | None = None,
) -> DataFrame:
    """Assign all rows of `docs`, write all shards below `folder`, and read them back.

    The result has the columns of `docs` without `old`, whatever their names, and _shard, _slot in place of
    columns named so. Sizes are UTF-8 bytes of
    the text plus 1, null counting as none; row counts differ by one at most; slots run from 0 in
    each shard. A null old shard is -1. Null ids and repeated rows are placed as any other row. Files are partitioned by shard;
    old shards have no files that could be kept, so shards that do not change are written too. No
    rows: no files.
    """
    own = [c for c in docs.columns if c not in (old, "_shard", "_slot")]
    if docs.select(id).isEmpty():
        return docs.select(*own).withColumns({"_shard": F.lit(None).cast("int"), "_slot": F.lit(None).cast("bigint")})
    rows, names = numbered(docs)
    base = F.coalesce(F.col(names[text]).cast("string"), F.lit(""))
    rows = rows.withColumns({
        "_from": F.coalesce(F.col(names[old]).cast("int"), F.lit(-1)),
        "_size": (F.octet_length(base) + 1).cast("bigint"),
        "_order": F.md5(F.concat_ws("/", F.coalesce(F.col(names[id]).cast("string"), F.lit("")), F.crc32(base).cast("string"))),
    }).select(*[names[c] for c in own], "_from", "_size", "_order")
    placed = assign(rows, shards, "_from").drop("_from", "_size", "_order")
    path = folder or fresh_dir(docs.sparkSession, "shards")
    placed.write.partitionBy("_shard").parquet(path)
    back = docs.sparkSession.read.schema(placed.schema).parquet(path)
    return back.select(*[F.col(names[c]).alias(c) for c in own], "_shard", "_slot")


def sharded_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): sizes and sums of the texts read back.

    The old shard of a document is its source's, by CRC-32, so that a large source fills its shard.
    """
    old = F.pmod(F.crc32(F.coalesce(F.col("source").cast("string"), F.lit(""))), F.lit(SHARDS)).cast("int")
    back = reshard(docs.select("doc_id", "text", old.alias("_old")))
    text = F.coalesce(F.col("text"), F.lit(""))
    return back.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
