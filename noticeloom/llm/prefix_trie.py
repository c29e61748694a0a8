"""Conversation prefix trie: a z-fast trie kept as tables.

A conversation is a string of turns. Its prefixes have digests (exclusive or of hashes that contain
the position), so the digest of any depth is one row of a table and is summed in blocks, however long
the conversation is. A compacted node is an interval (s, e] of depths of the conversation that
brought it; it is filed under its handle, the prefix of the two-fattest depth of the interval.

Conversations come in batches. The exit node of each lies below its deepest handle, which one join of
all its digests with the handles finds; a search that asks for one digest at a time would read the
table of digests once for each. Where conversations leave, edges are split, and one conversation of
each new branch becomes a leaf; the others go on from there in the next turn. That one is chosen by
hash, so branches halve and turns grow with the logarithm of the number of conversations, not with the
depth of the trie.

Sums over subtrees go up by pointer doubling, and at last edges are expanded into a row per depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.scaling import row_number_by_range
from .common import cut_lineage

BLOCK = 4096
# A conversation is in the first batch by one in 64, in the second by one in 8, else in the third.
BATCHES = (64, 8, 1)
NOTHING = hashlib.sha256(b"").hexdigest()
TURN = ["conv_id", "pos", "a", "b", "bytes"]


def coded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, bytes) from (conv_id, turn, role, text): numbered turns without texts.

    (a, b) are 120 bits of a digest of role and text, `pos` counts from 1 by turn, null first, equal
    turns by digest. Null role or text is empty; rows without conv_id belong to no conversation and
    are left out. Rows are numbered in ranges, so a conversation that holds a third of them is spread.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"),
    ).select(
        "conv_id", "turn", "bytes",
        *[F.conv(F.substring("digest", k, 15), 16, 10).cast("bigint").alias(n) for n, k in (("a", 1), ("b", 16))])
    order = [F.asc_nulls_first("turn"), F.col("a"), F.col("b")]
    return row_number_by_range(rows, ["conv_id"], order, "pos").select(*TURN)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, d, x, y, bytes, total): digest of the first d turns, bytes of the d-th and of all d.

    Running values are taken inside blocks of BLOCK positions and shifted by the blocks before.
    """
    marks = turns.select(
        "conv_id", F.col("pos").cast("bigint").alias("d"), F.floor((F.col("pos") - 1) / BLOCK).alias("block"),
        F.xxhash64(F.lit(1), "pos", "a", "b").alias("x"), F.xxhash64(F.lit(2), "b", "pos", "a").alias("y"), "bytes")
    inside = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = marks.groupBy("conv_id", "block").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("bytes").alias("bytes"))
    shifts = blocks.select(
        "conv_id", "block", F.bit_xor("x").over(before).alias("bx"), F.bit_xor("y").over(before).alias("by"),
        F.sum("bytes").over(before).alias("bt"))
    zero = F.lit(0).cast("bigint")
    run = marks.select(
        "conv_id", "block", "d", F.bit_xor("x").over(inside).alias("x"), F.bit_xor("y").over(inside).alias("y"),
        "bytes", F.sum("bytes").over(inside).alias("total"))
    return run.join(shifts, ["conv_id", "block"]).select(
        "conv_id", "d", F.col("x").bitwiseXOR(F.coalesce("bx", zero)).alias("x"),
        F.col("y").bitwiseXOR(F.coalesce("by", zero)).alias("y"), "bytes",
        (F.col("total") + F.coalesce("bt", zero)).alias("total"))


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that is divisible by the largest power of two."""
    bits = f"cast(length(bin({low} ^ {high})) - 1 as int)"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def _at(table: DataFrame, conv: str, depth: str, **names: str) -> DataFrame:
    """Prefix rows as (conv, depth, renamed columns), to be joined by these two."""
    return table.select(F.col("conv_id").alias(conv), F.col("d").alias(depth), *[
        F.col(c).alias(n) for c, n in names.items()])


def _locate(pending: DataFrame, trie: DataFrame, table: DataFrame) -> DataFrame:
    """pending (conv, len, l) with (rep, s, e, k): the edge on which a conversation leaves the trie
    and the depth to which both agree. `rep` is null where no edge goes on from depth k.

    The trie is known to agree to depth l. The digests below it are looked up among the handles, all
    in one join: the deepest handle found is what a search by turns ends with.
    """
    handles = trie.select(
        F.col("f").alias("d"), F.col("fx").alias("x"), F.col("fy").alias("y"), F.struct("f", "rep", "s", "e").alias("edge"))
    hit = pending.select("conv", "l").join(_at(table, "conv", "d", x="x", y="y"), "conv").filter("d > l").join(
        handles, ["d", "x", "y"]).groupBy("conv").agg(F.max("edge").alias("edge"))
    at = pending.join(hit, "conv", "left").select(
        "conv", "len", F.coalesce("edge.e", "l").alias("l"), "edge.rep", "edge.s", "edge.e")
    # The exit node is the child that goes on with the next turn, else the node found itself.
    children = trie.select(
        F.col("s").alias("l"), "cx", "cy", F.col("rep").alias("crep"), F.col("e").alias("ce"))
    step = at.withColumn("next", F.col("l") + 1).join(
        _at(table, "conv", "next", x="cx", y="cy"), ["conv", "next"], "left").join(children, ["l", "cx", "cy"], "left")
    child = F.col("ce").isNotNull()
    exits = step.select(
        "conv", "len", "l", F.when(child, F.col("crep")).otherwise(F.col("rep")).alias("rep"),
        F.when(child, F.col("l")).otherwise(F.col("s")).alias("s"),
        F.when(child, F.col("ce")).otherwise(F.col("e")).alias("e"))
    # Both agree on a depth of the edge if the digests are equal; the last such depth counts.
    shared = exits.select("conv", "rep", "s", F.least("len", "e").alias("till")).join(
        _at(table, "conv", "d", x="x", y="y"), "conv").filter("d > s and d <= till").join(
        _at(table, "rep", "d", x="x", y="y"), ["rep", "d", "x", "y"]).groupBy("conv").agg(F.max("d").alias("k"))
    return exits.join(shared, "conv", "left").withColumn("k", F.coalesce("k", F.least("l", F.coalesce("s", "l"))))


def _filed(intervals: DataFrame, table: DataFrame) -> DataFrame:
    """Intervals (rep, s, e) with handle depth and digest, and the digest of the first turn."""
    first = F.struct(F.lit("c").alias("kind"), (F.col("s") + 1).alias("d"))
    handle = F.struct(F.lit("f").alias("kind"), F.col("f").alias("d"))
    asked = intervals.withColumn("f", two_fattest("s", "e")).select(
        "rep", "s", "e", "f", F.inline(F.array(first, handle)))
    seen = asked.join(_at(table, "rep", "d", x="x", y="y"), ["rep", "d"])
    return seen.groupBy("rep", "s", "e", "f").agg(*[
        F.max(F.when(F.col("kind") == k, F.col(c))).alias(k + c) for k in "cf" for c in "xy"])


def build(classes: DataFrame, table: DataFrame) -> DataFrame:
    """Compacted nodes (rep, s, e, ...) below the root, from (conv, len) of different conversations."""
    place = F.xxhash64("conv")
    number = F.lit(len(BATCHES) - 1)
    for k in reversed(range(len(BATCHES) - 1)):
        number = F.when(F.pmod(place, F.lit(BATCHES[k])) == 0, k).otherwise(number)
    waiting = cut_lineage(classes.filter("len > 0").select("conv", "len", number.alias("batch")))
    trie, pending, batch = None, None, 0
    while batch < len(BATCHES) or pending is not None:
        fresh = waiting.filter(F.col("batch") == batch).select("conv", "len", F.lit(0).cast("bigint").alias("l"))
        pending = fresh if pending is None else pending.unionByName(fresh) if batch < len(BATCHES) else pending
        batch += 1
        if trie is None:
            none = F.lit(None).cast("bigint")
            located = pending.select("conv", "len", "l", none.alias("rep"), none.alias("s"), none.alias("e"), F.col("l").alias("k"))
        else:
            located = cut_lineage(_locate(pending, trie, table))
        inside = located.filter("rep is not null and k > s and k < e")
        branches = located.filter("k < len").withColumn("next", F.col("k") + 1).join(
            _at(table, "conv", "next", x="x", y="y"), ["conv", "next"])
        chosen = cut_lineage(branches.groupBy("next", "x", "y").agg(
            F.min(F.struct(F.xxhash64("conv").alias("place"), "conv", "len", "k")).alias("leaf")).select("leaf.*"))
        leaves = chosen.select(F.col("conv").alias("rep"), F.col("k").alias("s"), F.col("len").alias("e"))
        if trie is None:
            trie = cut_lineage(_filed(leaves, table))
        else:
            cuts = inside.select("rep", "s", "e", "k").distinct()
            edges = cuts.select("rep", "s", "e").distinct()
            ends = cuts.unionByName(edges.withColumn("k", F.col("e")))
            order = Window.partitionBy("rep", "e").orderBy("k")
            pieces = ends.select(
                "rep", F.coalesce(F.lag("k").over(order), F.col("s")).alias("s"), F.col("k").alias("e"))
            kept = trie.join(edges, ["rep", "s", "e"], "left_anti")
            trie = cut_lineage(kept.unionByName(_filed(pieces.unionByName(leaves), table)))
        left = cut_lineage(located.filter("k < len").join(chosen.select("conv"), "conv", "left_anti").select(
            "conv", "len", F.col("k").alias("l")))
        pending = None if left.isEmpty() else left
    return trie


def _ends_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest = None, None
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        out = []
        for *key, conv in rows:
            if key != now:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b"," + str(conv).encode())
        yield _ends_batch(out)
    if now is not None:
        yield _ends_batch([(*now, digest.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], ["e", "x", "y", "ends"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(e, x, y, ends): digest over the ascending ids that end at a prefix.

    It goes over the ids in order, so those of one prefix stream through one task; nothing is held.
    """
    rows = ends.select(F.col("len").alias("e"), "x", "y", "conv_id").repartition("e", "x", "y")
    return rows.sortWithinPartitions("e", "x", "y", "conv_id").mapInArrow(
        _ends_digest, "e bigint, x bigint, y bigint, ends string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """nodes (node, up, convs, path, own, leaves, least) with these five over the whole subtree.

    After k turns a node holds its descendants at distances below 2^k and knows its 2^k-th ancestor.
    """
    state = nodes.withColumn("far", F.col("up"))
    sums = ["convs", "path", "own", "leaves"]
    while not state.filter(F.col("far").isNotNull()).isEmpty():
        given = state.filter(F.col("far").isNotNull()).groupBy(F.col("far").alias("node")).agg(
            *[F.sum(c).alias(f"g_{c}") for c in sums], F.min("least").alias("g_least"))
        # What lies right below the root has no second ancestor; the root is not looked up.
        ahead = state.filter(F.col("far").isNotNull()).select(
            F.col("node").alias("far"), F.col("far").alias("further"))
        zero = F.lit(0).cast("bigint")
        state = cut_lineage(
            state.withColumn("far", F.when(F.col("far.e") > 0, F.col("far")))
            .join(given, "node", "left").join(ahead, "far", "left").select(
                "node", "up", *[(F.col(c) + F.coalesce(f"g_{c}", zero)).alias(c) for c in sums],
                F.least("least", "g_least").alias("least"), F.col("further").alias("far"),
                *[c for c in nodes.columns if c not in {"node", "up", "least", *sums}]))
    return state.drop("far")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per different prefix of the conversations, the empty one (the root) included.

    turns: conv_id, pos (gapless from 1), a, b (digest of a turn), bytes. conversations: conv_id, each
    once, also those without turns. Returns conv_id (the smallest member), depth, parent_conv_id (null
    for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256; see `ends_digests`.
    Saved bytes of a prefix: (members - 1) x bytes of its last turn, summed over the subtree.

    Equal conversations are one class and are inserted once. Without conversations there are no rows.
    """
    table = cut_lineage(prefixes(turns))
    last = table.groupBy("conv_id").agg(F.max(F.struct("d", "x", "y", "total")).alias("z"))
    zero = F.lit(0).cast("bigint")
    ends = cut_lineage(conversations.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("z.d", zero).alias("len"), F.coalesce("z.x", zero).alias("x"),
        F.coalesce("z.y", zero).alias("y"), F.coalesce("z.total", zero).alias("total")))
    classes = cut_lineage(ends.groupBy("len", "x", "y").agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n"), F.max("total").alias("total")))
    trie = build(classes, table)

    asked = trie.select("rep", "s", "e", F.inline(F.array(
        F.struct(F.lit("e").alias("kind"), F.col("e").alias("d")), F.struct(F.lit("s").alias("kind"), F.col("s").alias("d")))))
    seen = asked.join(_at(table, "rep", "d", x="x", y="y", total="total"), ["rep", "d"], "left").groupBy("rep", "s", "e").agg(*[
        F.coalesce(F.max(F.when(F.col("kind") == k, F.col(c))), zero).alias(k + c) for k in "es" for c in ("x", "y", "total")])
    below = seen.select(
        F.struct("e", F.col("ex").alias("x"), F.col("ey").alias("y")).alias("node"),
        F.struct(F.col("s").alias("e"), F.col("sx").alias("x"), F.col("sy").alias("y")).alias("up"),
        "rep", "s", "stotal", (F.col("etotal") - F.col("stotal")).alias("own"))
    top = F.struct(zero.alias("e"), zero.alias("x"), zero.alias("y"))
    null = F.lit(None).cast("bigint")
    root = classes.limit(1).select(
        top.alias("node"), F.when(F.lit(False), top).alias("up"), null.alias("rep"), zero.alias("s"),
        zero.alias("stotal"), zero.alias("own"))
    nodes = cut_lineage(below.unionByName(root))
    children = nodes.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("children"))
    here = classes.select(
        F.struct(F.col("len").alias("e"), "x", "y").alias("node"), F.col("n").alias("convs"),
        (F.col("n") * F.col("total")).alias("path"), F.col("conv").alias("least"))
    counted = nodes.join(children, "node", "left").join(here, "node", "left").select(
        "node", "up", "rep", "s", "stotal", "own", F.coalesce("children", zero).alias("children"),
        F.coalesce("convs", zero).alias("convs"), F.coalesce("path", zero).alias("path"), "least",
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"))
    whole = _subtree_sums(cut_lineage(counted))

    digests = ends_digests(ends).select(F.struct("e", "x", "y").alias("node"), "ends")
    parents = whole.select(F.col("node").alias("up"), F.col("least").alias("above"))
    full = cut_lineage(whole.join(digests, "node", "left").join(parents, "up", "left"))
    # Edges become a row per depth, in two steps so that no array grows with the length of an edge.
    first, till = F.floor(F.col("s") / BLOCK), F.floor((F.col("node.e") - 1) / BLOCK)
    blocks = full.filter("rep is not null").withColumn("block", F.explode(F.sequence(first, till)))
    rows = blocks.withColumn("depth", F.explode(F.sequence(
        F.greatest(F.col("s"), F.col("block") * BLOCK) + 1, F.least(F.col("node.e"), (F.col("block") + 1) * BLOCK))))
    placed = rows.join(_at(table, "rep", "depth", total="total", bytes="bytes"), ["rep", "depth"])
    before = F.col("total") - F.col("bytes")
    saved = F.col("path") - F.col("convs") * before - (F.col("own") - (before - F.col("stotal")))
    at_end = F.col("depth") == F.col("node.e")
    inner = placed.select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("s") + 1, F.col("above")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("convs").alias("n_convs"), F.when(at_end, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"))
    trunk = full.filter("rep is null").select(
        F.col("least").alias("conv_id"), zero.alias("depth"), null.alias("parent_conv_id"), F.col("convs").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("path") - F.col("own")).alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
    return inner.unionByName(trunk)


def rebuilt(turns: DataFrame, heads: int = 9, every: int = 5) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which conversation c begins with turns of conversation c - c % every.

    It gets that one's first h turns, h = crc32(decimal c) % heads, in place of its own first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    head = F.col("conv_id") - F.col("conv_id") % every
    sizes = cut_lineage(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    given = sizes.select("conv_id", h.alias("h"), head.alias("head")).join(
        sizes.select(F.col("conv_id").alias("head"), "n"), "head", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("m"))
    own = turns.join(given, "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "a", "b", "bytes")
    steps = F.array(*[F.lit(k).cast("bigint") for k in range(1 - every, every)])
    copies = turns.filter((F.col("conv_id") % every == 0) & (F.col("pos") < heads)).select(
        F.col("conv_id").alias("from"), F.explode(F.transform(steps, lambda k: F.col("conv_id") + k)).alias("conv_id"),
        "pos", "a", "b", "bytes").filter((head == F.col("from")) & (F.col("pos") <= h))
    taken = copies.join(sizes.select("conv_id"), "conv_id", "left_semi").select(*TURN)
    return own.unionByName(taken), sizes.select("conv_id")
