"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

Two small collections of hashes are computed per document, GROUPS groups of ROWS minhashes each. A
table key pairs a group of the first with a group of the second collection. So GROUPS**2 tables of
2 * ROWS minhashes come from 2 * GROUPS * ROWS hash functions instead of GROUPS**2 * 2 * ROWS. Two
documents of similarity s meet unless all groups of a collection miss, which has the probability
2 * (1 - s**ROWS)**GROUPS: 3 in 10,000 at 0.75 and less above.

Documents with equal sets are one node. A node is compared with a centre per key, not with all
nodes of the key. What the centres leave apart is searched by what it shares beyond its centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..operators.fold import components
from .common import WORD, cut_lineage, join_dimension, numbered

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 75
ROWS, GROUPS = 3, 16
SEED = 20_240_607
# Turns of comparing with centres before what is left apart is searched exactly; one at least.
CENTRE_TURNS = 1
# Nodes that are compared with one copy of their centre in one task.
BLOCK_NODES = 256
MEMO_WORDS = 500_000
SLICE_BYTES = 1 << 22
PIECE_SHINGLES = 4096
MIX = np.uint64(0x9E3779B97F4A7C15)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = 2 * GROUPS * ROWS
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


FACTORS, SHIFTS = _functions()


class _Words(dict):
    """Hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_memo = _Words()


def _stir(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (h ^ w) * MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct n-word shingles of a text.

    A-Z are lowered; words are separated by space, tab, line feed, vertical tab, form feed and
    carriage return. Fewer than n words are one shingle, no words none.
    """
    if len(_memo) > MEMO_WORDS:
        _memo.clear()
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))
    used = min(n, len(w))
    h = np.full(len(w) - used + 1, used, np.uint64)
    for k in range(used):
        h = _stir(h, w[k:len(w) - used + 1 + k])
    return np.unique(h)


def bands(found: np.ndarray) -> np.ndarray:
    """The group keys of a shingle set: GROUPS of the first collection, then GROUPS of the second."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), PIECE_SHINGLES):
        piece = found[k:k + PIECE_SHINGLES, None]
        values = piece * FACTORS + SHIFTS
        least = np.minimum(least, (values ^ (values >> np.uint64(32))).min(axis=0))
    key = np.arange(2 * GROUPS, dtype=np.uint64)
    for row in least.reshape(2 * GROUPS, ROWS).T:
        key = _stir(key, row)
    return key.view(np.int64)


PRINT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()),
    T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ])
    for batch in batches:
        ids, counts, digests, keys = [], [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            found = shingles(text.as_py() or "")
            ids.append(doc_id)
            counts.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            keys.append(bands(found) if len(found) else np.empty(0, np.int64))
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), lists],
            schema=schema)


SET = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType()),
])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of (node, digest, text); texts that only share the id of the node are left out."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        nodes, sets, held = [], [], 0
        for node, digest, text in zip(*(batch.column(c) for c in ("node", "digest", "text"))):
            found = shingles(text.as_py() or "").tobytes()
            if xxhash.xxh3_128_digest(found) == digest.as_py():
                nodes.append(node.as_py())
                sets.append(found)
                held += len(found)
            if held > SLICE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], schema=schema)
                nodes, sets, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], schema=schema)


COMPARED = T.StructType([
    T.StructField("centre", T.LongType()), T.StructField("node", T.LongType()),
    T.StructField("both", T.LongType()), T.StructField("other", T.ArrayType(T.LongType())),
])


def _against(with_others: bool):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (centre, block), the centre's set first, then the nodes to compare with it.

        `both` counts common shingles, `other` lists those the centre has not (when asked for).
        """
        schema = pa.schema([
            ("centre", pa.int64()), ("node", pa.int64()), ("both", pa.int64()), ("other", pa.list_(pa.int64()))])
        place, own = None, None
        for batch in batches:
            rows, lists, held = [], [], 0

            def full() -> pa.RecordBatch:
                ends = pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32))
                flat = pa.array(np.concatenate(lists) if lists else np.empty(0, np.int64))
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))]
                return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, flat)], schema=schema)

            for centre, block, node, data in zip(*(batch.column(c) for c in ("centre", "block", "node", "shingles"))):
                at, node = (centre.as_py(), block.as_py()), node.as_py()
                found = np.frombuffer(data.as_py(), np.uint64)
                if node == at[0]:
                    place, own = at, found
                elif at == place:
                    where = np.searchsorted(own, found)
                    where[where == len(own)] = 0
                    common = own[where] == found
                    rows.append((at[0], node, int(common.sum())))
                    lists.append(found[~common].view(np.int64) if with_others else np.empty(0, np.int64))
                    held += lists[-1].nbytes
                if held > SLICE_BYTES:
                    yield full()
                    rows, lists, held = [], [], 0
            yield full()

    return compare


def _compared(pairs: DataFrame, sets: DataFrame, with_others: bool = False) -> DataFrame:
    """COMPARED rows of the pairs (centre, node).

    Nodes travel to blocks of their centre, and the centre's set to each of its blocks, so neither
    a frequent centre nor its nodes gather in one task.
    """
    sized = cut_lineage(pairs.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("bigint").alias("blocks")))
    several = join_dimension(pairs, sized.filter("blocks > 1"), ["centre"], ["node"])
    members = several.select(
        "centre", F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).alias("block"), "node")
    centres = sized.select(
        "centre", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        F.col("centre").alias("node"))
    loaded = members.unionByName(centres).join(sets, "node")
    ordered = loaded.repartition("centre", "block").sortWithinPartitions(
        "centre", "block", F.col("node") != F.col("centre"))
    return ordered.select("centre", "block", "node", "shingles").mapInArrow(_against(with_others), COMPARED)


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, node, chance): the table keys that a node may share, and its rank as a centre.

    First the groups are counted. Only groups that two nodes share can be part of a shared key, so
    nodes without such groups of both collections drop out before pairs of groups are formed. Nodes
    that share much make good centres; they get the lowest rank.
    """
    groups = nodes.select("node", F.posexplode("bands").alias("place", "value"))
    shared = groups.groupBy("place", "value").agg(F.count("*").alias("n")).filter("n > 1")
    own = groups.join(shared, ["place", "value"]).groupBy("node").agg(
        F.collect_list(F.struct("place", "value")).alias("g"), F.sum("n").alias("sum"))
    first = F.filter("g", lambda g: g["place"] < GROUPS)
    second = F.filter("g", lambda g: g["place"] >= GROUPS)
    both = own.select("node", F.struct((-F.col("sum")).alias("s"), F.xxhash64("node").alias("h")).alias("chance"),
                      first.alias("x"), second.alias("y"))
    paired = both.select("node", "chance", F.explode("x").alias("x"), "y").select(
        "node", "chance", "x", F.explode("y").alias("y"))
    return paired.select(F.xxhash64("x.place", "x.value", "y.place", "y.value").alias("key"), "node", "chance")


def _apart(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """The keys with their nodes' labels, as far as the nodes of the key have more than one."""
    named = keys.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_keys = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    return named.join(open_keys.select("key"), "key")


def _links(compared: DataFrame, size: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the compared pairs that are similar."""
    other = size.select(F.col("node").alias("centre"), F.col("size").alias("centre_size"))
    sized = compared.select("centre", "node", "both").join(size, "node").join(other, "centre")
    union = F.col("size") + F.col("centre_size") - F.col("both")
    return sized.filter(F.col("both") * 100 >= union * percent).select(
        F.col("centre").alias("a"), F.col("node").alias("b"))


def _rest(groups: DataFrame, sets: DataFrame, size: DataFrame, percent: int) -> DataFrame:
    """Pairs (centre, node) that may still be similar in `groups`(centre, node, label, home).

    All nodes of a group were compared with its centre; `home` is the centre's label. Let m have
    another label and share `both` shingles with the centre, and let x be similar to m, of another
    label. Then |m & x| >= p / (100 + p) * (|m| + |x|), which is p / 100 * |m| at least. So either m
    and x share p / 100 * |m| - both shingles (one at least) that the centre has not, or |x| <= both *
    (100 + p) / p - |m|. The first kind is an overlap join of the shingles beyond the centre, with
    prefixes by ascending frequency in the group and the bound that the last match leaves; the second
    meets on sizes. No pair is formed only because two nodes share a key.
    """
    compared = cut_lineage(_compared(groups.filter("node <> centre").select("centre", "node").distinct(), sets, True))
    about = cut_lineage(compared.join(groups, ["centre", "node"]).join(size, "node"))
    rows = cut_lineage(about.select("centre", "node", F.explode("other").alias("shingle")))
    # A shingle of one node of the group is shared by no two of them.
    counts = rows.groupBy("centre", "shingle").agg(F.count("*").alias("n")).filter("n > 1")
    own = Window.partitionBy("centre", "node")
    ranked = rows.join(counts, ["centre", "shingle"]).select(
        "centre", "node", "shingle", F.row_number().over(own.orderBy("n", "shingle")).alias("rank"),
        F.count("*").over(own).alias("beyond"))
    shared = F.greatest(F.lit(1), F.ceil(F.col("size") * percent / 100) - F.col("both"))
    placed = about.select("centre", "node", "label", "home", "both", "size")
    prefixes = cut_lineage(ranked.join(placed, ["centre", "node"]).filter(F.col("rank") <= F.col("beyond") - shared + 1))
    left = prefixes.filter("label <> home").select(
        "centre", "shingle", *[F.col(c).alias(f"m_{c}") for c in ("node", "label", "rank", "both", "size", "beyond")])
    needed = F.ceil((F.col("m_size") + F.col("size")) * percent / (100 + percent)) - F.least("m_both", "both")
    needed = F.greatest(F.lit(1), needed)
    once = (F.col("label") == F.col("home")) | (F.col("m_node") < F.col("node"))
    # Of so many common shingles one lies this early in both orders.
    early = (F.col("m_rank") <= F.col("m_beyond") - needed + 1) & (F.col("rank") <= F.col("beyond") - needed + 1)
    same = ["centre", "shingle"]
    met = prefixes.join(left, same).filter((F.col("label") != F.col("m_label")) & once & early).groupBy(
        "centre", "m_node", "node", "m_both", "both", "m_size", "size", "m_beyond", "beyond").agg(
        F.count("*").alias("matches"), F.max("m_rank").alias("m_last"), F.max("rank").alias("last"))
    most = F.col("matches") + F.least(F.col("m_beyond") - F.col("m_last"), F.col("beyond") - F.col("last"))
    by_shingle = met.filter(most >= needed).select(F.col("m_node").alias("m"), "node")
    centres = groups.filter("node = centre").select("centre", "node", "label").join(size, "node")
    everyone = placed.select("centre", "node", "label", "size").unionByName(centres)
    first = F.ceil(F.col("size") * percent / 100).cast("bigint")
    last = F.floor(F.col("both") * (100 + percent) / percent - F.col("size")).cast("bigint")
    small = placed.filter((F.col("label") != F.col("home")) & (first <= last)).select(
        "centre", F.col("node").alias("m"), F.col("label").alias("m_label"), F.explode(F.sequence(first, last)).alias("size"))
    by_size = everyone.join(small, ["centre", "size"]).filter("label <> m_label").select("m", "node")
    pairs = by_shingle.unionByName(by_size).select(
        F.least("m", "node").alias("centre"), F.greatest("m", "node").alias("node")).distinct()
    other = size.select(F.col("node").alias("centre"), F.col("size").alias("centre_size"))
    fits = F.least("size", "centre_size") * 100 >= F.greatest("size", "centre_size") * percent
    return pairs.join(size, "node").join(other, "centre").filter(fits).select("centre", "node")


def _linked(nodes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the nodes that are similar to another one."""
    tables = cut_lineage(_keys(nodes))
    often = tables.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    keys = cut_lineage(tables.join(often, "key"))
    size = nodes.select("node", F.col("n_shingles").alias("size"))
    candidates = keys.select("node").distinct().join(nodes.select("node", "doc_id", "digest"), "node")
    sets = cut_lineage(docs.join(
        candidates.withColumnRenamed("doc_id", "_first"), F.col("doc_id").eqNullSafe(F.col("_first"))
    ).select("node", "digest", "text").mapInArrow(_sets, SET).dropDuplicates(["node"]))
    homes = cut_lineage(keys.groupBy("key").agg(F.min(F.struct("chance", "node")).alias("c")).select(
        "key", F.col("c.node").alias("centre")))
    links, labels, left, done = None, None, keys, None
    for turn in range(CENTRE_TURNS):
        if turn:
            placed = cut_lineage(_apart(left, labels))
            if placed.isEmpty():
                return labels
            centres = placed.groupBy("key").agg(F.min(F.struct("chance", "node", "label")).alias("c"))
            chosen = placed.join(centres, "key")
            pairs = chosen.filter("label <> c.label").select(F.col("c.node").alias("centre"), "node").distinct()
            pairs = pairs.join(done, ["centre", "node"], "left_anti")
        else:
            chosen = keys.join(homes.select("key", F.struct(F.col("centre").alias("node")).alias("c")), "key")
            pairs = chosen.filter("node <> c.node").select(F.col("c.node").alias("centre"), "node").distinct()
        left = cut_lineage(chosen.filter("node <> c.node").select("key", "node", "chance"))
        new = cut_lineage(pairs)
        found = cut_lineage(_links(_compared(new, sets), size, percent))
        links = found if links is None else links.unionByName(found)
        done = new if done is None else done.unionByName(new)
        labels = components(links)
    apart = _apart(keys, labels).select("key", "node", "label").join(homes, "key")
    home = labels.select(F.col("node").alias("centre"), F.col("label").alias("home"))
    groups = cut_lineage(apart.select("centre", "node", "label").distinct().join(home, "centre", "left").withColumn(
        "home", F.coalesce("home", "centre")))
    if groups.isEmpty():
        return labels
    rest = cut_lineage(_rest(groups, sets, size, percent).join(done, ["centre", "node"], "left_anti"))
    return components(links.unionByName(cut_lineage(_links(_compared(rest, sets), size, percent))))


def _judged(docs: DataFrame, id: str, text: str, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, label, component_id, kept) of every row; label numbers the component."""
    source = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("text_key"))
    prints = cut_lineage(source.mapInArrow(_prints, PRINT))
    # Numbers are given before the table is written, so they stay.
    nodes = cut_lineage(
        prints.filter("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ).withColumn("node", F.monotonically_increasing_id()))
    labels = _linked(nodes, source, percent)
    whole = nodes.select("digest", "doc_id", "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    least = whole.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = whole.join(least, "label").select("digest", "label", "component_id")
    joined = prints.drop("bands").join(named, "digest", "left")
    component = F.when(F.col("label").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_key", "n_shingles", "label", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of `docs`.

    Documents are linked when the similarity of their sets of 5-word shingles is `percent` or more;
    component_id is the smallest id that can be reached over links. Texts without words, empty or
    null, have an empty set and are linked with nothing. Rows with equal texts have equal sets and
    are linked, repeated rows too: those that repeat the smallest id are all kept. A null id is never
    the smallest unless all are null. No rows: no rows. Other columns are not read.
    """
    return _judged(docs, id, text, percent).drop("text_key", "label")


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """`docs` with one row of each group: the smallest id, and of rows repeating it any one.

    Rows are told apart by id and text. Rows without words stay. Columns may have any name.
    """
    docs, names = numbered(docs)
    id, text = names[id], names[text]
    judged = cut_lineage(_judged(docs, id, text, percent))
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    firsts = judged.filter("kept AND n_shingles > 0")
    repeated = cut_lineage(firsts.groupBy("label").agg(
        F.min("text_key").alias("least"), F.count("*").alias("n")).filter("n > 1"))
    again = not repeated.isEmpty()
    if again:
        others = firsts.join(repeated, "label").filter("text_key <> least")
        gone = gone.unionByName(others.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    keyed = docs.withColumn("_text_key", F.xxhash64(F.col(text).cast("string")))
    same = F.col(id).cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    left = keyed.join(gone.distinct(), same, "left_anti")
    if again:
        worded = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(WORD)
        left = left.filter(worded).dropDuplicates([id, "_text_key"]).unionByName(left.filter(~worded))
    return left.select(*[F.col(n).alias(c) for c, n in names.items()])
