"""Document fingerprints by content-defined chunking.

Chunk ends are set by a gear hash of the last bytes, normalised: a strict mask before the normal
size, a loose one after it. An edit moves the ends near it only, so the other chunks keep their
digests wherever they lie. A fingerprint is the set of chunk digests with their lengths; likeness
is the share of a fingerprint's length that the other contains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

# Sizes in bytes. The window of the gear hash is not longer than the least chunk.
LEAST, NORMAL, MOST, WINDOW = 16, 64, 255, 16
STRICT_BITS, LOOSE_BITS = 8, 4
SEED = 0x9E3779B97F4A7C15
BLOCKS_PER_PARTITION = 4
FIRST_KEY = -(1 << 63)
SLICE_BYTES = 1 << 22


def gear_table(seed: int = SEED) -> np.ndarray:
    """One 32-bit number per byte value, by the splitmix64 rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(seed)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of `data`, ascending; the last is its length."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, width * 2
    loose_at = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS)))
    strict_at = loose_at[h[loose_at] < np.uint32(1 << (32 - STRICT_BITS))]
    strict, loose = strict_at.tolist(), loose_at.tolist()
    ends, start, s, w, n_strict, n_loose = [], 0, 0, 0, len(strict), len(loose)
    while n - start > LEAST:
        low, normal = start + LEAST - 1, start + NORMAL
        while s < n_strict and strict[s] < low:
            s += 1
        if s < n_strict and strict[s] < normal:
            end = strict[s] + 1
        else:
            while w < n_loose and loose[w] < normal:
                w += 1
            end = min(loose[w] + 1 if w < n_loose else n, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_weights(data: bytes) -> dict[int, int]:
    """Digest and length of each different chunk."""
    out, start = {}, 0
    digest = xxhash.xxh3_64_intdigest
    for end in chunk_ends(data):
        out[digest(data[start:end])] = end - start
        start = end
    return out


def fingerprint(weights: dict[int, int]) -> str:
    """18 hexadecimal digits per chunk, ascending: the digest, then the length."""
    rows = np.empty(len(weights), np.dtype([("digest", ">u8"), ("length", "u1")]))
    rows["digest"] = np.fromiter(weights.keys(), np.uint64, len(weights))
    rows["length"] = np.fromiter(weights.values(), np.uint8, len(weights))
    rows.sort(order="digest")
    return rows.tobytes().hex()


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """Share of the own length whose chunks the other has. Two empty sets: 1, one: 0."""
    if not own or not other:
        return float(not own and not other)
    return sum(map(own.__getitem__, own.keys() & other.keys())) / sum(own.values())


def chunks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, chunk, start, length, digest): every chunk of every text, offsets in UTF-8 bytes."""
    kind = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.IntegerType()),
        T.StructField("digest", T.StringType()),
    ]))

    @F.arrow_udf(kind)
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            data = (t.as_py() or "").encode("utf-8")
            start, row = 0, []
            for end in chunk_ends(data):
                row.append({"start": start, "length": end - start,
                            "digest": xxhash.xxh3_64_hexdigest(data[start:end])})
                start = end
            rows.append(row)
        return pa.array(rows, pa.list_(pa.struct(
            [("start", pa.int64()), ("length", pa.int32()), ("digest", pa.string())])))

    cut_up = df.select(F.col(key), cut(F.col(text)).alias("_chunks"))
    return cut_up.select(key, F.posexplode("_chunks").alias("chunk", "_c")).select(key, "chunk", "_c.*")


def _in_order(docs: DataFrame) -> DataFrame:
    """(block, tail, key, doc_id, text) sorted inside blocks of ascending doc_id.

    Block bounds are quantiles of the ids (a list of fixed length). The first document of a block
    also closes the block before it, as its tail, and the very first closes the last block; so
    every document is followed by its next one, and each text is shuffled once.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_KEY)).alias("key"), "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    n = BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    first, cuts = keyed.agg(
        F.min("key"), F.percentile_approx("key", [k / n for k in range(1, n)], 100 * n)
    ).first()
    bounds = np.array(sorted({c for c in cuts or [] if c > first}), np.int64)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def places(keys: pa.Array) -> pa.Array:
        # Block 2b holds the documents of b; an odd number, 2b + 1, is its tail.
        values = keys.to_numpy(zero_copy_only=False)
        block = np.searchsorted(bounds, values, side="right")
        opens = np.isin(values, bounds)
        return pa.array([
            [2 * b] + ([2 * b - 1] if o else []) + ([2 * len(bounds) + 1] if v == first else [])
            for b, o, v in zip(block.tolist(), opens.tolist(), values.tolist())
        ], pa.list_(pa.int32()))

    placed = keyed.withColumn("_place", F.explode(places("key")))
    return placed.select(
        F.shiftright("_place", 1).alias("block"), F.col("_place").bitwiseAND(F.lit(1)).alias("tail"),
        "key", "doc_id", "text",
    ).repartition("block").sortWithinPartitions("block", "tail", "key", F.xxhash64("text"), "text")


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])
    rows: list[tuple] = []
    held = 0

    def full() -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    before = None
    for batch in batches:
        block, tail, ids, texts = (batch.column(k) for k in ("block", "tail", "doc_id", "text"))
        for k in range(batch.num_rows):
            text, own_block, is_tail = texts[k].as_py(), block[k].as_py(), tail[k].as_py()
            weights = chunk_weights(text.encode("utf-8"))
            if before and before[0] == own_block:
                _, doc_id, old, old_weights = before
                cut = len(old) // 4
                edited = (old[:len(old) - cut] + text[:cut]).encode("utf-8")
                edited_weights = chunk_weights(edited)
                row = (
                    doc_id, len(old), hashlib.sha256(edited).hexdigest(), fingerprint(old_weights),
                    fingerprint(edited_weights), containment(old_weights, edited_weights),
                    containment(old_weights, weights),
                )
                rows.append(row)
                held += len(row[3]) + len(row[4])
            # Behind a tail nothing of its block is compared any more.
            before = None if is_tail else (own_block, ids[k].as_py(), text, weights)
            if held > SLICE_BYTES:
                yield full()
                rows, held = [], 0
    if rows:
        yield full()


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text of `docs`(doc_id, text) and of its edited text.

    The edited text has its last floor(n / 4) code points replaced by the first as many of the
    next document by ascending doc_id (the last one is followed by the first; a single document by
    itself). Null texts are empty; an empty text has the fingerprint '' and is contained in empty
    ones only. Null ids come first; rows with one id are ordered by a hash of the text, then by the
    text; repeated rows follow each other. No rows: no rows. Other columns are not read.
    """
    if docs.select("doc_id").isEmpty():
        return docs.sparkSession.createDataFrame([], RESULT)
    return _in_order(docs.select("doc_id", "text")).mapInArrow(_compare, RESULT)
