"""Spelling variants: words at one edit from each other, and the form each variant stands for.

Edits of every word are generated in numpy and probed against blocked Bloom filters that are sharded
by the length of the words they hold. Only hashes of positives are shuffled, to an exact join with
the vocabulary that removes false positives by comparing the words themselves.

Nearness is symmetric, so a pair is found from one side: by deletions from the longer word, and by
replacements with a later letter of the alphabet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, cut_lineage, let

# Letters of the words: Basic Latin in lower case and Latin-1 from U+00C0 on.
ALPHABET = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 6, 5, 5
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# A block is 512 bits and is chosen once per key; BITS_PER_WORD bits of filter per key, PROBES set.
BLOCK_WORDS, BITS_PER_WORD, PROBES = 8, 12, 6
# Words of a shard, so that a shard is built in one task of bounded memory.
SHARD_WORDS = 1 << 19
# Bytes of filters that are broadcast at a time; more filters mean more passes, not a larger broadcast.
BROADCAST_BYTES = 32 << 20
# Edits that are hashed at a time; their arrays are what a worker holds besides the filters.
EDITS = 1 << 17


def run_words(text: Column, owner: Column, least: int = LEAST_LETTERS, loss: int = 199) -> Column:
    """Runs of letters of a text, A-Z lower-cased, some of them one letter short.

    A run loses a letter where `loss` divides the crc32 of `<owner>:<run>`; runs that cannot have
    `least` letters are not looked at. A null text has none, a null owner counts as empty.
    """
    letters = r"[A-Za-zÀ-ÿ]"
    head = F.concat(F.coalesce(owner.cast("string"), F.lit("")), F.lit(":"))

    def spelled(run: Column) -> Column:
        def lost(h: Column) -> Column:
            at = (h % F.char_length(run)).cast("int")
            shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
            return F.when(h % loss == 0, shorter).otherwise(run)

        return let(F.crc32(F.concat(head, run).cast("binary")), lost)

    runs = F.regexp_extract_all(ascii_lower(text), F.lit(f"{letters}{{{least},}}"), F.lit(0))
    return F.transform(runs, spelled)


def vocabulary(
    words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n, size, h) of the words that are long and frequent enough; `words` has a column word."""
    counted = words.groupBy("word").agg(F.count("*").alias("n")).filter(
        (F.char_length("word") >= least_letters) & (F.col("n") >= least_count))
    hashed = F.pandas_udf(_hash_words, "bigint")
    return counted.withColumn("size", F.char_length("word")).withColumn("h", hashed("word"))


def _codes(words: list[str], size: int) -> np.ndarray:
    """Code points, a row per word of `size` letters."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size).astype(np.uint64)


def _powers(size: int) -> np.ndarray:
    """BASE ** (size - 1 - i) of each place i."""
    return np.cumprod(np.append(np.uint64(1), np.full(max(size - 1, 0), BASE)), dtype=np.uint64)[::-1][:size]


def _by_length(words: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
    for size, rows in words.reset_index(drop=True).groupby(words.str.len().to_numpy()).groups.items():
        yield int(size), rows.to_numpy()


def _hash_words(words: pd.Series) -> pd.Series:
    """Polynomial hash modulo 2^64 of the code points."""
    out = np.zeros(len(words), np.uint64)
    for size, rows in _by_length(words):
        step = max(1, EDITS // max(size, 1))
        for start in range(0, len(rows), step):
            part = rows[start:start + step]
            out[part] = _codes(words.iloc[part].tolist(), size) @ _powers(size)
    return pd.Series(out.view(np.int64))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash (finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    """First word of the block of a mixed hash: its upper half chooses the block."""
    return (((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64) * BLOCK_WORDS


def _probe(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(word of the block, bit of the word) of the k-th probe, from the lower half and its own mix."""
    nine = h >> np.uint64(9 * k) if k < 3 else _mixed(h + BASE) >> np.uint64(9 * k)
    return ((nine >> np.uint64(6)) & np.uint64(BLOCK_WORDS - 1)).astype(np.int64), np.uint64(1) << (nine & np.uint64(63))


class BlockedFilter:
    """A Bloom filter whose probes of a key all lie in one block of 512 bits."""

    def __init__(self, words: np.ndarray):
        self.words, self.blocks = words, len(words) // BLOCK_WORDS

    @classmethod
    def of(cls, hashes: np.ndarray) -> BlockedFilter:
        blocks = max(1, -(-len(hashes) * BITS_PER_WORD // (64 * BLOCK_WORDS)))
        words = np.zeros(blocks * BLOCK_WORDS, np.uint64)
        mixed = _mixed(hashes)
        start = _block(mixed, blocks)
        for k in range(PROBES):
            word, bit = _probe(mixed, k)
            np.bitwise_or.at(words, start + word, bit)
        return cls(words)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Rows whose key may be in the filter; a row that is left out is not in it."""
        mixed = _mixed(hashes)
        rows, start = None, _block(mixed, self.blocks)
        for k in range(PROBES):
            word, bit = _probe(mixed, k)
            ok = np.flatnonzero(self.words[start + word] & bit)
            rows = ok if rows is None else rows[ok]
            mixed, start = mixed[ok], start[ok]
        return rows


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (_mixed(h ^ BASE) % np.uint64(shards)).astype(np.int64)


def filters(vocab: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(size, shard, bits): the filters of the words of each length, in shards of about SHARD_WORDS."""
    counts = {size: max(1, math.ceil(n / SHARD_WORDS)) for size, n in sizes.items()}

    def shard(size: pd.Series, h: pd.Series) -> pd.Series:
        keys, out = h.to_numpy().view(np.uint64), np.zeros(len(h), np.int64)
        for one in size.unique():
            own = (size == one).to_numpy()
            out[own] = _shard(keys[own], counts[int(one)])
        return pd.Series(out)

    def built(group: pd.DataFrame) -> pd.DataFrame:
        bits = BlockedFilter.of(group["h"].to_numpy().view(np.uint64)).words.tobytes()
        return pd.DataFrame({"size": [group["size"].iloc[0]], "shard": [group["shard"].iloc[0]], "bits": [bits]})

    placed = vocab.select("size", "h", F.pandas_udf(shard, "bigint")("size", "h").alias("shard"))
    return placed.groupBy("size", "shard").applyInPandas(built, "size int, shard bigint, bits binary")


def _edits(words: list[str], size: int, letters: np.ndarray, kept: set[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row of the word, hash of the edit): deletions, and replacements by later letters."""
    codes, powers = _codes(words, size), _powers(size)
    h = codes @ powers
    # Hashes of what lies before and after each place.
    ahead = np.zeros((len(words), size + 1), np.uint64)
    for i in range(size):
        ahead[:, i + 1] = ahead[:, i] * BASE + codes[:, i]
    if size - 1 in kept:
        tail = h[:, None] - ahead[:, 1:] * powers
        shorter = ahead[:, :-1] * powers + tail
        yield size - 1, np.repeat(np.arange(len(words)), size), shorter.ravel()
    if size in kept:
        step = max(1, EDITS // (len(words) * len(letters)))
        for start in range(0, size, step):
            own = codes[:, start:start + step, None]
            changed = h[:, None, None] + (letters - own) * powers[start:start + step, None]
            later = np.flatnonzero(letters > own)
            yield size, later // (own.shape[1] * len(letters)), changed.ravel()[later]


def candidates(vocab: DataFrame, sizes: dict[int, int], alphabet: str = ALPHABET) -> DataFrame:
    """(h, edit): hashes of words and of their edits that a filter may hold.

    Filters are broadcast in passes of at most BROADCAST_BYTES (a shard at least); a pass reads only
    words of the lengths that can reach its shards.
    """
    spark = vocab.sparkSession
    made = cut_lineage(filters(vocab, sizes))
    shards = {size: max(1, math.ceil(n / SHARD_WORDS)) for size, n in sizes.items()}
    listed = made.select("size", "shard", F.octet_length("bits").alias("bytes")).orderBy("size", "shard")
    passes, room = [], 0
    for size, shard, n in listed.toLocalIterator():
        if not passes or n > room:
            passes.append([])
            room = BROADCAST_BYTES
        passes[-1].append((size, shard))
        room -= n
    letters = np.array(sorted({ord(c) for c in alphabet}), np.uint64)
    found = None
    for group in passes:
        wanted = F.struct("size", "shard").isin([F.struct(F.lit(a).cast("int"), F.lit(b).cast("bigint")) for a, b in group])
        held = spark.sparkContext.broadcast(
            {(r["size"], r["shard"]): bytes(r["bits"]) for r in made.filter(wanted).toLocalIterator()})
        lengths = sorted({size for size, _ in group})
        reach = vocab.filter(F.col("size").isin(lengths + [n + 1 for n in lengths])).select("word")
        probed = reach.mapInArrow(_prober(held, shards, letters), "h bigint, edit bigint")
        found = probed if found is None else found.unionByName(probed)
    return found


def _prober(held, shards: dict[int, int], letters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {key: BlockedFilter(np.frombuffer(bits, np.uint64)) for key, bits in held.value.items()}
        kept = {size for size, _ in tables}
        for batch in batches:
            words = batch.column(0).to_pandas()
            for size, rows in _by_length(words):
                step = max(1, EDITS // (size * len(letters)))
                for start in range(0, len(rows), step):
                    part = words.iloc[rows[start:start + step]]
                    own = _hash_words(part).to_numpy()
                    for length, source, edits in _edits(part.tolist(), size, letters, kept):
                        of = _shard(edits, shards[length]) if shards[length] > 1 else None
                        for shard in range(shards[length]):
                            if (length, shard) not in tables:
                                continue
                            mine = np.arange(len(edits)) if of is None else np.flatnonzero(of == shard)
                            hits = mine[tables[length, shard].holds(edits[mine])]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[source[hits]]), pa.array(edits[hits].view(np.int64))], ["h", "edit"])

    return run


def one_edit(a: Column, b: Column) -> Column:
    """Whether two strings differ by exactly one inserted, deleted or replaced code point."""
    return F.levenshtein(a, b, 1) == 1


def near_words(vocab: DataFrame, alphabet: str = ALPHABET) -> DataFrame:
    """(word, n, near, near_n): all pairs of words at one edit, both ways.

    vocab: word (unique, of letters of `alphabet`), n, size, h, see `vocabulary`.
    """
    sizes = {r["size"]: r["count"] for r in vocab.groupBy("size").count().toLocalIterator()}
    if not sizes:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    hits = candidates(vocab, sizes, alphabet).distinct()
    of = vocab.select("h", "word", "n")
    at = vocab.select(F.col("h").alias("edit"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = hits.join(at, "edit").join(of, "h").filter(one_edit(F.col("word"), F.col("near")))
    once = cut_lineage(pairs.select("word", "n", "near", "near_n"))
    return once.unionByName(once.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of the chain of forms, by doubling.

    Counts grow along a chain by a factor, so chains are short and have no cycle.
    """
    state = forms.select("word", F.col("form").alias("root"))
    while True:
        step = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = cut_lineage(state.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        moved = not state.filter("moved").isEmpty()
        state = state.select("word", "root")
        if not moved:
            return state


def spelling_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", factor: int = FORM_FACTOR,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of the texts; see `run_words`, `vocabulary`.

    The form of a word is its near word of largest n, the first in code-point order among equals, if
    that n is at least `factor` times the word's own; the root is what the forms lead to. Null and
    empty texts have no words, repeated rows count again, an empty table gives no rows, and other
    columns are not read.
    """
    words = docs.select(F.explode(run_words(F.col(text), F.col(doc_id))).alias("word"))
    vocab = cut_lineage(vocabulary(words))
    near = near_words(vocab)
    counted = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("best_n"))
    # Only the words at the largest n of a form are compared as text.
    known = cut_lineage(vocab.select("word", "n").join(counted, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best_n") >= factor * F.col("n"), F.col("best_n")).alias("form_n")))
    forms = cut_lineage(near.join(known.filter("form_n is not null").select("word", "form_n"), "word").filter(
        "near_n = form_n").groupBy("word").agg(F.min("near").alias("form")))
    return known.join(forms, "word", "left").join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
