"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A vocabulary of byte strings and ranks is turned into a model over characters: each byte has one
printable character. Ids go back to bytes by the reversed table, so a character whose bytes lie in
several tokens comes back whole when the tokens are joined.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

# A text is cut for the pattern before a blank between a non-blank and a letter. No match of a
# pattern whose blanks only lead a match can reach over such a place.
PIECE_CHARS = 1 << 20
SAFE_CUT = r"(?<=\S) (?=\p{L})"
# Pieces of text whose ids a worker remembers before it starts anew.
MEMO_PIECES = 400_000
# Tokens that are turned into bytes at a time.
DECODE_TOKENS = 1 << 20
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def byte_characters() -> list[str]:
    """The character of each byte: printable bytes stand for themselves, others follow from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class _Places(dict):
    """Gives each new piece of text the next place, and keeps it until it is encoded."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.new.append(piece)
        return place


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + length], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(total)]


class Codec:
    """Encoder and decoder of one vocabulary; built once per Python worker."""

    def __init__(self, ranks_file: bytes, pattern: str):
        from tokenizers import models

        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in ranks_file.splitlines() if line.strip())
        }
        letters = byte_characters()
        spelled = {t: "".join(letters[b] for b in t) for t in ranks}
        # Any two neighbours whose union is a token may merge, at the rank of the union.
        merges = [
            (spelled[t[:k]], spelled[t[k:]])
            for t in sorted(ranks, key=ranks.get)
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        vocabulary = {spelled[t]: rank for t, rank in ranks.items()}
        self.tokenize = models.BPE(vocabulary, merges, ignore_merges=True).tokenize
        self.letters = dict(enumerate(letters))
        back = {c: b for b, c in enumerate(letters)}
        tokens = {vocabulary[s]: bytes(back[c] for c in s) for s in vocabulary}
        top = max(tokens, default=-1) + 1
        self.lengths = np.array([len(tokens[k]) if k in tokens else -1 for k in range(top)], np.int64)
        self.starts = np.cumsum(np.maximum(self.lengths, 0)) - np.maximum(self.lengths, 0)
        self.table = np.frombuffer(b"".join(tokens.get(k, b"") for k in range(top)), np.uint8)
        self.matches = regex.compile(pattern).findall
        self.cut = regex.compile(SAFE_CUT).search
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _parts(self, text: str):
        start = 0
        while len(text) - start > PIECE_CHARS:
            found = self.cut(text, start + PIECE_CHARS)
            if not found:
                break
            yield text[start:found.start()]
            start = found.start()
        yield text[start:] if start else text

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Pieces are encoded once, by the library, then gathered by place."""
        if len(self.places) > MEMO_PIECES:
            self._forget()
        places = [[
            np.fromiter(map(self.places.__getitem__, pieces), np.int64, len(pieces))
            for pieces in map(self.matches, self._parts(text))
        ] for text in texts]
        if self.places.new:
            # Bytes are read as Latin-1 characters, and these are spelled with the byte table.
            ids = [
                [t.id for t in self.tokenize(p.encode().decode("latin-1").translate(self.letters))]
                for p in self.places.new
            ]
            self.places.new.clear()
            more = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) + self.ends[-1]
            new = np.fromiter(itertools.chain.from_iterable(ids), np.int32)
            self.flat, self.ends = np.concatenate([self.flat, new]), np.concatenate([self.ends, more])
        starts, lengths = self.ends[:-1], np.diff(self.ends)
        return [np.concatenate([_gather(self.flat, starts[at], lengths[at]) for at in parts]) for parts in places]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids) -> bytes:
        """The bytes of all tokens, joined: a character that lies in several tokens is whole again."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or self.lengths[ids].min() < 0):
            raise ValueError("there are ids that are not in this vocabulary")
        return b"".join(
            _gather(self.table, self.starts[part], self.lengths[part]).tobytes()
            for part in (ids[k:k + DECODE_TOKENS] for k in range(0, len(ids), DECODE_TOKENS))
        )

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Characters each token touches: a token with a part of a character spans all of it."""
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        of_byte = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[np.asarray(ids, np.int64)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return of_byte[starts], of_byte[ends - 1] + 1 if len(ends) else ends


@functools.lru_cache(maxsize=2)
def codec(ranks_file: bytes, pattern: str) -> Codec:
    return Codec(ranks_file, pattern)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    if ends[-1] >= 1 << 31:
        raise ValueError("too many ids in one Arrow batch; lower maxRecordsPerBatch")
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts, null as empty, with the place of the first: each ends behind PIECE_CHARS characters."""
    start, held, chars = 0, [], 0
    for t in texts:
        held.append(t.as_py() or "")
        chars += len(held[-1])
        if chars > PIECE_CHARS:
            yield start, held
            start, held, chars = start + len(held), [], 0
    if held:
        yield start, held


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add `ids`: the ids of each match of `pattern`, encoded separately, without special tokens.

    Null and empty texts have no ids. A column already named `ids` is replaced; repeated rows and
    other columns stay as they are. `path` is a file of base64 tokens and ranks, read once by the
    driver and sent with the task.
    """
    ranks_file = Path(path).read_bytes()

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encoded(texts: pa.Array) -> pa.Array:
        own = codec(ranks_file, pattern)
        return _lists([ids for _, held in _slices(texts) for ids in own.encode_batch(held)], pa.int32())

    return df.withColumn(ids, encoded(F.col(text)))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`: the bytes of the ids (binary). No ids, or null: no bytes. Unknown ids raise."""
    ranks_file = Path(path).read_bytes()

    @F.arrow_udf(T.BinaryType())
    def decoded(lists: pa.Array) -> pa.Array:
        own = codec(ranks_file, pattern)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return pa.array([own.decode(x) for x in np.split(flat, ends[:-1])] if len(lists) else [], pa.binary())

    return df.withColumn(out, decoded(F.col(ids)))


def _both(
    batches: Iterator[pa.RecordBatch], own: Codec, kept: list[str], ids: str, out: str
) -> Iterator[pa.RecordBatch]:
    """The columns `kept` of batches that end with a text, with its ids and their bytes, in slices.

    The pieces are forgotten at the end of the task: the worker lives on, beside tasks of other stages.
    """
    try:
        for batch in batches:
            for start, held in _slices(batch.column(len(kept))):
                lists = own.encode_batch(held)
                columns = batch.slice(start, len(held)).columns[:len(kept)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, _lists(lists, pa.int32()), pa.array(map(own.decode, lists), pa.binary())],
                    [*kept, ids, out])
    finally:
        own._forget()


def encode_and_decode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """`df` without its texts, with the `ids` and `out` that `encode` and then `decode` give.

    An Arrow batch holds up to 10,000 rows, and its ids and bytes are larger than its texts. Here they
    leave in slices of about PIECE_CHARS characters, so that a worker holds those of one slice.
    """
    ranks_file = Path(path).read_bytes()
    kept = [c for c in df.columns if c not in (text, ids, out)]
    schema = T.StructType([df.schema[c] for c in kept]).add(ids, T.ArrayType(T.IntegerType(), False)).add(out, T.BinaryType())

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _both(batches, codec(ranks_file, pattern), kept, ids, out)

    return df.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(both, schema)


def token_spans(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "spans"
) -> DataFrame:
    """Add `out`: start and end, in code points, of the characters each token belongs to."""
    ranks_file = Path(path).read_bytes()

    @F.arrow_udf(T.ArrayType(SPAN))
    def spanned(texts: pa.Array, lists: pa.Array) -> pa.Array:
        own = codec(ranks_file, pattern)
        rows = []
        for t, x in zip(texts, lists):
            starts, ends = own.spans(t.as_py() or "", x.as_py() or [])
            rows.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))

    return df.withColumn(out, spanned(F.col(text), F.col(ids)))


def with_digests(decoded: DataFrame) -> DataFrame:
    """Add n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256."""
    return decoded.withColumns({
        "n_tokens": F.size("ids").cast("bigint"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    })


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of `df`(doc_id, text): encoded, then decoded."""
    digests = with_digests(encode_and_decode(df.select("doc_id", "text"), path, pattern))
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
