"""Chat formatting: the turns of conversations become marked texts with a loss mask.

Turns are assembled by columns of bytes: the lengths of all segments of a batch give cumulative
offsets, these give the place of every byte, and headers, contents and footers are scattered into
one preallocated Arrow buffer whose slices are the formatted texts.

Control strings inside contents are escaped by a mark after their first character; one that already
has marks there gets one more. So taking one mark away restores every content, and a control string
without a mark is always the template's own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

MARK = "\\"
# Contents of at most so many bytes are assembled at a time; a longer turn is assembled alone.
CHUNK_BYTES = 1 << 22
# Contents from this size are copied as a slice, not by an index for each byte.
SLICE_BYTES = 1 << 16
READ_ROWS = 4096


@dataclass(frozen=True)
class Template:
    """`opening` role, line feed, text, `closing`, line feed; `controls` are escaped in contents."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>"
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]",
    )
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not {self.opening, self.closing} <= set(self.controls):
            raise ValueError("opening and closing have to be control strings")
        for one in self.controls:
            if len(one) < 2 or MARK in one or "\n" in one:
                raise ValueError(f"{one!r} cannot be a control string")
            for k in range(1, len(one)):
                if any(one[k:].startswith(c[:len(one) - k]) for c in self.controls):
                    raise ValueError(f"control strings overlap in {one!r}")

    def rules(self) -> list[tuple[str, str]]:
        """(first character, pattern of what may follow it), a rule per first character."""
        firsts = sorted({c[0] for c in self.controls})
        return [
            (re.escape(f), "|".join(re.escape(c[1:]) for c in self.controls if c[0] == f)) for f in firsts]


TEMPLATE = Template()
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def escape(texts: pa.Array, template: Template = TEMPLATE) -> pa.Array:
    for first, rest in template.rules():
        texts = pc.replace_substring_regex(texts, rf"({first})(\\*)({rest})", r"\1\\\2\3")
    return texts


def escape_roles(roles: pa.Array, template: Template = TEMPLATE) -> pa.Array:
    """A role is one line: marks are doubled and a line feed becomes a mark and `n`."""
    lines = pc.replace_substring(pc.replace_substring(roles, MARK, MARK * 2), "\n", MARK + "n")
    return escape(lines, template)


class Reader:
    """Takes formatted bytes apart again."""

    def __init__(self, template: Template = TEMPLATE):
        self.opening = template.opening.encode()
        self.closing = template.closing.encode() + b"\n"
        self.marked = [
            re.compile(rf"({first})\\(\\*(?:{rest}))".encode()) for first, rest in reversed(template.rules())]
        self.in_role = re.compile(rb"\\(.)", re.DOTALL)

    def content(self, escaped: bytes) -> bytes:
        for pattern in self.marked:
            escaped = pattern.sub(rb"\1\2", escaped)
        return escaped

    def role(self, escaped: bytes) -> bytes:
        return self.in_role.sub(lambda m: b"\n" if m[1] == b"n" else m[1], self.content(escaped))

    def turns(self, formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
        """(role, text) of each turn."""
        start = 0
        while start < len(formatted):
            line = formatted.index(b"\n", start)
            end = formatted.index(self.closing, line)
            if not formatted.startswith(self.opening, start):
                raise ValueError("a turn does not begin with its header")
            yield self.role(formatted[start + len(self.opening):line]), self.content(formatted[line + 1:end])
            start = end + len(self.closing)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of large strings without nulls."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return flat, ends


def assemble(segments: list[bytes | pa.Array], n: int) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """(buffer, starts, lengths): for each of `n` rows, all segments one after the other.

    A segment is the same bytes for all rows, or an array with a text per row. starts and lengths
    have a row per row and a column per segment.
    """
    parts = [s if isinstance(s, bytes) else _bytes_of(s) for s in segments]
    lengths = np.empty((n, len(parts)), np.int64)
    for k, part in enumerate(parts):
        lengths[:, k] = len(part) if isinstance(part, bytes) else np.diff(part[1])
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    buffer = pa.allocate_buffer(int(ends[-1, -1]) if n else 0)
    out = np.frombuffer(buffer, np.uint8)
    for k, part in enumerate(parts):
        if isinstance(part, bytes):
            out[starts[:, k, None] + np.arange(len(part))] = np.frombuffer(part, np.uint8)
            continue
        flat, offsets = part
        short = lengths[:, k] < SLICE_BYTES
        for row in np.flatnonzero(~short):
            at, size = starts[row, k], lengths[row, k]
            out[at:at + size] = flat[offsets[row]:offsets[row] + size]
        sizes = lengths[short, k]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(starts[short, k], sizes) + inside] = flat[np.repeat(offsets[:-1][short], sizes) + inside]
    return buffer, starts, lengths


def _chunks(sizes: np.ndarray, chunk_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `chunk_bytes` together, or of one row."""
    start, ends = 0, np.cumsum(sizes)
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + chunk_bytes, "right")))
        yield start, stop
        start = stop


def _formatter(template: Template, chunk_bytes: int):
    opening, closing = template.opening.encode(), template.closing.encode() + b"\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, -1
        for batch in batches:
            key = batch.column(0)
            texts = [pc.fill_null(batch.column(k).cast(pa.large_string()), "") for k in (1, 2)]
            for start, stop in _chunks(np.diff(_bytes_of(texts[1])[1]), chunk_bytes):
                n = stop - start
                roles, contents = (t.slice(start, n) for t in texts)
                buffer, starts, lengths = assemble(
                    [opening, escape_roles(roles, template), b"\n", escape(contents, template), closing], n)
                codes = key.slice(start, n).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                firsts = np.flatnonzero(np.diff(codes, prepend=-1))
                bounds = np.append(firsts, n)
                offsets = np.append(starts[firsts, 0], buffer.size)
                keys = key.slice(start, n).take(pa.array(firsts))
                # Parts of a conversation count on from chunk to chunk.
                numbers = np.zeros(len(firsts), np.int64)
                if last is not None and keys[:1].equals(last):
                    numbers[0] = part + 1
                last, part = keys[-1:], int(numbers[-1])
                graded = pc.is_in(roles, pa.array(template.loss_roles, pa.large_string())).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(firsts)), np.diff(bounds))
                begins = starts[:, 3] - offsets[owner]
                spans = pa.StructArray.from_arrays(
                    [pa.array(begins[graded].astype(np.int32)), pa.array((begins + lengths[:, 3])[graded].astype(np.int32))],
                    ["start", "end"])
                per_part = np.append(0, np.cumsum(np.bincount(owner[graded], minlength=len(firsts))))
                yield pa.RecordBatch.from_arrays([
                    keys, pa.array(numbers), pa.array(np.diff(bounds)),
                    pa.StringArray.from_buffers(len(firsts), pa.py_buffer(offsets.astype(np.int32)), buffer),
                    pa.ListArray.from_arrays(pa.array(per_part.astype(np.int32)), spans),
                ], ["conv_id", "part", "n_turns", "formatted", "loss"])

    return run


def format_conversations(
    turns: DataFrame, template: Template = TEMPLATE, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss) from turns (conv_id, turn, role, text).

    `formatted` of the parts of a conversation, in order, is its text; `loss` has the byte spans of
    the part under the loss mask, the escaped texts of the loss roles. Most conversations are one
    part; a new one begins where a batch or `chunk_bytes` of contents end, so that memory is bounded
    whatever the length of a conversation. A conversation comes out of one task as a stream.

    Turns are ordered by (turn, role, text), null turns first; repeated rows are turns of their own.
    Null role or text is empty. Rows with a null conv_id are one conversation. An empty table gives
    no rows; other columns are not read.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    schema = T.StructType([
        T.StructField("conv_id", turns.schema["conv_id"].dataType), T.StructField("part", T.LongType()),
        T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()),
        T.StructField("loss", T.ArrayType(SPAN)),
    ])
    return ordered.select("conv_id", "role", "text").mapInArrow(_formatter(template, chunk_bytes), schema)


class _Digest:
    """What is read back of one conversation, part by part."""

    def __init__(self, key, reader: Reader):
        self.key, self.reader = key, reader
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        whole = formatted.encode()
        for role, text in self.reader.turns(whole):
            self.n_turns += 1
            for piece in (role, b"\n", text, b"\n"):
                self.turns.update(piece)
        for span in spans:
            text = self.reader.content(whole[span["start"]:span["end"]])
            self.loss.update(text)
            self.loss_chars += len(text.decode())

    def row(self) -> tuple:
        return (self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _reader(template: Template, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, rows = Reader(template), None, []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            keys, texts, loss = batch.column("conv_id"), batch.column("formatted"), batch.column("loss")
            for k in range(len(keys)):
                key = keys[k].as_py()
                if now is None or key != now.key:
                    if now is not None:
                        rows.append(now.row())
                    now = _Digest(key, reader)
                now.add(texts[k].as_py(), loss[k].as_py())
            if len(rows) >= READ_ROWS:
                yield packed()
                rows = []
        if now is not None:
            rows.append(now.row())
        if rows:
            yield packed()

    return run


def read_back(formatted: DataFrame, template: Template = TEMPLATE, in_order: bool = False) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from parts alone.

    Turns are found and unescaped in the formatted text, the graded text by the spans. The digests
    go over a conversation in order, so it streams through one task, a part at a time. `in_order`:
    the parts come straight from `format_conversations` and are not shuffled again.
    """
    parts = formatted if in_order else formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = T.StructType([
        T.StructField("conv_id", formatted.schema["conv_id"].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ])
    return parts.select("conv_id", "formatted", "loss").mapInArrow(_reader(template, to_arrow_schema(schema)), schema)
