"""WARC archives: a writer that replaces equal payloads by revisits, and a splittable reader.

Every record is a gzip member of its own. The reader cuts files into byte ranges. A task looks for
gzip magic from the start of its range, takes a candidate only if it decodes to a WARC header, and
then owns all records that start inside the range.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import fresh_dir
from .common import cut_lineage, join_dimension

REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 18
SLICE_BYTES = 1 << 22
GZIP_LEVEL = 6
MAGIC = b"\x1f\x8b\x08"
ID = "urn:noticeloom:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()),
    T.StructField("records", T.LongType()),
])
RECORD = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("refers_to_id", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("payload_length", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])


def _header_value(value: str) -> str:
    """Control characters would end the line: they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit carries the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Payload-Length: {length}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        head += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    record = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(record) + packer.flush()


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, length, revisit, refers_to) of `pages`(page_id, url, html).

    Of equal payloads of at least 1000 bytes the rows with the largest page_id are responses, the
    others revisit it. Equal payloads are found by SHA-1 and length with a pre-aggregated grouping;
    only digests that occur twice are joined back, broadcast when few, salted when many.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "length": F.octet_length("payload").cast("bigint")})
    top = cut_lineage(
        rows.filter(F.col("length") >= REVISIT_BYTES).groupBy("digest", "length")
        .agg(F.max("page_id").alias("top"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    joined = join_dimension(rows, top, ["digest", "length"], ["page_id"])
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "length",
        revisit.alias("revisit"), F.when(revisit, F.col("top")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records below `folder`, one archive per task; returns the manifest as a table.

    A task writes to a name of its own attempt and reports it when it ends, so archives of lost
    attempts are in no manifest. The folder must be shared and of a scheme that pyarrow opens.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = pafs.FileSystem.from_uri(folder)
        name, size, n, out = f"{at}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "length", "refers_to", "revisit")]
            for values in zip(*columns):
                if out is None:
                    files.create_dir(at, recursive=True)
                    out = files.open_output_stream(name, compression=None)
                data = member(*[v.as_py() for v in values])
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            uri = f"{folder.rstrip('/')}/{name.rsplit('/', 1)[1]}"
            yield pa.RecordBatch.from_pydict(
                {"path": [uri], "bytes": [size], "records": [n]},
                pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]),
            )

    return cut_lineage(records.mapInArrow(write, MANIFEST))


class _Bytes:
    """Reads ahead over one file, so that looking and decoding share what was read."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def at(self, place: int, n: int = READ_BYTES) -> bytes:
        """At least one byte from `place` on, up to n; none at the end of the file."""
        inside = place - self.start
        if not 0 <= inside < len(self.data):
            self.file.seek(place)
            self.start, self.data, inside = place, self.file.read(min(READ_BYTES, self.size - place)), 0
        return self.data[inside:inside + n]


def _head(record: bytes) -> dict[str, str] | None:
    """The header fields if `record` begins with a WARC header, else None."""
    end = record.find(b"\r\n\r\n")
    if end < 0 or not record.startswith(b"WARC/"):
        return None
    fields = {}
    for line in record[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    fields["_end"] = str(end + 4)
    return fields if "warc-type" in fields and "content-length" in fields else None


def _decode(source: _Bytes, place: int, head_only: bool = False) -> tuple[bytes, int] | None:
    """The member at `place` and where it ends; None if it is none or damaged."""
    unpack, out = zlib.decompressobj(31), bytearray()
    try:
        while not unpack.eof:
            data = source.at(place)
            if not data:
                return None
            known = max(0, len(out) - 3)
            out += unpack.decompress(data)
            place += len(data) - len(unpack.unused_data)
            # A header may be longer than any read: it ends where it ends.
            if head_only and len(out) >= 5 and (not out.startswith(b"WARC/") or out.find(b"\r\n\r\n", known) >= 0):
                break
    except zlib.error:
        return None
    return bytes(out), place


def _find(source: _Bytes, place: int, end: int) -> int | None:
    """First place in [place, end) where a member with a WARC header starts."""
    while place < end:
        data = source.at(place)
        if not data:
            return None
        if len(data) < len(MAGIC):
            data = data + source.at(place + len(data), len(MAGIC) - len(data))
            if len(data) < len(MAGIC):
                return None
        found = data.find(MAGIC)
        if found < 0:
            # The magic may begin in the last two bytes.
            place += len(data) - len(MAGIC) + 1
            continue
        place += found
        if place >= end:
            return None
        tried = _decode(source, place, head_only=True)
        if tried and _head(tried[0]):
            return place
        place += 1
    return None


def records_in(file, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header, block) of the records that start in [start, end), damaged ones left out."""
    source = _Bytes(file, size)
    place = _find(source, start, end)
    while place is not None and place < end:
        got = _decode(source, place)
        fields = got and _head(got[0])
        if fields:
            begin = int(fields["_end"])
            yield place, fields, got[0][begin:begin + int(fields["content-length"])]
            after = got[1]
            follows = source.at(after, len(MAGIC))
            place = after if follows == MAGIC else _find(source, after, end)
        else:
            place = _find(source, place + 1, end)


def read_archives(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records (RECORD) of the archives of `manifest`(path, bytes), read by byte ranges.

    The payload is the body behind the HTTP header, null for revisits. No archives: no rows.
    """
    last = F.greatest(F.col("bytes") - 1, F.lit(0))
    splits = manifest.select(
        "path", "bytes",
        F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(split_bytes).cast("bigint"))).alias("start"),
    )
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0]
    wide = 2 * spark.sparkContext.defaultParallelism
    tasks = max(1, min(int(n or 1), max(wide, int(spark.conf.get("spark.sql.shuffle.partitions")))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
            ("record_id", pa.string()), ("refers_to_id", pa.string()), ("target_uri", pa.string()),
            ("digest", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary()),
        ])
        rows, held = [], 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start"))):
                files, at = pafs.FileSystem.from_uri(path)
                with files.open_input_file(at) as file:
                    for offset, fields, block in records_in(file, size, start, min(start + split_bytes, size)):
                        kind = fields["warc-type"]
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        rows.append((
                            path, offset, kind, fields.get("warc-record-id", "").strip("<>"),
                            fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
                            fields.get("warc-target-uri"),
                            base64.b32decode(digest).hex() if digest else None,
                            int(fields["warc-payload-length"]) if "warc-payload-length" in fields else None,
                            block[block.find(b"\r\n\r\n") + 4:] if kind == "response" else None,
                        ))
                        held += len(block)
                        if held > SLICE_BYTES:
                            yield full()
                            rows, held = [], 0
        if rows:
            yield full()

    return splits.repartition(tasks).mapInArrow(read, RECORD)


def page_of(record_id):
    """The page_id in a record id of this writer."""
    return F.nullif(F.substring_index(record_id, ":", -1), F.lit("")).cast("bigint")


def archive_pages(pages: DataFrame, folder: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write a record per row of `pages`(page_id, url, html), read the archives, describe the records.

    (page_id, payload_bytes, payload_digest, record_type, refers_to). Null html is an empty payload,
    a null url a record without target, a null page_id a record id without number. Rows that repeat
    the largest page_id of a payload are all responses. Length and digest of a response are taken
    from the payload that was read, those of a revisit from its header. No rows: no archives. Records that
    were written and could not be read raise an error that names their archives.
    """
    spark = pages.sparkSession
    manifest = write_archives(plan_records(pages), folder or fresh_dir(spark, "warc"))
    found = cut_lineage(read_archives(spark, manifest, split_bytes).select(
        "path", page_of(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("payload_length")).alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.col("digest")).alias("payload_digest"),
        "record_type", page_of(F.col("refers_to_id")).alias("refers_to"),
    ))
    lost = missing_records(manifest, found).limit(5).collect()
    if lost:
        raise RuntimeError("archives without all their records: " + ", ".join(f"{r.path} ({r.found} of {r.records})" for r in lost))
    return found.drop("path")


def missing_records(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """(path, records, found) of the archives of which fewer or more records were read than written."""
    read = records.groupBy("path").agg(F.count("*").alias("found"))
    counted = manifest.select("path", "records").join(read, "path", "left")
    return counted.withColumn("found", F.coalesce("found", F.lit(0))).filter("found <> records")
