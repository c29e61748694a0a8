"""Archives read back whole at any split size; revisits; false and damaged members."""

import gzip
import hashlib
import io
import os

import pytest

from noticeloom.llm import warc
from noticeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def expected(rows):
    top = {}
    for page_id, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            top[data] = max(page_id, top.get(data, page_id))
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        first = top.get(data, page_id)
        revisit = first != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    assert sorted(map(tuple, QUERIES["op3_warc"](spark, SF).collect()), key=str) == expected(rows)


@pytest.mark.parametrize("split_bytes", [257, 5000, 1 << 24])
def test_unusual_pages_at_any_split(spark, tmp_path, split_bytes):
    big = "<p>größer</p>" * 400
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (3, None, big), (7, "http://b/\r\nX: y", "small"),
            (8, "u", "small"), (9, "u", None), (10, "", ""), (None, "n", big), (11, "l", "y" * 3_000_000), (12, "m", os.urandom(900_000).hex())]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, payload string, path int").repartition(3)
    got = warc.archive_pages(df, f"file://{tmp_path}/{split_bytes}", split_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == expected([(r[0], r[2]) for r in rows])


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def members(n):
    return [warc.member(k, f"http://h/{k}", b"<b>%d</b>" % k * (k * 7 % 90), "ab" * 20, k, None, False) for k in range(n)]


def offsets(data, step):
    found = []
    for start in range(0, len(data), step):
        found += [at for at, _, _ in warc.records_in(io.BytesIO(data), len(data), start, min(start + step, len(data)))]
    return found


@pytest.mark.parametrize("step", [1, 13, 700, 10**9])
def test_each_record_has_one_owner(step):
    parts = members(40)
    wanted, at = [], 0
    for p in parts:
        wanted.append(at)
        at += len(p)
    assert offsets(b"".join(parts), step) == wanted


def test_header_longer_than_reads_at_the_start_of_a_range(spark, tmp_path):
    url = lambda k: f"http://h/{k}/" + os.urandom(500_000).hex()
    first = warc.member(1, "http://h/", b"x", "ab" * 20, 1, None, False)
    long = warc.member(2, url(2), b"y", "ab" * 20, 1, None, False)
    data = first + long + first
    found = [at for s, e in ((0, len(first)), (len(first), len(data))) for at, _, _ in warc.records_in(io.BytesIO(data), len(data), s, e)]
    assert found == [0, len(first), len(first) + len(long)]
    pages = spark.createDataFrame([(k, url(k), "z") for k in range(4)], "page_id long, url string, html string").repartition(1)
    manifest = warc.write_archives(warc.plan_records(pages), f"file://{tmp_path}/w")
    read = warc.read_archives(spark, manifest, 100_000)
    assert read.count() == sum(r.records for r in manifest.collect()) == 4


def test_gzip_magic_inside_is_no_record():
    inside = gzip.compress(b"not a record") + warc.MAGIC * 3
    parts = members(3)
    data = parts[0] + inside + parts[1] + parts[2][:len(parts[2]) // 2] + parts[2]
    for step in (17, 10**9):
        ids = [f["warc-record-id"] for s in range(0, len(data), step)
               for _, f, _ in warc.records_in(io.BytesIO(data), len(data), s, min(s + step, len(data)))]
        assert ids == [f"<{warc.ID}{k}>" for k in range(3)]


def test_archives_are_plain_gzip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 50)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.plan_records(pages), f"file://{tmp_path}/w").collect()
    text = gzip.open(manifest[0].path.removeprefix("file://")).read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response") and text.endswith(b"x\r\n\r\n") and manifest[0].records == 1


def test_damaged_archives_raise(spark, tmp_path, monkeypatch):
    """A record that cannot be read is an error that names its archive, not a missing row."""
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"{k}" * 500) for k in range(40)], "page_id long, url string, html string")
    write = warc.write_archives

    def damaged(records, folder):
        manifest = write(records, folder)
        path = manifest.first().path.removeprefix("file://")
        data = bytearray(open(path, "rb").read())
        data[len(data) // 2:len(data) // 2 + 20] = b"\0" * 20
        open(path, "wb").write(data)
        return manifest

    monkeypatch.setattr(warc, "write_archives", damaged)
    with pytest.raises(RuntimeError, match="without all their records"):
        warc.archive_pages(pages, f"file://{tmp_path}/d")
