"""Fingerprints against a plain walk over the documents; shift resistance; unusual rows."""

import hashlib
import random

import numpy as np
import pytest

from noticeloom.llm import chunk_prints as cp
from noticeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_ends(data):
    """The cutting rule, byte by byte."""
    ends, start = [], 0
    while len(data) - start > cp.LEAST:
        end = min(len(data), start + cp.MOST)
        for at in range(start + cp.LEAST - 1, end):
            h = 0
            for byte in data[max(0, at - cp.WINDOW + 1):at + 1]:
                h = ((h << 1) + int(cp.GEAR[byte])) % 2**32
            bits = cp.STRICT_BITS if at < start + cp.NORMAL else cp.LOOSE_BITS
            if h >> (32 - bits) == 0:
                end = at + 1
                break
        ends.append(end)
        start = end
    if start < len(data):
        ends.append(len(data))
    return ends


def expected(rows):
    """rows: (doc_id, text) -> a result row per document, in a loop."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        own, other, after = (cp.chunk_weights(t.encode()) for t in (text, edited, following))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), cp.fingerprint(own),
                    cp.fingerprint(other), cp.containment(own, other), cp.containment(own, after)))
    return sorted(out, key=str)


def test_cutting_rule():
    rng = random.Random(1)
    for n in (0, 1, 15, 16, 17, 64, 300, 3000):
        data = bytes(rng.choice(b"etaoin shrdlu") for _ in range(n))
        assert cp.chunk_ends(data) == plain_ends(data)
    assert cp.chunk_ends(b"a" * 1000) == plain_ends(b"a" * 1000)


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op2_chunk_prints"](spark, SF).collect()), key=str)
    assert got == expected(rows)
    near = np.array([r[5] for r in got if r[1] > 1000])
    assert near.mean() > 0.65


def test_shift_keeps_chunks():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcdefghij klmnop") for _ in range(20_000))
    own = cp.chunk_weights(text)
    assert cp.containment(own, cp.chunk_weights(b"something new, " + text)) > 0.98
    middle = text[:9000] + b"XYZ" + text[9000:]
    assert cp.containment(own, cp.chunk_weights(middle)) > 0.97
    assert cp.containment(own, cp.chunk_weights(bytes(reversed(text)))) < 0.05


@pytest.mark.parametrize("rows", [
    [(5, "one single document, its own next one " * 9)],
    [(1, None), (2, ""), (3, "x"), (4, "long " * 40_000), (9, "ends here")],
    [(None, "no id " * 50), (7, "seven " * 60), (-3, "negative " * 30), (2**62, "large")],
    [(k * 1000 + k % 7, f"text {k} " * (k % 50)) for k in range(400)],
])
def test_unusual_rows(spark, rows):
    df = spark.createDataFrame([(*r, "a", 0.5) for r in rows], "doc_id long, text string, fingerprint string, near_next double")
    assert sorted(map(tuple, cp.edited_fingerprints(df).collect()), key=str) == expected(rows)


def test_ties_and_empty_table(spark):
    schema = "doc_id long, text string"
    assert cp.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    twice = [(1, "same text of some length " * 5)] * 3 + [(2, "another " * 20)]
    got = cp.edited_fingerprints(spark.createDataFrame(twice, schema)).collect()
    assert len(got) == 4 and sorted(r.near_next for r in got if r.doc_id == 1) == [0.0, 1.0, 1.0]
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1


def test_chunks_cover_the_text(spark):
    df = spark.createDataFrame([(1, "naïve words " * 100), (2, None), (3, "é")], "doc_id long, text string")
    rows = cp.chunks(df).collect()
    for doc_id, n in ((1, len("naïve words ".encode()) * 100), (3, 2)):
        own = sorted((r.start, r.length) for r in rows if r.doc_id == doc_id)
        assert sum(length for _, length in own) == n
        assert all(a + b == c for (a, b), (c, _) in zip(own, own[1:]))
    assert not [r for r in rows if r.doc_id == 2]
