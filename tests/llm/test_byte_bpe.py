"""Ids as tiktoken gives them, exact round trips, spans, and unusual rows."""

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from noticeloom.llm import byte_bpe as bb
from noticeloom.llm.queries import QUERIES, RANKS

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", "\n\n  x\t\t", "naïve café 日本語 한국어 🙂🙂", "don't we'll  they've", "<|endoftext|> 12345",
       "‍́ \x00\x7f", "ab " * 3000, "é" * 5000, "\x1c\x1d sep\x1f \x85 \xa0 x", "word.\r\n next　line", "aaaaaaaaaaaaaaaaaaaaaaaa"]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_over_whole_table(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op6_byte_bpe"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = reference.encode_ordinary(text)
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_texts_nulls_and_clashing_columns(spark, reference):
    rows = [(i, t, 7, "mine") for i, t in enumerate(ODD)] + [(None, None, 7, "mine"), (3, ODD[3], 7, "mine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    encoded = bb.encode(df, RANKS, public_tokenizers.PATTERN)
    back = bb.token_spans(bb.decode(encoded, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    got = back.collect()
    assert len(got) == len(rows)
    for row in got:
        text = row.text or ""
        assert row.ids == reference.encode_ordinary(text)
        assert bytes(row.decoded).decode() == text
        assert "".join(text[s.start:s.end] for s in row.spans[:1]) == text[:row.spans[0].end] if row.ids else text == ""
        assert all(0 <= s.start < s.end <= len(text) for s in row.spans)


def test_both_ways_in_slices(spark, reference, monkeypatch):
    """Ids and bytes of one batch leave it in several slices, each beside its own row."""
    long = [(50, "many words " * 100_000, 7, "mine")]
    rows = long + [(i, t, 7, "mine") for i, t in enumerate(ODD)] + [(None, None, 7, "mine"), *long, (3, ODD[3], 7, "mine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string").coalesce(1)
    own = bb.encode_and_decode(df, RANKS, public_tokenizers.PATTERN)
    two = bb.decode(bb.encode(df, RANKS, public_tokenizers.PATTERN).drop("text"), RANKS, public_tokenizers.PATTERN)
    assert own.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(repr, own.collect())) == sorted(map(repr, two.select("doc_id", "ids", "decoded").collect()))
    monkeypatch.setattr(bb, "PIECE_CHARS", 5)
    held = list(bb._slices(pa.array([r[1] for r in rows])))
    assert len(held) > 5 and [t for _, texts in held for t in texts] == [r[1] or "" for r in rows]
    assert [start for start, _ in held] == [sum(len(texts) for _, texts in held[:k]) for k in range(len(held))]


def test_character_split_over_tokens(spark, reference):
    text = "ᾟ"
    ids = reference.encode_ordinary(text)
    assert len(ids) > 1
    own = bb.codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    starts, ends = own.spans(text, ids)
    assert set(zip(starts.tolist(), ends.tolist())) == {(0, 1)} and own.decode(ids).decode() == text


def test_long_text_is_cut_without_trace(monkeypatch, reference):
    own = bb.codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    text = "Some words, 12 numbers   and\n\nblank lines; naïve déjà vu... " * 200
    whole = own.encode(text).tolist()
    monkeypatch.setattr(bb, "PIECE_CHARS", 37)
    assert own.encode(text).tolist() == whole == reference.encode_ordinary(text)
    monkeypatch.setattr(bb, "MEMO_PIECES", 3)
    monkeypatch.setattr(bb, "DECODE_TOKENS", 2)
    for _ in range(3):
        ids = own.encode_batch([text, "", text[:50], "new pieces here"])
        assert ids[0].tolist() == whole and own.decode(ids[0]).decode() == text
        assert ids[3].tolist() == reference.encode_ordinary("new pieces here")


def test_empty_table_and_unknown_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bb.round_trip(empty, RANKS, public_tokenizers.PATTERN).collect() == []
    own = bb.codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    with pytest.raises(ValueError):
        own.decode([99_999_999])


def test_pieces_are_forgotten_at_the_end_of_a_task(reference):
    own = bb.Codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", None])], ["doc_id", "text"])
    rows = [r for part in bb._both(iter([batch, batch]), own, ["doc_id"], "ids", "out") for r in part.to_pylist()]
    assert [r["doc_id"] for r in rows] == [1, 2, 1, 2] and rows[0]["out"] == b"some words"
    assert not own.places and not len(own.flat)
    assert own.encode("some words").tolist() == rows[2]["ids"] == reference.encode_ordinary("some words")
