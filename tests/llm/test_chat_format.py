"""Formatting is undone exactly, whatever the texts hold."""

import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from noticeloom.llm import chat_format as cf

PIECES = [*cf.TEMPLATE.controls, "<", ">", "[", "]", "\\", "|", "/", "s>", "INST]", "\n", "é", "x", "<\\|im_end|>", "<|im_", "end|>"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)
SCHEMA = "conv_id long, turn long, role string, text string, part string, formatted int, loss string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=5))
def test_round_trip(turns):
    roles, texts = (pa.array([t[k] for t in turns], pa.large_string()) for k in (0, 1))
    buffer, starts, lengths = cf.assemble(
        [b"<|im_start|>", cf.escape_roles(roles), b"\n", cf.escape(texts), b"<|im_end|>\n"], len(turns))
    whole, reader = buffer.to_pybytes(), cf.Reader()
    assert list(reader.turns(whole)) == [(r.encode(), t.encode()) for r, t in turns]
    for k, (_, text) in enumerate(turns):
        assert reader.content(whole[starts[k, 3]:starts[k, 3] + lengths[k, 3]]) == text.encode()
    assert whole.count(b"<|im_end|>") == whole.count(b"<|im_start|>") == len(turns)


def test_templates_that_cannot_be_read_back():
    for controls in (("<|im_start|>", "<|im_end|>", "|>x"), ("<|im_start|>", "<|im_end|>", "a\\b"), ("</s>",)):
        with pytest.raises(ValueError):
            cf.Template(controls=controls)


def rows():
    out = [(c, k, "assistant" if k % 2 else "user", f"{c}</s>é{k}" * (c % 5)) for c in range(30) for k in range(c % 7 + 1)]
    out += [(40, None, None, None), (40, None, "assistant", None), (40, 1, "assistant", "same"), (40, 1, "assistant", "same")]
    out += [(41, 0, "user\n<|im_end|>\\n", "[INST]"), (41, 1, "assistant", ""), (None, 0, "assistant", "no id"), (None, 1, "user", "x")]
    return out + [(42, 0, "assistant", "long <s>" * 100_000), (42, 1, "user", "y" * 70_000), (42, 2, "assistant", "end")]


def digests(rows_):
    convs = defaultdict(list)
    for c, turn, role, text in rows_:
        convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    out = set()
    for c, turns in convs.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.add((c, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("size", [1, 3, 1 << 16])
def test_slices_and_indices_copy_the_same(monkeypatch, size):
    monkeypatch.setattr(cf, "SLICE_BYTES", size)
    texts = pa.array(["", "a", "éé", "", "abcdef", "xy"], pa.large_string()).slice(1)
    buffer, starts, lengths = cf.assemble([b"<", texts, b"", texts, b">"], len(texts))
    assert buffer.to_pybytes().decode() == "".join(f"<{t}{t}>" for t in texts.to_pylist())
    assert lengths[:, 1].tolist() == [1, 4, 0, 6, 2] and starts[1, 0] == 4


@pytest.mark.parametrize("chunk", [1 << 22, 50, 1])
def test_read_back(spark, chunk):
    """Parts of any size, also after the formatted parts were stored and shuffled."""
    df = spark.createDataFrame([(*r, "a", 1, "b") for r in rows()], SCHEMA).repartition(7)
    parts = cf.format_conversations(df, chunk_bytes=chunk)
    stored = [tuple(r) for r in parts.collect()]
    again = spark.createDataFrame(stored, parts.schema).repartition(5)
    for got in (cf.read_back(parts, in_order=True), cf.read_back(again)):
        got = got.collect()
        assert {tuple(r)[:5] for r in got} == digests(rows()) and len(got) == len(digests(rows()))
        chars = defaultdict(int)
        for conv_id, _, _, formatted, _ in stored:
            chars[conv_id] += len(formatted)
        assert {r.conv_id: r.formatted_chars for r in got} == chars


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.read_back(cf.format_conversations(df)).collect() == []
