"""Features and divergences against plain Python; junk goes, prose stays."""

import math
import random
import re
from collections import Counter

import pytest

from noticeloom.llm import divergence as dv
from noticeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
GAP = re.compile(r"[\x20\x09-\x0D]+")


def plain_features(text):
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {p for k, w in enumerate(windows) if seen[w] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if GAP.sub("", x)]
    return (len(words), sum(map(len, words)), len(re.findall(dv.SYMBOLS, text)), len(lines) - len(set(lines)), len(repeated))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_query_over_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_divergence"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        wanted = plain_features(texts[r.doc_id])
        assert tuple(r[c] for c in COLUMNS) == wanted
        assert r.base_failed == (wanted[0] < 50 or 100 * wanted[4] > 50 * wanted[0])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("few", [64, 0])
def test_odd_texts(spark, monkeypatch, few):
    monkeypatch.setattr(dv, "FEW_WINDOWS", few)
    texts = [None, "", " ", "a", "a b", "a b c", "a a a a", "a b c a b c", "x y\nx y\n x y\n\n\n", "\t\x0b\x0c\r\n", "|#* $%&<>",
             "é ü\u00a0ö 日本", "a b c d a b c e a b", "p q r s " * 4000, "one two three " * 2 + "four " + "two three four"]
    rng = random.Random(3)
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (5, 9, 30, 200)]
    df = spark.createDataFrame([(k, t, "en", 5) for k, t in enumerate(texts)], "doc_id long, text string, lang string, n_words int")
    for r in dv.features(df).collect():
        assert tuple(r[c] for c in COLUMNS) == plain_features(texts[r.doc_id]), texts[r.doc_id]


def divergence(p, q):
    out = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        out += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return out


def test_divergences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    measured = dv.features(docs)
    known = dv.references(measured)
    assert sorted(known) == ["de", "en", "es", "fr"]
    rows = {r.doc_id: r for r in dv.judge(docs).collect()}
    for r in measured.collect():
        if not r.n_words:
            continue
        chars = list(r.chars)
        by_char = min(divergence([c / sum(chars) for c in chars], shares) for shares, _ in known.values())
        by_word = []
        for _, shares in known.values():
            own = {c.word: c.n / r.n_words for c in r.common if c.word in shares}
            words = sorted(shares)
            p, q = [own.get(w, 0) for w in words], [shares[w] for w in words]
            by_word.append(divergence([*p, max(0, 1 - sum(p))], [*q, 1 - sum(q)]))
        assert rows[r.doc_id].char_divergence == pytest.approx(by_char, abs=1e-9)
        assert rows[r.doc_id].word_divergence == pytest.approx(min(by_word), abs=1e-9)


def test_keeps_prose_and_drops_junk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'")
    prose = [r.text for r in docs.collect() if len(r.text) > 800 and not re.search(r"[#*$%&|<>]|\d{6}", r.text)][:20]
    noisy = ["".join(c + ("%%" if c == " " else "") for c in t.upper()) for t in prose]
    rows = [(k, t, "en") for k, t in enumerate(prose)] + [(1000 + k, t, "en") for k, t in enumerate(noisy)]
    rows += [(2000, noisy[0], "xx"), (2001, prose[0], None), (2002, prose[0], None)]
    verdicts = {r.doc_id: (r.base_failed, r.kept) for r in dv.judge(docs.select("doc_id", "text", "lang").filter("doc_id < 0").unionByName(
        spark.createDataFrame(rows * 1, "doc_id long, text string, lang string")).unionByName(docs.selectExpr("doc_id + 10000 doc_id", "text", "lang"))).collect()}
    assert all(verdicts[k][1] or verdicts[k][0] for k in range(len(prose)))
    assert not any(verdicts[1000 + k][1] for k in range(len(noisy)))
    assert verdicts[2000][1] or verdicts[2000][0]
    assert verdicts[2001] == verdicts[2002] == verdicts[0]


def test_empty_table_and_no_reference(spark):
    schema = "doc_id long, text string, lang string"
    assert dv.judge(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(f"w{k}" for k in range(300))
    assert dv.judge(spark.createDataFrame([(1, text, None)], schema)).first().kept
