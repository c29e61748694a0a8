"""Held-out accuracy, evidence, rejection and unusual rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeloom.llm import language as lg
from noticeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    rows = docs.filter("doc_id % 2 = 0").select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_declared"), F.col("text").alias("_text"))
    return lg.fit(rows)


def test_held_out_accuracy(docs, model):
    rest = docs.filter("doc_id % 2 = 1")
    got = lg.identify(rest, declared=None, host=None, model=model).join(rest, "doc_id").select("language", "lang", "kept", "n_chars").collect()
    assert sum(r.language == r.lang for r in got) / len(got) > 0.98
    assert sum(r.language == r.lang for r in got if r.n_chars > 100) == sum(r.n_chars > 100 for r in got)


def test_query_keeps_prose(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op10_language"](spark, SF).collect()}
    assert len(got) == docs.count() and sum(r.kept for r in got.values()) / len(got) > 0.99
    pages = QUERIES["page_languages"](spark, SF).collect()
    assert len(pages) == spark.read.parquet(f"{SF}/pages.parquet").count() and sum(r.kept for r in pages) / len(pages) > 0.95


def test_scores_by_hand(model):
    text = "The  thing\nIS"
    data = np.frombuffer(b"the thing is", np.uint8)
    padded = [0, 0, *data.tolist()]
    total = np.zeros(len(model.languages) + 1)
    for k in range(len(data)):
        code = padded[k] << 16 | padded[k + 1] << 8 | padded[k + 2]
        total += model.trigrams[(code * 0x9E3779B1) % 2**32 >> 17]
    assert model.scores(text) == pytest.approx(total / lg.OVERLAP, rel=1e-5)


def test_long_text_in_slices(model, monkeypatch):
    text = "some words of a longer text " * 300
    whole = model.scores(text)
    monkeypatch.setattr(lg, "SLICE_BYTES", 100)
    assert model.scores(text) == pytest.approx(whole, rel=1e-6)


def test_evidence_decides_short_texts(spark, docs, model):
    host = [(10_000 + k, r.text, "de", "german.de", "de") for k, r in enumerate(docs.filter("lang = 'de'").limit(60).collect())]
    other = [(20_000 + k, r.text, "fr", "french.fr", "fr") for k, r in enumerate(docs.filter("lang = 'fr'").limit(60).collect())]
    short = [(1, "en en", None, "german.de", "de"), (2, "en en", None, "french.fr", "fr"), (3, "en en", "de", None, None), (4, "en en", "fr", None, None)]
    df = spark.createDataFrame(host + other + short, "doc_id long, text string, lang string, source string, suffix string")
    got = {r.doc_id: r for r in lg.identify(df, suffix="suffix", model=model).collect()}
    scores = {i: got[i] for i in (1, 2, 3, 4)}
    assert scores[1].language == scores[3].language == "de" and scores[2].language == scores[4].language == "fr"


def test_rejects_what_is_no_language(spark, docs, model):
    rng = random.Random(3)
    junk = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(300))
    noise = "".join(rng.choice("qxzjkvwpyfb0123456789{}~^") for _ in range(400))
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, junk, "en"), (5, noise, "en"), (5, noise, "en"), (None, docs.first().text, None)]
    df = spark.createDataFrame([(*r, None, "x", 2.0) for r in rows], "doc_id long, text string, lang string, source string, kept string, posterior double")
    got = lg.identify(df, model=model).collect()
    assert len(got) == len(rows)
    assert all(not r.kept and r.language is None for r in got if r.doc_id is not None)
    assert [r.kept for r in got if r.doc_id is None] == [True]


RUSSIAN = "Сегодня утром мы долго шли вдоль реки и говорили о том, как быстро проходит лето в этих краях, и никто из нас не хотел возвращаться."
JAPANESE = "これはとてもみじかいぶんしょうですがいみはありますきょうはてんきがいいのでそとをあるきましょう" * 4
CHINESE = "今天早上我们沿着河边走了很久谈论这里的夏天过得多么快没有人愿意回去因为风景实在太美了" * 4


@pytest.mark.parametrize("size", [20, 40, 80, 149, 150])
def test_short_texts_are_judged_by_their_words(spark, docs, model, size):
    rng = random.Random(size)
    noise = "".join(rng.choice("qxzjkvwpyfb0123456789{}~^") for _ in range(size))
    digest = "".join(rng.choice("0123456789abcdef") for _ in range(size))
    foreign = [RUSSIAN[:size], JAPANESE[:size], CHINESE[:size], noise, digest, "0123 4567 " * (size // 10), "x.y@example.com " * (size // 16 + 1)]
    source = [r.text for r in docs.filter("lang = 'en' AND n_chars > 400 AND NOT text RLIKE '[#*$%&|<>0-9]'").orderBy("doc_id").limit(20).collect()]
    prose = [t[:size] for t in source]
    marked = [f'+1 (545) 555-9193 token = "b64b244acde2e3b0aa8f051af1ec018ebaba3add" {t[:size]} 7844238401328224 http://a.b/c?d=1' for t in source]
    rows = [(k, t, "en", "s") for k, t in enumerate(foreign)] + [(100 + k, t, "en", "s") for k, t in enumerate(prose + marked)]
    got = lg.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), model=model).collect()
    assert [r.doc_id for r in got if r.doc_id < 100 and r.kept] == []
    assert [r.doc_id for r in got if r.doc_id >= 100 and r.language != "en"] == []


def test_only_what_says_nothing_is_left_out():
    left = lambda t: lg._bytes_of(t).tobytes().decode()
    assert left("See  https://a.b/c?d=1 and www.a.b, or mail x.y@mail6.example.com now") == "see and or mail now"
    assert left("id 550e8400-e29b-41d4-a716-446655440000 0xFF b64b244acde2e3b0 end") == "id end"
    assert left("+1 (545) 555-9193 on 10.12.2020 at 19.37.233.111.") == "on at ."
    assert left("deadbeef facade effaced été 日本123語") == "deadbeef facade effaced été 日本 語"
    assert left("12 34") == "" and left(None) == ""


def test_every_declared_language_is_fitted(spark, docs):
    """Twenty languages of many documents and one of two; no language takes what is foreign to all."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [r.text[:2000] for r in docs.filter("lang = 'en' AND n_chars > 600").orderBy("doc_id").limit(40).collect()]
    rows = []
    for k in range(20):
        shuffled = random.Random(k).sample(letters, 26)
        code = str.maketrans(letters, "".join(shuffled))
        # The first languages are the most frequent ones.
        rows += [(f"l{k:02}", t.lower().translate(code)) for t in texts[:40 - k]]
    rare = texts[0].lower().translate(str.maketrans(letters, letters[13:] + letters[:13]))
    rows += [("rare", rare[:1000]), ("rare", rare[1000:])]
    foreign = [(None, t) for t in (RUSSIAN, JAPANESE, CHINESE)]
    df = spark.createDataFrame([(k, *r, "s") for k, r in enumerate(rows + foreign)], "doc_id long, lang string, text string, source string")
    got = {r.doc_id: r.language for r in lg.identify(df).collect()}
    assert [got[k] for k in range(len(rows))] == [lang for lang, _ in rows]
    assert [got[len(rows) + k] for k in range(len(foreign))] == [None] * len(foreign)


def test_rows_without_ids(spark, docs):
    """Null ids are fitted on and judged like others; what repeats an id and a text counts once."""
    rows = docs.filter("length(text) > 200").limit(200)
    with_ids = {r.text: r.kept for r in lg.identify(rows, keep=("text",)).collect()}
    bare = lg.identify(rows.withColumn("doc_id", F.lit(None).cast("bigint")), keep=("text",)).collect()
    assert len(bare) == 200 and sum(with_ids[r.text] == r.kept for r in bare) >= 198
    hot = rows.limit(1).select(F.explode(F.sequence(F.lit(1), F.lit(3000))), "*").drop("col")
    assert len(lg.identify(rows.unionByName(hot)).collect()) == 3200


def test_empty_table_and_nothing_to_fit_on(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert lg.identify(spark.createDataFrame([], schema)).collect() == []
    got = lg.identify(spark.createDataFrame([(1, "some text", None, "a")], schema)).collect()
    assert [(r.language, r.kept) for r in got] == [(None, False)]


def test_page_evidence(spark):
    html = '<!DOCTYPE html><HTML class=x LANG="de-AT"><script>var en="the";</script><!-- c --><p>Ein <b>Satz</b></p>'
    row = lg.page_evidence(spark.createDataFrame([(1, "https://A.b.Example.AT:80/x", html), (2, None, None)], "page_id long, url string, html string")).orderBy("page_id").collect()
    assert (row[0].lang, row[0].host, row[0].suffix) == ("de", "a.b.example.at", "at") and row[0].text.split() == ["Ein", "Satz"]
    assert (row[1].lang, row[1].host, row[1].suffix, row[1].text) == (None, None, None, "")
