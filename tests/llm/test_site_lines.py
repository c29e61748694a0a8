"""Boilerplate lines against a plain count."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from noticeloom.llm import site_lines as sl


def plain(rows, percent=sl.RATIO_PERCENT, least=sl.LEAST_PAGES):
    pages, on = Counter(h for _, h, _ in rows), Counter()
    for _, host, text in rows:
        on.update({(host, line.strip(sl.TRIM)) for line in (text or "").split("\n")})
    out = []
    for doc_id, host, text in rows:
        if text is None:
            out.append((doc_id, None))
            continue
        kept = [x for x in text.split("\n") if not (
            (k := x.strip(sl.TRIM)) and on[host, k] >= least and on[host, k] * 100 > pages[host] * percent)]
        out.append((doc_id, "\n".join(kept)))
    return sorted(out, key=str)


def rows():
    out = []
    for k in range(400):
        host = "hot" if k % 2 else f"h{k % 20}"
        lines = [f"own line {k}", "Imprint of hot" if k % 2 else "Menu", "  Menu \t", "", "rare" if k % 100 == 1 else "x" * (k % 7), "end"]
        out.append((k, host, "\n".join(lines[k % 2:])))
    return out + [(500, None, "Menu\nMenu\n\n"), (501, None, None), (502, "one", "Menu"), (503, "one", ""), (504, "hot", "Menu"), (504, "hot", "Menu")]


@pytest.mark.parametrize("max_rows", [100_000, 2])
def test_against_plain_count(spark, monkeypatch, max_rows):
    join = sl.join_dimension
    monkeypatch.setattr(sl, "join_dimension", lambda *a: join(*a, max_rows=max_rows))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows()], "doc_id long, source string, text string, _lines int, _site string")
    df = df.withColumnRenamed("source", "site").withColumn("_kept", F.lit("k")).withColumn("_pages", F.lit(3))
    got = sl.drop_site_lines(df, "site")
    assert got.columns == df.columns
    assert {(r._lines, r._site, r._kept, r._pages) for r in got.collect()} == {(1, "x", "k", 3)}
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == plain(rows())


def test_counts_and_clashing_columns(spark):
    df = spark.createDataFrame([(*r, 9, "y") for r in rows()], "doc_id long, source string, text string, n_lines int, other string")
    got = sl.drop_site_lines(df, counts=("n_lines", "n_dropped")).collect()
    texts = {r[0]: r[2] for r in rows()}
    for r in got:
        assert r.other == "y"
        assert (r.n_lines, r.n_dropped) == ((0, 0) if texts[r.doc_id] is None else (
            texts[r.doc_id].count("\n") + 1, texts[r.doc_id].count("\n") + 1 - (len(r.text.split("\n")) if r.text or r.n_dropped < r.n_lines else 0)))


def test_empty_table(spark):
    assert sl.drop_site_lines(spark.createDataFrame([], "doc_id long, source string, text string")).collect() == []


def test_long_text(spark):
    text = "\n".join(f"line {k}" for k in range(50_000))
    df = spark.createDataFrame([(1, "a", text)], "doc_id long, source string, text string")
    assert sl.drop_site_lines(df).first().text == text
