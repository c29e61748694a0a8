import datetime
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from noticeloom.functions import dates, markup as mk, text as tx
from noticeloom.sources import pages as pg

NBSP = "\u00a0"
TITLE_KEY = "title"


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


DATES = [
    ("2026-07-10", "2026-07-10"), ("2026.7.9", "2026-07-09"), ("2026. 7. 10.", "2026-07-10"),
    ("2026/07/10 16:00", "2026-07-10"), ("26.07.10", "2026-07-10"), ("26.7.9", "2026-07-09"),
    ("&nbsp;2026-07-10&nbsp;", "2026-07-10"), ("12026-07-10", "2026-07-10"), ("26. 7. 10", "26. 7. 10"),
    ("07.20", "07.20"), ("20260718", "20260718"), ("2026-13-45", "2026-13-45"),
    ("2026년 7월 10일", "2026년 7월 10일"), ("상시", "상시"), ("", ""), (None, ""),
    ("2026-07-10 2026-07-17", "2026-07-10"),
]


def test_norm_date(spark):
    assert apply(spark, [d[0] for d in DATES], dates.norm_date) == [d[1] for d in DATES]


PERIODS = [
    ("2026-07-07 ~ 2026-07-17", "2026-07-07", "2026-07-17"), ("26.07.10 ∼ 26.07.20", "2026-07-10", "2026-07-20"),
    ("2026-07-07~", "2026-07-07", ""), ("~2026-07-17", "", "2026-07-17"), ("2026-07-17", "", "2026-07-17"),
    ("2026-07-07 ~ 2026-07-17 ~ 2026-07-20", "", "2026-07-07"),
    ("2026.07.10 ~ 07.20", "2026-07-10", "07.20"), ("상시", "", "상시"),
    ("예산 소진시까지", "", "예산 소진시까지"), (None, "", ""),
]


def test_split_period(spark):
    got = apply(spark, [p[0] for p in PERIODS], dates.split_period)
    assert [tuple(g) for g in got] == [p[1:] for p in PERIODS]


def test_typed_dates(spark):
    ends = ["2026-07-18", "2026-13-45", "상시", "", None, "2026-07-11", "2026-07-10"]
    as_of = datetime.date(2026, 7, 11)
    assert apply(spark, ends, lambda c: dates.d_day(c, as_of)) == [7, None, None, None, None, 0, -1]
    assert apply(spark, ends, lambda c: dates.is_open(c, as_of)) == [True] * 6 + [False]
    assert apply(spark, ends, lambda c: dates.imminent(c, as_of)) == [False] * 5 + [True, False]
    assert apply(spark, ends[:1], lambda c: dates.imminent(c, as_of, 7)) == [True]


def test_clean_orders(spark):
    assert apply(spark, ["&nbsp;A&amp;B&#8232;&lt", None], tx.clean) == ["A&B <", ""]
    assert apply(spark, ["  Grant&nbsp;one ", None], tx.clean_late) == [f"Grant{NBSP}one", ""]
    assert apply(spark, [f"a\u001c{NBSP}b\u3000 c"], tx.collapse) == ["a b c"]
    assert apply(spark, ["&copy=1&copyx"], tx.unescape) == ["©=1©x"]


def test_urls(spark):
    assert apply(spark, ["https://x/공고/가나-다?x=1", "no scheme"], tx.slug) == ["x_공고_가나_다_x_1", None]
    assert len(apply(spark, ["http://" + "가" * 200], tx.slug)[0]) == 80
    assert apply(spark, ["/d.do;jsessionid=A1?k=1"], tx.drop_session) == ["/d.do?k=1"]
    assert apply(spark, ["https://m.x.kr/a?b", "x.kr/a"], tx.url_host) == ["m.x.kr", "x.kr/a"]
    hosts = ["http://evilnipa.kr/a", "https://www.nipa.kr/b", "http://nipa.kr", "https://nipa.kr.evil.com/"]
    df = spark.createDataFrame([(h,) for h in hosts], "url string")
    assert sorted(r.url for r in pg.allowed_host(df).collect()) == sorted([hosts[1], hosts[2]])
    assert apply(spark, ["178481", "17a", "", None, "１２"], pg.valid_id) == [True, False, False, False, False]


# Pages and the texts they must give.
PAGE_TEXTS = [
    ("<p>a</p>\n\n<p>b &amp; c</p><script>x<y\n</script><style>p{}</style>d", "\na\nb & c\nd"),
    (f"<br>\n{NBSP}\n\u3000\n<b>e</b>\n \n", "\ne\n"),
    ("<SCRIPT>kept</SCRIPT>", "\nkept\n"),
    ("", ""),
    ("a\n\x1f\nb\n\n\n", "a\nb\n"),
]


def test_strip_html(spark):
    assert apply(spark, [p for p, _ in PAGE_TEXTS], tx.strip_html) == [t for _, t in PAGE_TEXTS]


# Values, and what cleaning makes of them before and after references are read.
CLEANED = [
    ("a &amp; b", "a & b", "a & b"), ("\n a\t&lt;b&gt; ", "a <b>", "a <b>"),
    (f"x{NBSP}\u3000y", "x y", "x y"), ("&#x41;&#x20;&#x20;B", "A B", "A  B"),
    ("a\x1cb\x85c", "a b c", "a b c"), (" &nbsp;가&nbsp; ", "가", f"{NBSP}가{NBSP}"), ("&ampamp;", "&amp;", "&amp;"),
]


def test_clean_values(spark):
    values = [v for v, _, _ in CLEANED]
    assert apply(spark, values, tx.clean) == [c for _, c, _ in CLEANED]
    assert apply(spark, values, lambda c: tx.clean_each(F.array(c))[0]) == [c for _, c, _ in CLEANED]
    assert apply(spark, values, tx.clean_late) == [late for _, _, late in CLEANED]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="a <>\n\t\u00a0\u3000\x1c\x85가", max_size=30), min_size=20, max_size=40))
def test_clean_is_settled(spark, values):
    once = apply(spark, values, tx.clean)
    assert apply(spark, once, tx.clean) == once
    assert all(t == t.strip() and "  " not in t for t in once)


def test_long_row(spark):
    page = "<script>" + "x" * 400_000 + "</script><tr><td>" + "y " * 200_000 + "</td></tr>"
    assert len(apply(spark, [page], tx.strip_html)[0]) < 400_010
    assert apply(spark, [page], lambda c: F.size(mk.match_blocks(c, "<tr>(?s:.*?)</tr>"))) == [1]


def test_markup(spark):
    assert apply(spark, ["a<X>b<X>c", "none"], lambda c: mk.cut_region(c, "<X>")) == ["b<X>c", None]
    assert apply(spark, ["a|b|c", "a"], lambda c: mk.split_blocks(c, r"\|")) == [["b", "c"], []]
    assert apply(spark, ["k=1 k=2", "-"], lambda c: mk.last_match(c, r"k=(\d)")) == ["2", ""]
    arr = lambda c: F.split(c, ",")
    assert apply(spark, ["p1,p2p,x", "x"], lambda c: mk.pick_prefix(arr(c), "p")) == ["1", ""]
    assert apply(spark, ["a,b"], lambda c: mk.cell(arr(c), 1)) == ["b"]
    assert apply(spark, ["a,b"], lambda c: mk.cell(arr(c), 1, 3)) == [""]
    assert apply(spark, ["<td>a&amp;<b>b</b></td><td class='x'>\n c</td>"], mk.cells) == [["a& b", "c"]]
    assert apply(spark, [",x, ,y"], lambda c: tx.join_nonempty(arr(c))) == ["x /   / y"]
    assert apply(spark, ["", None, "z"], lambda c: tx.or_default(c, "?")) == ["?", "?", "z"]


@pytest.mark.parametrize("status", [200, 404])
def test_detail_texts(spark, status):
    df = spark.createDataFrame([("nipa", "u", status, "<p>a</p>")], "source string, url string, status int, html string")
    kept = [r.text for r in pg.detail_texts(df).collect()]
    lost = [r.reason for r in pg.rejected_pages(df).collect()]
    assert (kept, lost) == ((["u\n\n\na\n"], []) if status == 200 else ([], ["HTTP 404"]))


def test_header_per_row(spark):
    rows = [("kstartup", "u1", 200, "x"), ("nipa", None, 200, "y"), (None, "u3", 200, "z")]
    df = spark.createDataFrame(rows, "source string, url string, status int, html string")
    assert sorted(r.text for r in pg.detail_texts(df).collect()) == sorted(["x", "\n\ny", "u3\n\nz"])


def test_references_are_decoded_in_parts(monkeypatch):
    """Nulls, empty batches and the order are kept at the edges of parts."""
    decode = tx.html.unescape
    monkeypatch.setattr(tx, "DECODED_AT_ONCE", 3)

    for n in (0, 1, 3, 7, 10):
        texts = [None if k % 4 == 1 else f"&lt;{k}&gt;" for k in range(n)]
        want = [None if t is None else decode(t) for t in texts]
        assert tx._decode.func(pa.array(texts, pa.string())).to_pylist() == want
        lists = [None if k % 3 == 2 else texts[:k] for k in range(n)]
        got = tx._decode_each.func(pa.array(lists, pa.list_(pa.string()))).to_pylist()
        assert got == [None if ts is None else want[:len(ts)] for ts in lists]


def test_decoding_holds_few_objects():
    batch = pa.array(["&amp; " + "x" * 5000] * 4000, pa.string())
    tracemalloc.start()
    tx._decode.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000 < batch.nbytes
