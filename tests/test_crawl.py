from noticeloom.operators.crawl import kept_rows, page_yield, stop_pages
from noticeloom.operators.dedup import dedup_last
from noticeloom.operators.diff import confirm_closed
from noticeloom.sources.pages import page_cap

PAGES = [("X", 1, 200), ("X", 2, 200), ("X", 3, 200), ("X", 4, 200), ("Y", 1, 200), ("Y", 2, 503),
         ("Z", 1, 200), ("Z", 3, 200), ("E", 1, 200), ("F", 1, 200), ("F", 2, 200)]
ROWS = [("X", 1, 0, "a"), ("X", 1, 1, "b"), ("X", 1, 2, "a"), ("X", 2, 0, "b"), ("X", 2, 1, "c"),
        ("X", 3, 0, "c"), ("X", 4, 0, "d"), ("Y", 1, 0, "a"), ("Z", 1, 0, "a"), ("Z", 3, 0, "b"),
        ("F", 1, 0, "a")]


def tables(spark):
    pages = spark.createDataFrame(PAGES, "source string, page_no int, status int")
    rows = spark.createDataFrame(ROWS, "source string, page_no int, pos int, id string")
    return pages, rows


def test_page_yield(spark):
    pages, rows = tables(spark)
    got = {(r.source, r.page_no): (r.parsed, r.new_rows, r.total) for r in page_yield(rows, pages).collect()}
    assert got == {
        ("X", 1): (3, 3, 2), ("X", 2): (2, 1, 3), ("X", 3): (1, 0, 3), ("X", 4): (1, 1, 4),
        ("Y", 1): (1, 1, 1), ("Y", 2): (0, 0, 1), ("Z", 1): (1, 1, 1), ("Z", 3): (1, 1, 2),
        ("E", 1): (0, 0, 0), ("F", 1): (1, 1, 1), ("F", 2): (0, 0, 1),
    }


def test_stop_pages_and_kept_rows(spark):
    pages, rows = tables(spark)
    stops = stop_pages(pages, page_yield(rows, pages))
    got = {r.source: (r.stop_page, r.stop_reason, r.crawl_complete) for r in stops.collect()}
    assert got == {
        "X": (3, "no_new", True), "Y": (2, "status", False), "Z": (2, "gap", False),
        "E": (1, "empty", False), "F": (2, "empty", True),
    }
    kept = dedup_last(kept_rows(rows, stops), ["source", "id"], ["page_no", "pos"])
    last = {(r.source, r.id): (r.page_no, r.first_pos.page_no) for r in kept.collect()}
    assert last == {
        ("X", "a"): (1, 1), ("X", "b"): (2, 1), ("X", "c"): (3, 2), ("Y", "a"): (1, 1),
        ("Z", "a"): (1, 1), ("F", "a"): (1, 1),
    }


def test_cap(spark):
    pages, rows = tables(spark)
    got = {r.source: (r.stop_page, r.stop_reason) for r in stop_pages(pages, page_yield(rows, pages), {"X": 1, "Y": 1, "E": 1}).collect()}
    assert got["X"] == (1, "cap") and got["Y"] == (1, "cap") and got["E"] == (1, "empty")


def test_no_status_is_no_answer(spark):
    pages = spark.createDataFrame([("N", 1, 200), ("N", 2, None)], "source string, page_no int, status int")
    rows = spark.createDataFrame([("N", 1, 0, "a")], "source string, page_no int, pos int, id string")
    stop = stop_pages(pages, page_yield(rows, pages)).first()
    assert (stop.stop_page, stop.stop_reason, stop.crawl_complete) == (2, "status", False)
    diff = spark.createDataFrame([("N", "b", "closed"), ("M", "c", "closed")], "source string, id string, status string")
    got = {r.id: r.status for r in confirm_closed(diff, stop_pages(pages, page_yield(rows, pages))).collect()}
    assert got == {"b": "closed_unconfirmed", "c": "closed"}


def test_caps_are_per_source(spark):
    pages, _ = tables(spark)
    assert page_cap(pages, {"X": 2}).filter("source = 'X'").count() == 2
    assert page_cap(pages, {"X": 2}).filter("source <> 'X'").count() == pages.filter("source <> 'X'").count()
    assert page_cap(pages, 1).count() == 5
