from noticeloom.operators.diff import snapshot_diff
from noticeloom.sources.snapshots import read_snapshot
from noticeloom.streaming.items import EVENT, follow_items, item_diff
from noticeloom.streaming.resurvey import diff_path, resurvey_arrivals

from .test_snapshots import CURR, PREV_A, PREV_B


def test_arrivals_equal_batch(spark, tmp_path):
    incoming, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    first, second = tmp_path / "in" / "r1", tmp_path / "in" / "r2"
    first.mkdir(parents=True)
    (first / "a.jsonl").write_text(PREV_A, encoding="utf-8")
    (first / "b.jsonl").write_text(PREV_B, encoding="utf-8")
    resurvey_arrivals(spark, incoming, store, state).awaitTermination()
    start = spark.read.parquet(diff_path(store, "r1"))
    assert {r.status for r in start.collect()} == {"first_time"} and start.count() == 5

    second.mkdir()
    (second / "a.jsonl").write_text(CURR, encoding="utf-8")
    resurvey_arrivals(spark, incoming, store, state).awaitTermination()
    got = spark.read.parquet(diff_path(store, "r2")).select("source", "id", "status", "old_end", "new_end")
    runs = [read_snapshot(spark, str(p)) for p in (first, second)]
    want = snapshot_diff(*runs, ["pos"]).select("source", "id", "status", "old_end", "new_end")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_two_runs_in_one_batch(spark, tmp_path):
    incoming, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    for run, title in (("r1", "old"), ("r2", "new")):
        (tmp_path / "in" / run).mkdir(parents=True)
        (tmp_path / "in" / run / "a.jsonl").write_text(f'{{"source": "s", "id": "1", "title": "{title}"}}\n', encoding="utf-8")
    resurvey_arrivals(spark, incoming, store, state).awaitTermination()
    first, second = (spark.read.parquet(diff_path(store, r)).first() for r in ("r1", "r2"))
    assert (first.status, second.status) == ("first_time", "unchanged")
    assert (second.prev.title, second.curr.title) == ("old", "new")


def lines(*items):
    return "".join(f'{{"source": "{s}", "id": "{i}", "title": "t", "apply_end": "{e}"}}\n' for s, i, e in items)


# Run, file and records; every run comes in several files, some of them after later runs.
FILES = [
    ("r1", "a.jsonl", [("s", "1", "2026-07-10"), ("s", "2", "2026-07-20"), ("t", "1", "")]),
    ("r2", "a.jsonl", [("s", "1", "2026-07-12"), ("u", "1", "2026-07-13")]),
    ("r3", "a.jsonl", [("s", "1", "2026-07-12"), ("s", "3", "2026-08-30"), ("t", "1", "")]),
    ("r1", "z.jsonl", [("s", "1", "2026-07-12"), ("s", "3", "2026-08-30")]),
    ("r2", "b.jsonl", [("s", "2", "2026-07-20"), ("t", "1", "2026-09-01"), ("s", "1", "2026-07-11")]),
    ("r2", "0.jsonl", [("s", "2", "1999-01-01"), ("s", "4", "2026-07-12")]),
]


def put(folder, run, name, items):
    (folder / run).mkdir(parents=True, exist_ok=True)
    (folder / run / name).write_text(lines(*items), encoding="utf-8")


def shown(df):
    return sorted(map(tuple, df.select("source", "id", "status", "old_end", "new_end").collect()), key=str)


def test_files_of_a_run_in_any_number_of_batches(spark, tmp_path):
    """Batch by batch, with late files, both streams give the differences of the whole runs."""
    incoming, store = tmp_path / "in", str(tmp_path / "store")
    for run, name, items in FILES:
        put(incoming, run, name, items)
        resurvey_arrivals(spark, str(incoming), store, str(tmp_path / "state")).awaitTermination()
        follow_items(spark, store, str(tmp_path / "items"), "2026-07-01").awaitTermination()
    events = spark.read.schema(EVENT).parquet(f"{store}/events")
    for prev, curr in (("r1", "r2"), ("r2", "r3")):
        want = shown(snapshot_diff(*[read_snapshot(spark, str(incoming / r)) for r in (prev, curr)], ["pos"]))
        assert shown(spark.read.parquet(diff_path(store, curr))) == want
        assert shown(item_diff(events, prev, curr)) == want
    assert len({r[2] for r in shown(item_diff(events, "r1", "r2"))}) >= 4


def test_timers_announce_a_deadline_once(spark, tmp_path):
    incoming, store, items = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "items")

    def survey(day, run=None, *records):
        if run:
            put(incoming, run, f"{day}.jsonl", records)
            resurvey_arrivals(spark, str(incoming), store, str(tmp_path / "state")).awaitTermination()
        follow_items(spark, store, items, day).awaitTermination()
        rows = spark.read.schema(EVENT).parquet(f"{store}/events").filter("kind = 'imminent'").collect()
        return sorted((r.id, r.apply_end) for r in rows)

    soon, moved, past = ("s", "soon", "2026-07-12"), ("s", "moved", "2026-07-12"), ("s", "past", "2026-06-30")
    assert survey("2026-07-01", "r1", soon, moved, past, ("s", "open", "상시"), ("s", "far", "2026-09-01")) == []
    assert survey("2026-07-08", "r2", ("s", "moved", "2026-07-20"), ("s", "new", "2026-07-09")) == [("new", "2026-07-09")]
    first = [("new", "2026-07-09"), ("soon", "2026-07-12")]
    assert survey("2026-07-10", "r3", soon, ("s", "x", "")) == first
    assert survey("2026-07-11", "r4", soon, ("s", "y", "")) == first
    assert survey("2026-07-18", "r5", ("s", "z", "")) == [("moved", "2026-07-20"), *first]
