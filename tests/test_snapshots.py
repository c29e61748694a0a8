import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from noticeloom.operators import diff as d
from noticeloom.operators.dedup import dedup_last
from noticeloom.session import INITIAL_PARTITIONS
from noticeloom.sources import snapshots as sn

PREV_A = """{"pbancSn":"101","title":"T1","deadline":"2026-07-18","url":"u101"}
{"pbancSn":"102","title":"T2","deadline":"","url":"u102"}

{bad
{"source":"nipa","id":7,"title":"N7","apply_end":null,"url":"n7"}
{"source":"kocca","id":"k1","title":"K1","apply_end":"2026-07-24","url":"k1"}
{"x":1}
"""
PREV_B = """{"pbancSn":101,"title":"T1b","deadline":"2026-07-20","url":"u101"}
{"source":"nipa","id":"8","title":"N8","apply_end":"2026-07-20","url":"n8"}
"""
CURR = """{"pbancSn":"101","title":"T1","deadline":"2026-07-25","url":"u101"}
{"pbancSn":"103","title":"T3","deadline":"상시","url":"u103","more":{"a":[1,"ü"]}}
{"pbancSn":"104","title":"T4","deadline":"","url":"u104"}
{"pbancSn":"105","title":"T5","deadline":"2026-07-10","url":"u105"}
{"source":"nipa","id":"7","title":"N7","apply_end":"","url":"n7"}
{"source":"smtech","id":"S1","title":"S1","apply_end":"2026-07-31","url":"s1"}
"""
KEYS = ["source", "id"]


@pytest.fixture
def runs(spark, tmp_path):
    (tmp_path / "prev").mkdir()
    (tmp_path / "curr").mkdir()
    (tmp_path / "prev" / "a.jsonl").write_text(PREV_A, encoding="utf-8")
    (tmp_path / "prev" / "b.jsonl").write_text(PREV_B, encoding="utf-8")
    (tmp_path / "prev" / "notes.txt").write_text(PREV_B, encoding="utf-8")
    (tmp_path / "curr" / "a.jsonl").write_text(CURR, encoding="utf-8")
    return tmp_path, sn.read_snapshot(spark, str(tmp_path / "prev")), sn.read_snapshot(spark, str(tmp_path / "curr"))


def keys(df):
    return sorted((r.source, r.id) for r in df.collect())


def test_read(spark, runs):
    path, prev, curr = runs
    once = dedup_last(prev, KEYS, ["pos"])
    assert (once.count(), dedup_last(curr, KEYS, ["pos"]).count()) == (5, 6)
    row = once.filter("id = '101'").first()
    assert (row.title, row.apply_end, row.first_pos.pos.file) == ("T1b", "2026-07-20", "a.jsonl")
    order = [r.id for r in once.orderBy("first_pos").collect()]
    assert order == ["101", "102", "7", "k1", "8"]
    skipped = {r.shape: r.lines for r in sn.skipped_lines(spark, str(path / "prev")).collect()}
    assert skipped == {"blank": 1, "malformed": 1, "unknown": 1}


def test_no_files(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sn.read_snapshot(spark, str(tmp_path)).count()


def test_diff(runs):
    _, prev, curr = runs
    diff = d.snapshot_diff(prev, curr, ["pos"])
    assert [r.id for r in d.order_new(diff).collect()] == ["105", "104", "103"]
    assert keys(d.closed(diff)) == [("kstartup", "102"), ("nipa", "8")]
    changed = d.deadline_changed(diff).collect()
    assert [(r.id, r.old_end, r.new_end) for r in changed] == [("101", "2026-07-20", "2026-07-25")]
    assert keys(d.unchanged(diff)) == [("nipa", "7")]
    assert keys(d.first_time(diff)) == [("smtech", "S1")]
    assert [(r.source, r["items"]) for r in d.not_recrawled(diff).collect()] == [("kocca", 1)]
    coverage = {r.source: r.coverage for r in d.source_coverage(prev, curr).collect()}
    assert coverage == {"kstartup": "common", "nipa": "common", "smtech": "added", "kocca": "dropped"}
    once = [dedup_last(r, KEYS, ["pos"]) for r in (prev, curr)]
    joined = d.snapshot_diff_by_join(*once).collect()
    assert sorted(joined) == sorted(diff.select(*KEYS, "status").collect())
    assert tuple(d.run_totals(diff).first()) == (5, 6, 2)


def test_review_queue(spark, runs):
    path, prev, curr = runs
    diff = d.snapshot_diff(prev, curr, ["pos"])
    sn.write_review_queue(diff, str(path / "queue"))
    lines = [r.value for r in spark.read.text(str(path / "queue")).coalesce(1).collect()]
    records = [json.loads(line) for line in lines]
    assert [r.get("pbancSn", r.get("id")) for r in records] == ["103", "104", "105", "S1"]
    assert records[0] == {
        "pbancSn": "103", "title": "T3", "deadline": "상시", "url": "u103", "more": {"a": [1, "ü"]},
        "source": "kstartup", "apply_end": "상시",
    }
    assert "상시" in lines[0] and "ü" in lines[0]


def test_closed_needs_a_complete_crawl(spark, runs):
    _, prev, curr = runs
    stops = spark.createDataFrame([("nipa", False), ("kstartup", True)], "source string, crawl_complete boolean")
    got = d.confirm_closed(d.snapshot_diff(prev, curr, ["pos"]), stops)
    status = {(r.source, r.id): r.status for r in got.collect()}
    assert status[("nipa", "8")] == "closed_unconfirmed" and status[("kstartup", "102")] == "closed"


LINES = [
    ('{"pbancSn":1} x', "malformed"), ("{'pbancSn':1}", "malformed"), ('[{"pbancSn":1}]', "unknown"),
    ('"pbancSn"', "unknown"), ("7", "unknown"), ('{"source":"a"}', "unknown"), ("  ", "blank"),
    ('\u00a0{"pbancSn":1}\u3000', "board_one"), ('{"source":"a","id":null}', "unified"),
    ('{"pbancSn":1,"pbancSn":2}', "board_one"), ('{"pbancSn":1}}', "malformed"), ("{", "malformed"),
    ('{"pbancSn":1},{"pbancSn":2}', "malformed"),
]


def test_shapes(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(line for line, _ in LINES), encoding="utf-8")
    got = sn.classify(sn.read_lines(spark, str(tmp_path))).orderBy("pos").collect()
    assert [r["shape"] for r in got] == [shape for _, shape in LINES]


def test_lines_are_cut_like_text_lines(spark, tmp_path):
    text = '{"pbancSn":1,"title":"a\u2028b"}\r\n{"pbancSn":2}\x0b{"pbancSn":3}\r{"pbancSn":4}'
    (tmp_path / "a.jsonl").write_bytes(text.encode())
    lines = sn.read_lines(spark, str(tmp_path)).orderBy("pos")
    assert [r.text for r in lines.collect()] == [line.strip() for line in text.splitlines()]


def test_order_survives_splits(spark, tmp_path):
    """Files cut into many splits still give lines in order; the last line of a key wins."""
    for name in ("b", "a+ c"):
        (tmp_path / f"{name}.jsonl").write_text(
            "".join(f'{{"pbancSn":{i % 500},"title":"{name}{i}"}}\n' for i in range(3000))
        )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        records = sn.read_snapshot(spark, str(tmp_path))
        assert records.rdd.getNumPartitions() > 8
        titles = [r.title for r in records.orderBy("pos").collect()]
        last = {r.id: r.title for r in dedup_last(records, KEYS, ["pos"]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert titles == [f"{n}{i}" for n in ("a+ c", "b") for i in range(3000)]
    assert last == {str(i): f"b{2500 + i}" for i in range(500)}


def test_write_and_read(spark, tmp_path):
    rows = spark.createDataFrame(
        [("s", str(i), f"제목 {i}", None) for i in range(50)], "source string, id string, title string, apply_end string"
    ).repartition(7)
    fields = ["source", "id", "title", "apply_end"]
    sn.write_snapshot(rows.withColumn("n", F.col("id").cast("int")), str(tmp_path / "run"), ["n"], fields)
    back = sn.read_snapshot(spark, str(tmp_path / "run")).orderBy("pos").collect()
    assert [r.id for r in back] == [str(i) for i in range(50)]
    assert back[3].title == "제목 3" and back[3].apply_end is None


def random_run(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [
        (rng.choice("abc" if seed % 2 else "bcd"), str(rng.randrange(40)), rng.choice(["", None, "2026-07-01", "2026-07-02"]), i)
        for i in range(120)
    ]
    return spark.createDataFrame(rows, "source string, id string, apply_end string, pos long")


def test_diff_properties(spark):
    one, two = random_run(spark, 1), random_run(spark, 2)
    same = d.status_counts(d.snapshot_diff(one, one, ["pos"])).collect()
    assert [r.status for r in same] == ["unchanged"]
    there, back = d.snapshot_diff(one, two, ["pos"]), d.snapshot_diff(two, one, ["pos"])
    assert keys(d.new_items(there)) == keys(d.closed(back))
    union = one.select(*KEYS).union(two.select(*KEYS)).distinct().count()
    assert sum(r["items"] for r in d.status_counts(there).collect()) == union
    shuffled = d.snapshot_diff(one.repartition(5, "pos"), two.repartition(3, "id"), ["pos"])
    assert sorted(shuffled.select(*KEYS, "status", "old_end", "new_end").collect(), key=str) == sorted(
        there.select(*KEYS, "status", "old_end", "new_end").collect(), key=str
    )


def test_pairs_of_large_runs_lie_in_more_tasks_than_a_shuffle_has(spark):
    """What one task reads of the runs does not grow with a fixed number of partitions."""
    rows = spark.range(4000).select(
        F.lit("a").alias("source"), F.col("id").cast("string").alias("id"), F.lit("2026-07-01").alias("apply_end"), F.col("id").alias("pos"))
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "2k"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        diff = d.snapshot_diff(rows, rows, ["pos"])
    finally:
        for key in small:
            spark.conf.unset(key)
    assert len(diff.inputFiles()) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    assert diff.filter("status = 'unchanged'").count() == 4000
