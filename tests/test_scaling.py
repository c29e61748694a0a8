"""The helpers give the same rows when one key holds most of them, small tables or not."""

import random

from pyspark.sql import functions as F

from noticeloom import session
from noticeloom.operators import scaling as sc
from noticeloom.session import cut_lineage


def test_join_dimension_both_ways(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"s{rng.randrange(6)}", str(i)) for i in range(900)]
    facts = spark.createDataFrame(rows, "source string, id string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"s{i}", i) for i in range(5)], "source string, n int")
    broadcast = sc.join_dimension(facts, dim, ["source"], ["id"])
    salted = sc.join_dimension(facts, dim, ["source"], ["id"], max_rows=2)
    assert sorted(broadcast.collect(), key=str) == sorted(salted.collect(), key=str)
    assert broadcast.count() == 900
    inner = sc.join_dimension(facts, dim, ["source"], ["id"], "inner", max_rows=2)
    assert inner.count() == broadcast.filter("n is not null").count()
    hot = salted.filter("source = 'hot'").select(F.spark_partition_id().alias("p")).distinct()
    assert "_salt" in salted._jdf.queryExecution().toString() and hot.count() >= 1


def test_running_total(spark):
    rng = random.Random(4)
    rows = [("hot", p, rng.randrange(5)) for p in range(1, 1500)] + [("b", p, 1) for p in (3, 9, 700)]
    df = spark.createDataFrame(rows, "source string, page_no int, n int")
    got = sc.running_total(df, ["source"], "page_no", "n", "total", block=64).collect()
    assert len(got) == len(rows)
    for source in ("hot", "b"):
        total = 0
        for r in sorted((r for r in got if r.source == source), key=lambda r: r.page_no):
            total += r.n
            assert r.total == total


def test_row_number_by_range(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 10 else f"k{i % 3}", rng.randrange(4), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, day int, id int").repartition(6)
    got = sc.row_number_by_range(df, ["k"], [F.col("day"), F.col("id")], "n").collect()
    assert len(got) == len(rows)
    for key in {r.k for r in got}:
        ordered = sorted((r for r in got if r.k == key), key=lambda r: (r.day, r.id))
        assert [r.n for r in ordered] == list(range(1, len(ordered) + 1))


def test_null_keys_are_kept(spark):
    rows = [(None, None, k) for k in range(20)] + [("a", None, k) for k in range(5)] + [(None, "b", 1)]
    df = spark.createDataFrame(rows, "k string, j string, n int")
    numbered = sc.row_number_by_range(df, ["k", "j"], [F.col("n")], "no").collect()
    assert sorted((r.no, r.n) for r in numbered if (r.k, r.j) == (None, None)) == [(k + 1, k) for k in range(20)]
    assert len(numbered) == len(rows)
    totals = sc.running_total(df, ["k", "j"], "n", "n", "total", block=4).collect()
    assert len(totals) == len(rows)
    assert {r.n: r.total for r in totals if (r.k, r.j) == ("a", None)} == {0: 0, 1: 1, 2: 3, 3: 6, 4: 10}


def _filled(df):
    """How many tasks of a result have rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_spread_join_meets_every_pair_once(spark):
    few = spark.createDataFrame([("hot", k, "x") for k in range(7)] + [("hot", 0, "x"), (None, 1, "x"), ("no", 1, "x")], "key string, a int, s string")
    many = spark.createDataFrame([("hot", k) for k in range(90)] + [("hot", 3), (None, 1)], "key string, b int")
    want = sorted((x.a, y.b) for x in few.collect() for y in many.collect() if x.key == y.key == "hot")
    for left, right in ((few, many), (many, few)):
        joined = sc.spread_join(left, right, ["key"])
        assert joined.columns == ["key", *left.columns[1:], *right.columns[1:]]
        assert sorted((r.a, r.b) for r in joined.collect()) == want
        assert _filled(joined) > 1


def test_spread_members_gives_every_pair_of_members(spark):
    """Repeated, null and many members; what is sorted and joined are arrays of bounded length."""
    few = cut_lineage(spark.createDataFrame(
        [("x", "s", str(k)) for k in range(300)] + [("x", None, "0"), ("x", "s", "0"), (None, "s", "n"), ("y", "s", None)],
        "call string, source string, id string"))
    many = cut_lineage(spark.createDataFrame(
        [("a", k) for k in range(2 * sc.FOLDED + 5)] + [("a", 3), ("b", None), (None, 1), ("c", 1)], "who string, p int").coalesce(1))
    pairs = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("b", "y", 3), (None, "x", 4), ("a", None, 5)], "who string, call string, n int")
    got = sc.spread_members(pairs, many, few, "who", "call")
    assert got.columns == ["who", "call", "n", "p", "source", "id"]
    left, right = many.collect(), few.collect()
    want = [(w, c, n, m.p, f.source, f.id) for w, c, n in pairs.collect() for m in left for f in right
            if w is not None and c is not None and m.who == w and f.call == c]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    folded = sc.fold_members(many, "who", "_all")
    assert folded.agg(F.max(F.size("_all"))).first()[0] == sc.FOLDED
    assert folded.agg(F.sum(F.size("_all"))).first()[0] == many.count()


def test_stage_sends_small_batches(spark):
    """A stage sends a few megabytes to Python at a time; the session's setting is as before afterwards."""
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    long = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    rows = [r.n for r in cut_lineage(long.mapInArrow(sizes, "n long")).collect()]
    assert sum(rows) == 400 and max(rows) <= 50
    assert spark.conf.get(session.BATCH_BYTES, None) is None
    spark.conf.set(session.BATCH_BYTES, "1m")
    try:
        own = [r.n for r in cut_lineage(long.mapInArrow(sizes, "n long")).collect()]
        assert max(own) <= 15 and spark.conf.get(session.BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(session.BATCH_BYTES)
