"""Targets, draws and the splitting tree against plain Python."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from noticeloom.llm import mixing as mx


def plain_targets(sizes):
    """Share by weight, cap, share the excess again, until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mx.WEIGHTS[k % 3] for k, s in enumerate(order)}
    rest, open_, out = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= 3 * sizes[s]]
        if not over:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            out[s] = Fraction(3 * sizes[s])
            rest -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 5000, "c": 77, "d": 3, None: 40}, {"a": 7}, {"a": 0, "b": 0},
    {"Z": 1, "a": 10**9, "é": 5, "\U0001f600": 5, "": 12}, {"a": 0, "b": 9, "c": 1},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r for r in mx.targets(df).collect()}
    for source, target in plain_targets(sizes).items():
        assert got[source].target == pytest.approx(float(target), rel=1e-12)
        assert got[source].quota <= 3 * sizes[source]


def quotas(spark, blocks):
    return spark.createDataFrame(list(blocks.items()), "source string, blocks long")


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_tree_keeps_quotas(spark, shards):
    blocks = {"a": 1000, "b": 3, "c": 0, "d": 77, None: 12_345_678}
    rows = mx.splitting_tree(quotas(spark, blocks), shards).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        assert r.blocks >= 0
        by_source[r.source] += r.blocks
        by_shard[r.shard] += r.blocks
    assert dict(by_source) == blocks and set(by_shard) == set(range(shards))
    assert max(by_shard.values()) - min(by_shard.values()) <= shards.bit_length()
    again = mx.splitting_tree(quotas(spark, blocks), shards).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_draw_is_hypergeometric(spark):
    total, marked, drawn = 40, 13, 17
    share = [math.comb(marked, x) * math.comb(total - marked, drawn - x) / math.comb(total, drawn) for x in range(14)]
    us = [k / 400 + 0.001 for k in range(400)]
    df = spark.createDataFrame([(u,) for u in us], "u double").select("u", mx._hypergeometric(
        *[F.lit(x).cast("bigint") for x in (total, marked, drawn)], F.col("u"), F.lit(0.3)).alias("x"))
    for r in df.collect():
        assert sum(share[:r.x]) <= r.u + 1e-9 and r.u <= sum(share[:r.x + 1]) + 1e-9


def test_rough_draw_has_the_right_spread(spark):
    total, marked, drawn = 10_000_000, 4_000_000, 5_000_000
    df = spark.range(3000).select(mx._hypergeometric(
        *[F.lit(x).cast("bigint") for x in (total, marked, drawn)],
        mx._uniform(F.lit("a"), F.col("id")), mx._uniform(F.lit("b"), F.col("id"))).alias("x"))
    r = df.agg(F.avg("x").alias("m"), F.stddev("x").alias("s")).first()
    sigma = math.sqrt(drawn * 0.4 * 0.6 * 0.5)
    assert abs(r.m - 2_000_000) < 5 * sigma / math.sqrt(3000) and abs(r.s / sigma - 1) < 0.1


def corpus():
    rng = random.Random(5)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 60)), "hot" if k % 3 else f"s{k % 11}") for k in range(900)]
    return rows + [(900, None, "hot"), (901, "", None), (902, " \n ", "s1"), (903, "one two", None), (903, "one two", None), (None, "x y z", "s2")]


def test_draws_meet_targets_and_shards(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, source string, draws string, target int")
    got = mx.draws(df).collect()
    assert len(got) == len(rows)
    sizes, taken, blocks = Counter(), Counter(), defaultdict(Counter)
    places = Counter()
    for r in got:
        sizes[r.source] += r.size
        words = sum(d.words for d in r.draws)
        taken[r.source] += words
        assert words <= 3 * r.size and all(0 < d.words <= r.size for d in r.draws)
        for d in r.draws:
            assert 0 <= d.shard < mx.SHARDS
            blocks[r.source][d.shard] += 1
    wanted = plain_targets(sizes)
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= Fraction(1, 2)
    for source, cells in blocks.items():
        places.update(cells)
    assert max(places.values()) - min(places.values()) <= 5
    again = mx.draws(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents_carry_the_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    expected = Counter()
    for r in mx.draws(df).collect():
        expected[r.source] += sum(d.words for d in r.draws)
    found = Counter()
    for r in mx.mixed_documents(df, ["doc_id", "text", "source"]).collect():
        found[r.source] += len(r.text.split())
    assert +found == +expected


def test_mix_lies_shard_by_shard_shuffled(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    mix = mx.mixed_documents(df, ["doc_id", "text", "source"])
    rows = [(r._shard, r._place) for part in mix.rdd.glom().collect() for r in part]
    assert rows == sorted(rows) and {s for s, _ in rows} == set(range(mx.SHARDS))
    ids = [r.doc_id for part in mix.rdd.glom().collect() for r in part]
    assert sum(a == b for a, b in zip(ids, ids[1:])) < 0.05 * len(ids)
    sources = [r.source for r in mix.collect()]
    assert sum(a != b for a, b in zip(sources, sources[1:])) > 0.2 * len(sources)


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mx.draws(spark.createDataFrame([], schema)).collect() == []
    got = mx.taken_words(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


def test_wide_draws_follow_the_distribution(spark):
    """Chi-square over bins of equal chance, at a variance of 10,000 and far beyond."""
    for total, marked, drawn in ((500_000, 100_000, 90_000), (4_000_000_000, 1_000_000_000, 2_500_000_000)):
        df = spark.range(4000).select(mx._hypergeometric(
            *[F.lit(x).cast("bigint") for x in (total, marked, drawn)],
            mx._uniform(F.lit("a"), F.col("id")), mx._uniform(F.lit("b"), F.col("id"))).alias("x"))
        mean = drawn * marked / total
        sigma = math.sqrt(mean * (total - marked) / total * (total - drawn) / (total - 1))
        assert sigma ** 2 > 10_000
        # The distribution function of such a wide draw is that of the normal one to within 1 in 1,000.
        bins = Counter(min(9, int(10 * 0.5 * (1 + math.erf((r.x + 0.5 - mean) / sigma / math.sqrt(2))))) for r in df.collect())
        assert sum((bins[k] - 400) ** 2 / 400 for k in range(10)) < 27.9


def test_runs_agree_where_ids_repeat(spark):
    rows = [(k % 7, f"w{k} " * (k % 23 + 1), "s" if k % 3 else "t") for k in range(300)]
    rows += [(None, f"v{k} " * (k % 5 + 1), "s") for k in range(100)]
    schema = "doc_id long, text string, source string"
    one = spark.createDataFrame(rows, schema).repartition(3)
    other = spark.createDataFrame(rows[::-1], schema).repartition(8)
    first, second = (sorted(map(str, mx.draws(df, keep=("text",)).collect())) for df in (one, other))
    assert first == second


def test_columns_of_any_name(spark):
    df = spark.createDataFrame(
        [(k, f"w{k}", "s", k, "t", "x", k, k) for k in range(50)],
        "doc_id long, text string, source string, size int, target string, draws string, _shard int, _key int")
    mix = mx.mixed_documents(df, df.columns)
    assert set(mix.columns) == {*df.columns, "_place"}
    for r in mix.collect():
        assert (r.size, r._key, r.target, r.draws) == (r.doc_id, r.doc_id, "t", "x") and 0 <= r._shard < mx.SHARDS
