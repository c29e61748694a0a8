"""The trie against prefixes counted one by one."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from noticeloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, pos string, d string, x int, total string"


def code(role, text):
    inner = [hashlib.sha256((s or "").encode()).hexdigest() for s in (role, text)]
    return hashlib.sha256("".join(inner).encode()).hexdigest()


def conversations(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            out[conv_id].append(((turn is not None, turn or 0), code(role, text), role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in out.items()}


def plain(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = own + sum(saved[k] for k in children[node])
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items())


def rows():
    """Shared beginnings of all lengths, exact copies, a hot first turn, prefixes of each other, ties."""
    rng, out = random.Random(3), []
    for c in range(120):
        kind = c % 4
        if kind == 0:
            texts = ["hot"] + [rng.choice("abé") for _ in range(rng.randrange(9))]
        elif kind == 1:
            texts = ["hot", "copy", "copy"]
        elif kind == 2:
            texts = [f"step {k}" for k in range(c % 23)] or ["one"]
        else:
            texts = [rng.choice(["x", "y", "", None]) for _ in range(rng.randrange(1, 7))]
        out += [(c, k, "user" if k % 2 else None, t) for k, t in enumerate(texts)]
    out += [(200, None, "user", "b"), (200, None, "user", "a"), (200, 0, "user", "a"), (200, 0, "user", "a")]
    return out + [(None, 0, "user", "nobody"), (-3, 5, "system", "negative")]


def table(spark):
    return spark.createDataFrame([(*r, "p", "q", 7, "t") for r in rows()], SCHEMA)


def trie(turns):
    return Counter(tuple(r) for r in pt.prefix_trie(turns, turns.select("conv_id").distinct()).collect())


def test_against_all_prefixes(spark):
    got = trie(pt.coded_turns(table(spark)))
    assert got == plain(conversations(rows()))
    assert max(got.values()) == 1


def test_small_blocks(spark, monkeypatch):
    """Running values over several blocks, edges expanded block by block."""
    monkeypatch.setattr(pt, "BLOCK", 3)
    assert trie(pt.coded_turns(table(spark))) == plain(conversations(rows()))


def test_long_conversation_and_its_prefixes(spark):
    """Every conversation is a prefix of the longest one."""
    lengths = [5000, 4097, 4096, 1024, 1023, 2, 1]
    turns = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "conv_id long, n int").select(
        "conv_id", F.explode(F.sequence(F.lit(1), "n")).alias("turn")).select(
        "conv_id", "turn", F.lit("user").alias("role"), F.col("turn").cast("string").alias("text"))
    got = trie(pt.coded_turns(turns))
    assert got == plain({k: [("user", str(t)) for t in range(1, n + 1)] for k, n in enumerate(lengths)})


def test_search_does_not_grow_with_depth(spark):
    """Exit nodes take the same few joins however long a conversation is, and agree with the edges."""
    turns = pt.coded_turns(table(spark))
    digests = pt.cut_lineage(pt.prefixes(turns))
    lengths = digests.groupBy(F.col("conv_id").alias("conv")).agg(F.max("d").alias("len"))
    last = digests.join(lengths, (F.col("conv") == F.col("conv_id")) & (F.col("len") == F.col("d")))
    classes = pt.cut_lineage(last.groupBy("len", "x", "y").agg(F.min("conv").alias("conv")).select("conv", "len"))
    nodes = pt.build(classes, digests)
    located = pt._locate(lengths.withColumn("l", F.lit(0).cast("bigint")), nodes, digests)
    assert located._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 13
    # All conversations lie in the finished trie, to their ends.
    got = located.collect()
    assert len(got) == lengths.count() and all(r.k == r.len and r.s < r.k <= r.e for r in got)


def test_rebuilt(spark):
    def own(convs, c):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        return convs.get(base, [])[:h] + convs[c][h:]

    convs = conversations([r for r in rows() if r[0] not in (5, 40)])
    df = table(spark).filter("conv_id is null or conv_id not in (5, 40)")
    turns, every = pt.rebuilt(pt.cut_lineage(pt.coded_turns(df)))
    got = Counter(tuple(r) for r in pt.prefix_trie(turns, every).collect())
    assert got == plain({c: own(convs, c) for c in convs})
    assert any(not own(convs, c) for c in convs)


def test_empty_table(spark):
    turns = pt.coded_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert trie(turns) == Counter()


@pytest.mark.parametrize("low, high, fattest", [(0, 8, 8), (0, 7, 4), (4, 7, 6), (6, 7, 7), (8, 9, 9), (5, 12, 8)])
def test_two_fattest(spark, low, high, fattest):
    df = spark.createDataFrame([(low, high)], "l long, r long")
    assert df.select(pt.two_fattest("l", "r")).first()[0] == fattest
