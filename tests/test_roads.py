"""Ranked roadmaps against the listing of all ways."""

import random
from collections import defaultdict

import pytest

from noticeloom.operators import roads


def tables(spark, edges, starts, goals):
    return (
        spark.createDataFrame(edges, "from_state string, to_state string"),
        spark.createDataFrame([(s,) for s in starts], "state string"), spark.createDataFrame([(g,) for g in goals], "state string"))


def plain(edges, starts, goals, k):
    out_of = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            out_of[a].add(b)
    ways = defaultdict(list)

    def walk(start, path):
        if len(path) > 1 and path[-1] in goals:
            ways[start, path[-1]].append(path)
        for b in out_of[path[-1]] - set(path):
            walk(start, [*path, b])

    for s in set(starts) - {None}:
        walk(s, [s])
    rows = []
    for (s, g), found in ways.items():
        for rank, path in enumerate(sorted(found, key=lambda p: (len(p), p))[:k], start=1):
            rows.append((s, g, rank, path, len(path) - 1, len(found)))
    return sorted(rows)


def got(df):
    return sorted((r.start, r.goal, r["rank"], r.path, r.steps, int(r.ways)) for r in df.collect())


def test_small_graph(spark):
    """Chains, two components with cycles, a loop on one state, repeated edges, states alone, nulls."""
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("b", "d"), ("d", "e"), ("e", "d"), ("e", "f"), ("d", "f"),
             ("f", "f"), ("a", "b"), (None, "a"), ("a", None), ("g", "h")]
    starts, goals = ["a", "d", "z", None, "a"], ["f", "e", "c", "z", "h"]
    for k in (1, 3, 100):
        assert got(roads.ranked_roadmap(*tables(spark, edges, starts, goals), k=k)) == plain(edges, starts, goals, k)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"s{k}" for k in range(12)]
    edges = list({(rng.choice(names), rng.choice(names)) for _ in range(22)})
    starts, goals = names[:3], names[3:]
    assert got(roads.ranked_roadmap(*tables(spark, edges, starts, goals), k=4)) == plain(edges, starts, goals, 4)


def test_very_many_ways(spark):
    """Twelve forks: 4096 ways are counted, three are listed."""
    edges = []
    for k in range(12):
        edges += [(f"s{k:02}", f"{x}{k:02}") for x in "ab"] + [(f"{x}{k:02}", f"s{k + 1:02}") for x in "ab"]
    rows = roads.ranked_roadmap(*tables(spark, edges, ["s00"], ["s12"]), k=3).orderBy("rank").collect()
    assert [int(r.ways) for r in rows] == [2 ** 12] * 3 and [r.steps for r in rows] == [24] * 3
    assert [r.path[-2] for r in rows] == ["a11", "b11", "a11"]


def test_components(spark):
    edges = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "c"), ("x", "y"), ("y", "z"), ("z", "z")]
    found = defaultdict(set)
    for r in roads.strong_components(tables(spark, edges, [], [])[0]).collect():
        found[r.component].add(r.state)
    assert sorted(map(sorted, found.values())) == [["a", "b"], ["c", "d", "e"], ["x"], ["y"], ["z"]]
    assert all(name in states for name, states in found.items())


def test_empty(spark):
    assert roads.ranked_roadmap(*tables(spark, [], ["a"], ["b"])).collect() == []
    assert roads.ranked_roadmap(*tables(spark, [("a", "b")], [], ["b"])).collect() == []
