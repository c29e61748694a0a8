import random

import pytest

from noticeloom.operators import fold


def gram_set(title, n=3):
    title = " ".join(title.split()).lower()
    return {title[i:i + n] for i in range(max(len(title) - n + 1, 1))}


def alike(a, b, threshold=0.8):
    x, y = gram_set(a), gram_set(b)
    return len(x & y) / len(x | y) >= threshold


def brute_groups(rows):
    parent = {k: k for k, _, _ in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (k, s, t) in enumerate(rows):
        for m, u, v in rows[:i]:
            if s != u and t.strip() and v.strip() and alike(t, v):
                a, b = sorted((root(k), root(m)))
                parent[b] = a
    return {k: root(k) for k in parent}


def titles(seed, n):
    rng = random.Random(seed)
    words = ["창업", "지원", "사업", "공고", "2026", "AI", "voucher", "grant", "round", "모집"]
    base = [" ".join(rng.choices(words, k=rng.randrange(2, 7))) for _ in range(max(n // 5, 1))]
    out = []
    for i in range(n):
        t = rng.choice(base)
        if rng.random() < 0.5:
            t += rng.choice([" 1", " 2차", "!", "  ", " (수정)"])
        out.append((i, rng.choice(["a", "a", "a", "b", "c"]), t if rng.random() < 0.97 else ""))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    rows = titles(seed, 120)
    df = spark.createDataFrame(rows, "id int, source string, title string")
    got = {r["key"]: r["group"] for r in fold.fold_titles(df).collect()}
    assert got == brute_groups(rows)


def test_pairs_equal_brute_force(spark):
    rows = titles(7, 90)
    df = spark.createDataFrame(rows, "id int, source string, title string")
    got = [(r.a, r.b) for r in fold.similar_titles(df).collect()]
    assert len(got) == len(set(got))
    where = {}
    for _, s, t in rows:
        name = " ".join(t.split()).lower()
        if name:
            where.setdefault(name, set()).add(s)
    names = sorted(where)
    want = {
        (a, b) for i, a in enumerate(names) for b in names[i + 1:]
        if alike(a, b) and len(where[a] | where[b]) > 1
    }
    assert set(got) == want


def test_hot_copies_and_one_source(spark):
    """Many copies of a title, many near copies on one source, and one that links them."""
    rows = [(i, "a" if i % 2 else "b", "같은 공고 제목입니다") for i in range(600)]
    rows += [(1000 + i, "a", f"연속 공고 모집 안내문 제{i}호") for i in range(200)]
    rows += [(2000, "b", "전혀 다른 사업")]
    df = spark.createDataFrame(rows, "id int, source string, title string")
    got = {r["key"]: r["group"] for r in fold.fold_titles(df).collect()}
    assert len(got) == len(rows)
    assert {got[i] for i in range(600)} == {0}
    assert all(got[k] == k for k in range(1000, 1200)) and got[2000] == 2000


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100)]
    edges = spark.createDataFrame(chain, "a long, b long").repartition(3)
    got = {r.node: r.label for r in fold.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


def test_fold_sources(spark):
    rows = [(1, "a", "같은 공고 제목"), (2, "b", "같은 공고 제목"), (3, "b", "다른 사업 이름")]
    df = spark.createDataFrame(rows, "id int, source string, title string")
    got = fold.fold_sources(df, fold.fold_titles(df)).collect()
    assert sorted((r.group, r.source, r["items"]) for r in got) == [(1, "a", 1), (1, "b", 1), (3, "b", 1)]
