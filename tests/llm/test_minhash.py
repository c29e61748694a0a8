"""Components against all pairs; frequent groups, chains and unusual rows."""

import random

import numpy as np
import pytest

from noticeloom.llm import minhash as mh


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def plain(rows):
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and both:
                label[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return sorted(((i, len(s), least.get(root(k)) if s else i, i == (least.get(root(k)) if s else i)) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def check(spark, rows, repartition=3):
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id long, text string, kept string, node int").repartition(repartition)
    got = sorted(map(tuple, mh.near_duplicates(df).collect()), key=str)
    assert got == plain(rows)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{k}" for k in range(800)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    for group in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(6, 300))]
        if group % 3 == 0:
            base += shared
        rows += [edited(rng, base, rng.randrange(0, 1 + len(base) // 25)) for _ in range(rng.randrange(1, 9))]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(50)) for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("seed,turns", [(1, 3), (2, 1), (3, 2)])
def test_random_corpus(spark, monkeypatch, seed, turns):
    monkeypatch.setattr(mh, "CENTRE_TURNS", turns)
    check(spark, corpus(seed))


def test_unusual_rows(spark):
    rng = random.Random(9)
    long = [f"t{rng.randrange(5000)}" for _ in range(30_000)]
    check(spark, [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "É é a b c"), (8, "é é a b c"),
        (9, " ".join(long)), (10, " ".join(long[:-50])), (11, " ".join(long[:12_000])), (None, "one two"), (12, "a b c d e"), (13, "A  B\x0bC\x0cD\rE"),
        (14, "x\x1cy"), (15, "x y"), (4, "One two"), (16, "a b c d e"),
    ])


def test_large_group_and_chain(spark, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK_NODES", 16)
    rng = random.Random(4)
    base = [f"b{k}" for k in range(200)]
    rows = [(k, edited(rng, base, 2)) for k in range(150)]
    chain = [f"c{k}" for k in range(400)]
    rows += [(1000 + k, " ".join(chain[6 * k:6 * k + 100])) for k in range(45)]
    check(spark, rows)


def test_copies_too_far_from_their_base(spark, monkeypatch):
    """Most are linked with the base, some only with each other, some are shorter, some alone."""
    monkeypatch.setattr(mh, "CENTRE_TURNS", 1)
    rng = random.Random(6)
    base = [f"b{k}" for k in range(150)]
    rows = [edited(rng, base, rng.randrange(1, 7)) for _ in range(120)]
    for _ in range(6):
        far = edited(rng, base, 6).split()
        rows += [edited(rng, far, 1) for _ in range(4)]
    rows += [" ".join(base[:n]) for n in range(80, 150, 6)] + [" ".join(base[n:]) for n in range(4, 60, 6)]
    check(spark, list(enumerate(rows)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mh.near_duplicates(empty).collect() == []
    assert mh.drop_near_duplicates(empty).collect() == []


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "g h"), (3, "i j k"), (3, "g h"), (4, ""), (4, ""), (None, "z"), (None, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, _key int, _id int, label int, _text_key int")
    got = mh.drop_near_duplicates(df)
    assert got.columns == df.columns
    left = sorted(((r.doc_id, r.text) for r in got.collect() if (r._key, r._id, r.label, r._text_key) == (1, 2, 3, 4)), key=str)
    assert left == sorted([(1, "a b c d e f"), (3, "g h"), (3, "i j k"), (4, ""), (4, ""), (None, "z"), (None, None)], key=str)


def test_recall_of_the_tables():
    """Pairs just above the threshold share a table key."""
    rng = np.random.default_rng(7)
    missed = 0
    for _ in range(400):
        both, own = rng.integers(0, 1 << 63, 300, np.uint64), rng.integers(0, 1 << 63, 96, np.uint64)
        a, b = (mh.bands(np.unique(np.concatenate([both, x]))) for x in (own[:48], own[48:]))
        same = a == b
        missed += not (same[:mh.GROUPS].any() and same[mh.GROUPS:].any())
    assert missed <= 3
