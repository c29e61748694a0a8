"""Spelling groups against plain edits of every word."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from noticeloom.llm import spelling as sp

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, word string, n string, size string, h string, near string"


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: set() for w in kept}
    for w in kept:
        cuts = {w[:k] + w[k + 1:] for k in range(len(w))}
        swaps = {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in sp.ALPHABET} - {w}
        for other in (cuts | swaps) & set(kept):
            near[w].add(other)
            near[other].add(w)
    best = {w: min(near[w], key=lambda x: (-kept[x], x)) for w in kept if near[w]}
    form = {w: b for w, b in best.items() if kept[b] >= 5 * kept[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w, ""), root(w), kept[w], len(near[w]), kept.get(form.get(w), 0)) for w in kept)


def rows():
    rng = random.Random(5)
    base = ["garden", "gardens", "éclairs", "wonderful", "ÀBCDEFG", "a" * 40]
    words = []
    for w in base:
        words += [w] * 150
        for _ in range(12):
            k = rng.randrange(len(w))
            variant = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(sp.ALPHABET) + w[k:], w[:k] + rng.choice(sp.ALPHABET) + w[k + 1:]])
            words += [variant] * rng.choice([4, 5, 6, 25, 30])
    words += ["gardon"] * 25 + ["gordon"] * 5 + ["Garden"] * 10 + ["short"] * 50
    rng.shuffle(words)
    texts = [" 9,".join(words[k::40]) for k in range(40)]
    out = list(enumerate(texts)) + [(100, None), (101, ""), (102, "1 2 3"), (3, texts[3]), (3, texts[3])]
    return out + [(None, texts[4]), (None, texts[4])]


def collected(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "w", "x", "y", "z", "v") for r in rows()], SCHEMA)


def test_against_all_edits(table):
    got = collected(sp.spelling_groups(table))
    assert got == plain(rows())
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got if r[1])


def test_shards_and_passes_change_nothing(spark, table, monkeypatch):
    """Several shards of a length, and filters that need several broadcasts."""
    monkeypatch.setattr(sp, "SHARD_WORDS", 3)
    monkeypatch.setattr(sp, "BROADCAST_BYTES", 128)
    assert collected(sp.spelling_groups(table)) == plain(rows())


def test_filter_misses_nothing():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    held = sp.BlockedFilter.of(keys)
    assert len(held.holds(keys)) == len(keys)
    others = rng.integers(0, 1 << 63, 100_000, dtype=np.uint64)
    assert len(held.holds(others)) < 2_000


def test_edits_have_the_hash_of_the_edited_word():
    words = ["abcdéf", "zzzzzz"]
    letters = np.array(sorted(map(ord, sp.ALPHABET)), np.uint64)
    edits = {(n, int(r), int(h)) for n, rows_, hashes in sp._edits(words, 6, letters, {5, 6}) for r, h in zip(rows_, hashes)}
    for row, w in enumerate(words):
        cuts = [w[:k] + w[k + 1:] for k in range(6)]
        swaps = [w[:k] + c + w[k + 1:] for k in range(6) for c in sp.ALPHABET if c > w[k]]
        for one in cuts + swaps:
            assert (len(one), row, int(np.uint64(sp._hash_words(pd.Series([one]))[0].astype(np.int64).view(np.uint64)))) in edits


def test_very_long_words(spark):
    long = "ab" * 30_000
    text = " ".join([long] * 30 + [long[:-1]] * 5)
    got = collected(sp.spelling_groups(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    assert got == plain_long(long)


def plain_long(word):
    h, g = (zlib.crc32(f"1:{w}".encode()) for w in (word, word[:-1]))
    assert h % 199 and g % 199
    return sorted([(word, "", word, 30, 1, 0), (word[:-1], word, word, 5, 1, 30)])


def test_empty_table(spark):
    assert sp.spelling_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
