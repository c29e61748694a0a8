"""The stages one by one, each against the operator's plain definition on the stage's own input."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline as cp
from noticeloom.llm.byte_bpe import codec

from .test_minhash import plain
from .test_mixing import plain_targets
from .test_site_lines import plain as plain_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        after = cp.cut_lineage(stage(spark, docs, SF))
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_columns(stages):
    assert list(stages) == ["language", "site_lines", "near_duplicates", "mixing", "byte_bpe"]
    for name, (before, after) in stages.items():
        if name != "byte_bpe":
            assert after.columns == cp.COLUMNS and dict(after.dtypes) == dict(before.dtypes)


def test_language_keeps_prose(stages):
    before, after = stages["language"]
    assert after.count() >= 0.97 * before.count() and after.filter("lang IS NULL").isEmpty()


def test_site_lines(stages):
    before, after = stages["site_lines"]
    wanted = plain_lines([(r.doc_id, r.source, r.text) for r in before.collect()])
    assert sorted(((r.doc_id, r.text) for r in after.collect()), key=str) == wanted


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    kept = {i for i, _, _, stays in plain([(r.doc_id, r.text) for r in before.collect()]) if stays}
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)


def test_mixing(stages):
    before, after = stages["mixing"]
    sizes, taken, own = Counter(), Counter(), Counter()
    longest = {}
    for r in before.collect():
        sizes[r.source] += len(r.text.split())
        longest[r.doc_id] = len(r.text.split())
    for r in after.collect():
        taken[r.source] += len(r.text.split())
        own[r.doc_id] += len(r.text.split())
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 1
    assert all(n <= 3 * longest[i] for i, n in own.items())


def test_tokens(stages):
    import public_tokenizers

    before, after = stages["byte_bpe"]
    own = codec(open(cp.RANKS, "rb").read(), public_tokenizers.PATTERN)
    texts = defaultdict(list)
    for r in before.collect():
        texts[r.doc_id].append(r.text)
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert own.decode(r.ids).decode() in texts[r.doc_id] and r.n_tokens == len(r.ids)


def test_run_on_odd_documents(spark, tmp_path):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, 1) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, None, None, None, None, None), (900, "", "en", "src1", 0, 2), (901, "x", None, None, 1, 3), rows[0], (902, "long word " * 30_000, "en", None, 0, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.run(spark, str(tmp_path))
    assert got.count() > 0.5 * len(rows)
    df.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/none/documents.parquet")
    assert cp.run(spark, f"{tmp_path}/none").collect() == []
