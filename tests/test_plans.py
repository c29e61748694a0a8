"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from noticeloom.operators import boards as b, diff as d, match as m, report as r
from noticeloom.operators.dedup import dedup_last
from noticeloom.operators.extract import extract_rows
from noticeloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def runs(spark):
    schema = "source string, id string, apply_end string, pos long"
    return [spark.createDataFrame([("s", "1", "", 1)], schema) for _ in range(2)]


def test_dedup_and_diff_share_one_shuffle(spark):
    text = plan(d.pair_runs(*runs(spark), ["pos"]))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_max_by" in text


def test_dedup_folds_before_the_shuffle(spark):
    text = plan(dedup_last(runs(spark)[0], ["source", "id"], ["pos"]))
    assert "partial_max_by" in text and len(re.findall("Exchange hashpartitioning", text)) == 1
    assert "Window" not in text


def test_markup_is_not_shuffled(spark, tmp_path):
    pages = spark.createDataFrame([("kocca", 1, 200, "<tr></tr>")], "source string, page_no int, status int, html string")
    pages.write.partitionBy("source").parquet(str(tmp_path / "pages"))
    table = spark.read.parquet(str(tmp_path / "pages"))
    rows = extract_rows(table, b.KOCCA)
    text = plan(rows)
    assert "Exchange" not in text
    assert re.search(r"PartitionFilters: \[.*source.* = kocca", text)
    assert re.search(r"PushedFilters: \[.*EqualTo\(status,200\)", text)
    above = plan(dedup_last(rows, ["source", "id"], ["page_no", "pos"])).split("Exchange")[0]
    assert "html" not in above and "block" not in above


def test_no_cartesian_products(spark, no_broadcast):
    profiles = spark.createDataFrame([("p", ["a"], ["x"], ["y"])], "profile_id string, needs array<string>, regions array<string>, movable_regions array<string>")
    items = spark.createDataFrame([("s", "1", ["a"], "x", "t")], "source string, id string, offers array<string>, region string, title string")
    watch = spark.createDataFrame([("w", "t")], "program string, pattern string")
    for df in (m.match_profiles(profiles, items), r.absent_programs(watch, items)):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "SortMergeJoin" in text


@pytest.mark.parametrize("name", ["order_diff", "tiers", "matched_profiles", "similar_titles", "page_yield", "carried_verdicts"])
def test_registered_plans_have_no_products(spark, no_broadcast, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["matched_profiles", "known_matches"])
def test_members_become_rows_after_the_last_shuffle(spark, no_broadcast, name):
    """Disk holds arrays of members: a row per member and class of the other side comes after the join."""
    text = plan(catalog.QUERIES[name](spark, SF))
    last = text[text.index("inline(_left"):]
    assert text.index("inline(_right") < text.index("inline(_left") < text.index("SortMergeJoin") and "Exchange" in last


def test_scans_read_what_they_need(spark):
    text = plan(catalog.QUERIES["items_per_source"](spark, SF))
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string>", text)
    cap = plan(catalog.QUERIES["open_orders"](spark, SF))
    assert "o_totalprice" not in cap


def test_top_k_is_limited_before_the_shuffle(spark):
    schema = "profile_id string, tier string, source string, id string, apply_end string"
    df = spark.createDataFrame([("p", "A", "s", "1", "")], schema)
    assert plan(r.top_in_tier(df, 3)).count("WindowGroupLimit") == 2


def test_python_runs_once_per_block(spark):
    pages = spark.createDataFrame([(1, 200, "<tr></tr>")], "page_no int, status int, html string")
    assert plan(extract_rows(pages, b.NIPA)).count("ArrowEvalPython") == 1
    assert plan(extract_rows(pages, b.BIZINFO)).count("ArrowEvalPython") == 2


def test_runs_are_read_once(spark, tmp_path):
    """The diff scans each run once: for the pairs. Coverage is taken from their stage."""
    schema = "source string, id string, apply_end string, pos int"
    for name in ("prev", "curr"):
        spark.createDataFrame([("s", name, "", 1)], schema).write.parquet(f"{tmp_path}/{name}")
    diff = d.snapshot_diff(spark.read.parquet(f"{tmp_path}/prev"), spark.read.parquet(f"{tmp_path}/curr"), ["pos"])
    assert str(tmp_path) + "/prev" not in plan(diff) and str(tmp_path) + "/curr" not in plan(diff)
    assert {r.status for r in diff.collect()} == {"new", "closed"}
