"""Field-level differences of records of any shape."""

import json

from noticeloom.operators import fields as fd

SCHEMA = "source string, id string, record string"
PREV = {
    "1": {"a": 1, "b": {"c": "x", "d": {"e": [1, 2]}}, "n": None}, "2": {"a": {"deep": {"er": {"est": 1}}}}, "3": "no json",
    "4": {"a": {}}, "5": {"same": 1}, "6": {"x": '{{{"}'}, "gone": {"a": 1}, "8": [1],
}
CURR = {
    "1": {"a": 2, "b": {"c": "x", "d": {"e": [1, 3], "f": {"g": 1}}}, "new": "v"}, "2": {"a": {"deep": {"er": {"est": 2}}}},
    "3": {"a": 1}, "4": {"a": {"b": 1}}, "5": {"same": 1}, "6": {"x": "}"}, "come": {"a": 1}, "8": {"a": [{"b": 1}]},
}


def table(spark, run):
    rows = [("s", k, v if isinstance(v, str) else json.dumps(v)) for k, v in run.items()]
    return spark.createDataFrame([*rows, ("s", "null", None)], SCHEMA)


def leaves(record, path=""):
    for name, value in record.items():
        if isinstance(value, dict):
            yield from leaves(value, f"{path}{name}.")
        else:
            yield f"{path}{name}", json.dumps(value, separators=(",", ":"))


def plain():
    out = []
    for k in PREV.keys() & CURR.keys():
        old, new = (dict(leaves(r[k])) if isinstance(r[k], dict) else {} for r in (PREV, CURR))
        for path in old.keys() | new.keys():
            if old.get(path) != new.get(path):
                change = "added" if path not in old else "removed" if path not in new else "changed"
                out.append((k, path, change, old.get(path), new.get(path)))
    return sorted(out, key=str)


def test_field_diff(spark):
    got = fd.field_diff(table(spark, PREV), table(spark, CURR))
    assert sorted(((r.id, r.path, r.change, r.old, r.new) for r in got.collect()), key=str) == plain()


def test_levels_that_are_not_opened(spark):
    rows = {r.path: r.value for r in fd.field_rows(table(spark, {"2": PREV["2"]}), 2).collect()}
    assert rows == {"a.deep": '{"er":{"est":1}}'}


def test_schema_of_a_run(spark):
    assert fd.run_schema(table(spark, {"1": {"a": 1, "b": {"c": "x"}}, "2": {"d": [1]}})) == (
        "OBJECT<a: BIGINT, b: OBJECT<c: STRING>, d: ARRAY<BIGINT>>")
    assert fd.run_schema(table(spark, {}).limit(0)) == "VOID"


def test_empty(spark):
    none = table(spark, {}).limit(0)
    assert fd.field_diff(none, none).collect() == [] == fd.field_rows(none, 0).collect()
