"""Inferred schemas and profiles of nested paths."""

import json
from collections import Counter

import pytest
from pyspark.sql import Row

from terraloom.sources import inferred

LINES = [
    {"a": 1, "b": {"c": [1, 2, {"d": None}], "e": "x"}, "n": None},
    {"a": 2, "b": {"c": [], "f": True}, "g": 1.5},
    {"b": None, "h": [[1], ["t"]]},
    {},
]


def paths(value, path="$"):
    kind = {dict: "object", list: "array", type(None): "null", str: "string", bool: "boolean"}.get(type(value), "number")
    yield path, kind
    for k, v in value.items() if kind == "object" else ():
        yield from paths(v, f"{path}.{k}")
    for v in value if kind == "array" else ():
        yield from paths(v, f"{path}[*]")


def test_profile_of_paths_at_any_depth(spark):
    deep = "[" * 5 + "1" + "]" * 5
    lines = [*map(json.dumps, LINES), "not json", deep, '"text"', "null", None]
    got = {(r.path, r.kind): r.n for r in inferred.path_profile(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)).collect()}
    want = Counter(p for x in [*LINES, json.loads(deep), "text", None] for p in paths(x))
    assert got == want


def test_schema_is_inferred_over_all_lines(spark, tmp_path):
    lines = [*({"id": i, "in": {"x": i / 2}} for i in range(50)), {"id": 50, "late": "only here", "in": {"y": [1]}}, {"id": "fifty", "never": None}]
    (tmp_path / "a.json").write_text("\n".join(["broken {", "[1]", *map(json.dumps, lines)]))
    df = inferred.read_records(spark, str(tmp_path))
    assert df.columns == ["id", "in", "late", "never"]
    rows = df.selectExpr("cast(id as string) AS id", "in.x AS x", "in.y AS y", "late", "never").collect()
    assert len(rows) == 52 and {r.id for r in rows} == {*map(str, range(51)), "fifty"}
    assert [r for r in rows if r.id == "50"] == [Row(id="50", x=None, y=[1], late="only here", never=None)]
    assert sum(float(r.x) for r in rows if r.x is not None) == sum(i / 2 for i in range(50))


def test_nothing_to_infer(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1]\nnone\n")
    with pytest.raises(ValueError, match="no JSON objects"):
        inferred.read_records(spark, str(tmp_path))
    assert inferred.path_profile(spark.createDataFrame([], "value string")).count() == 0
