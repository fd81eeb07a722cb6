"""The walk as an expression: values are looked up by the schema's keys."""

import json

from pyspark.sql import functions as F

from claimforge.operators.drift import Field, audit

SCHEMA = [Field("a", "array", drifted=("object",), legacy=("A", "aa")), Field("a[*].x", "number", drifted=("string",), required="error"), Field("b.it's", "boolean", drifted=("null",), required="warning")]


def found(spark, *docs):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, text string")
    return audit(rows.select("id", F.try_parse_json("text").alias("payload")), "payload", SCHEMA)


def test_no_object_is_turned_into_nodes(spark):
    """Objects were opened into maps and every node was a row of an array, which took most of the time."""
    plan = found(spark, {})._jdf.queryExecution().optimizedPlan().toString()
    assert "map_entries" not in plan and "map<string,variant>" not in plan


def test_names_and_kinds(spark):
    docs = [
        {"A": {"x": "1"}, "aa": [{"x": 1}, {"x": None}, None, {"y": 1}], "b": {"it's": None}, **{f"k{i}": {"a": i} for i in range(300)}},
        {"a": 5, "A": {"x": "1"}, "b": "text"},
        [{"a": {"x": "1"}}],
    ]
    got = {}
    for r in found(spark, *docs).collect():
        got.setdefault(r.id, []).append((r.rule_id.split("_", 1)[1], r.field_name, r.original_value, r.clean_value))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        0: sorted([
            ("KEY_DRIFT", "a", "A", "a"), ("KEY_DRIFT", "a", "aa", "a"), ("SHAPE_DRIFT", "a", "object", "array"), ("TYPE_DRIFT", "a[0].x", "1", None),
            ("MISSING_KEY", "a[2].x", None, None), ("MISSING_KEY", "a[3].x", None, None), ("TYPE_DRIFT", "b.it's", None, None),
        ], key=str),
        1: sorted([("KEY_DRIFT", "a", "A", "a"), ("MISSING_KEY", "b.it's", None, None)], key=str),
    }
