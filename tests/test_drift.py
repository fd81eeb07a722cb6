"""The walk over documents against a plain one in Python."""

import json
import re

from pyspark.sql import functions as F

from claimforge.operators.drift import Field, audit
from claimforge.plans.quality import DOCUMENT

DOCS = [
    {"claim_id": "A", "line_items": [{"amount": 1.5, "unit_amount": 2}], "documents_submitted": [], "submission_channel": None, "provider": {"type": "t"}, "adjuster_id": "x"},
    {"ClaimID": "B", "lineItems": {"amount": "3", "unit_amount": "$4"}, "documents_submitted": "a,b", "provider": {}, "travel": {"exchange_rate_to_cad": "1.3"}},
    {"ClaimID": "old", "claim_id": "new", "lineItems": [{"amount": "9"}], "line_items": [{"amount": 1}, {"amount": "2", "unit_amount": 1}, {"unit_amount": "7"}], "provider": None},
    {"line_items": None, "lineItems": [{"amount": "1"}], "documents_submitted": {"a": 1}, "submission_channel": "", "adjuster_id": 0, "travel": {"exchange_rate_to_cad": None}},
    {"line_items": [], "provider": ["type"], "documents_submitted": ["x"], "submission_channel": "web", "adjuster_id": "", "travel": "none"},
    [1, 2],
    {},
]


def kind(x):
    return {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(x), "number")


def plain(doc, schema):
    """(rule, path, original, clean) of a document."""
    out = []
    walked = {"": [("", doc)]}

    def at(pattern):
        if pattern in walked:
            return walked[pattern]
        found = []
        if pattern.endswith("[*]"):
            for path, x in at(pattern[:-3]):
                alone = any(f.path == pattern[:-3] and "object" in f.drifted for f in schema)
                wrapped = [x] if isinstance(x, dict) and alone else x if isinstance(x, list) else []
                found += [(f"{path}[{i}]", v) for i, v in enumerate(wrapped)]
        else:
            parent, _, key = pattern.rpartition(".")
            legacy = next((f.legacy for f in schema if f.path == pattern), ())
            for path, x in at(parent):
                names = [k for k in (key, *legacy) if isinstance(x, dict) and k in x]
                if names:
                    found.append((f"{path}.{key}".lstrip("."), x[names[0]]))
        walked[pattern] = found
        return found

    for f in schema:
        for path, x in at(f.path):
            if kind(x) in f.drifted:
                shape = f.kind in ("array", "object")
                out.append(("JSON_SHAPE_DRIFT" if shape else "JSON_TYPE_DRIFT", path, kind(x) if shape else x, f.kind if shape else None))
        for path, x in at(f.parent):
            own = f"{path}.{f.key}".lstrip(".")
            out += [("JSON_KEY_DRIFT", own, old, f.key) for old in f.legacy if isinstance(x, dict) and old in x]
            if f.required and not any(p == own for p, _ in at(f.path)):
                out.append(("JSON_MISSING_KEY", own, None, None))
    return sorted(out, key=str)


def test_walk_equals_plain_walk(spark):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(90, "{broken"), (91, None)]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("rule", F.lit("x"))
    deep = [Field("a.b[*].c[*].d", "number", drifted=("string",), required="error"), Field("a.b", "array", drifted=("object",), legacy=("B",))]
    deeper = {"a": {"B": [{"c": [{"d": "1"}, {}, {"d": 2}]}, {"c": {"d": "not looked into"}}, 5]}}
    for schema, docs in ((DOCUMENT, DOCS), (deep, [deeper, {"a": {"b": {"c": [{"d": "3"}]}}}])):
        df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + rows[-2:], "id int, text string").withColumn("rule", F.lit("x"))
        found = audit(df.withColumn("payload", F.try_parse_json("text")).drop("text"), "payload", schema)
        assert found.columns[:2] == ["id", "rule"]
        got = {}
        for r in found.collect():
            got.setdefault(r.id, []).append((r.rule_id, r.field_name, r.original_value, r.clean_value))
            json.loads(r.details)
            assert not re.search(r"\[\*\]", r.field_name)
        want = {i: plain(d, schema) for i, d in enumerate(docs)}
        assert {i: sorted(x, key=str) for i, x in got.items()} == {i: x for i, x in want.items() if x}


def test_severities_and_details(spark):
    df = spark.createDataFrame([(json.dumps(DOCS[1]),)], "text string").select(F.try_parse_json("text").alias("payload"))
    got = {(r.rule_id, r.field_name): r for r in audit(df, "payload", DOCUMENT).collect()}
    assert got["JSON_MISSING_KEY", "adjuster_id"].severity == "warning" and got["JSON_MISSING_KEY", "provider.type"].severity == "error"
    assert got["JSON_KEY_DRIFT", "line_items"].details == '{"legacy_key":"lineItems"}' and got["JSON_TYPE_DRIFT", "line_items[0].unit_amount"].original_value == "$4"
    assert {r.action for k, r in got.items() if k[0] == "JSON_MISSING_KEY"} == {"flagged"} and {r.action for k, r in got.items() if k[0] != "JSON_MISSING_KEY"} == {"normalized"}


def test_one_scan_and_no_shuffle(spark, tmp_path):
    spark.createDataFrame([(json.dumps(d),) for d in DOCS], "text string").write.parquet(str(tmp_path / "d"))
    found = audit(spark.read.parquet(str(tmp_path / "d")).select(F.try_parse_json("text").alias("payload")), "payload", DOCUMENT)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and plan.count("Generate ") == 1
