"""Replaced children: rows of odd keys, and tasks that hold keys instead of sorting children."""

import contextlib
import io

from claimforge.operators.upsert import replace_children
from claimforge.opsuite import QUERIES


def test_children_are_streamed_past_keys(spark):
    """No sort of the children, whose memory grew with the table, once the keys are too many to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            QUERIES["replace_children_of_parents"](spark, "/root/testdata/sf0.001").explain()
        assert "SortMergeJoin" not in plan.getvalue() and plan.getvalue().count("ShuffledHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_odd_keys(spark):
    """Repeated and null parents, parents without children; children without a key stay."""
    row = "k long, v int"
    old = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (None, 3), (4, 4)], row)
    new = spark.createDataFrame([(1, 10), (5, 50)], row)
    parents = spark.createDataFrame([(1,), (1,), (None,), (2,), (9,)], "k long")
    got = sorted(map(tuple, replace_children(old, new, parents, "k").collect()), key=str)
    assert got == sorted([(None, 3), (4, 4), (1, 10), (5, 50)], key=str)
