"""Matching operators against pairs, with nulls, ties and a hot key."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimforge.operators.matching import Alike, best_alike, nearest_by_date, rolling_count

DAY = dt.date(2020, 1, 1)


def days(rng, n, span):
    return [None if rng.random() < 0.05 else DAY + dt.timedelta(days=int(x)) for x in rng.integers(0, span, n)]


@pytest.mark.parametrize("span, width", [(40, 30), (9000, 30), (9000, 2000)])
def test_rolling_count_equals_pairs(spark, span, width):
    rng = np.random.default_rng(span)
    rows = [(i, None if k == 4 else int(k), d) for i, (k, d) in enumerate(zip(rng.integers(0, 5, 300), days(rng, 300, span), strict=True))]
    df = spark.createDataFrame(rows, "id long, k long, day date").withColumn("at", F.lit(1))
    got = {r.id: r.n for r in rolling_count(df, ["k"], "day", width, "n").collect()}
    want = {i: sum(None not in (k, d, d2) and k == k2 and 0 <= (d - d2).days < width for _, k2, d2 in rows) for i, k, d in rows}
    assert got == want


def test_rolling_count_of_a_hot_key_is_many_tasks(spark):
    """A million rows of one key go to a bucket for each 240 days, and each bucket counts on its own."""
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 8000).cast("int")).alias("day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = rolling_count(df, ["k"], "day", 30, "n")
        tasks = counted.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 600_000  # all four partitions of the test session
    assert counted.agg(F.sum("n")).first()[0] == 125 * 125 * sum(min(30, d + 1) for d in range(8000))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_nearest_equals_pairs(spark, how):
    rng = np.random.default_rng(7)
    left = [(i, None if k == 6 else int(k), d) for i, (k, d) in enumerate(zip(rng.integers(0, 7, 200), days(rng, 200, 60), strict=True))]
    right = [(None if k == 6 else int(k), d, int(v), f"v{v}") for k, d, v in zip(rng.integers(1, 7, 60), days(rng, 60, 60), rng.integers(0, 9, 60), strict=True)]
    lf = spark.createDataFrame(left, "id long, k long, day date").withColumn("note", F.lit("x"))
    rf = spark.createDataFrame(right, "k long, other date, v long, w string")
    got = {r.id: tuple(r)[1:] for r in nearest_by_date(lf, rf, ["k"], "day", "other", ["v", "w"], ["id"], how).collect()}
    want = {}
    for i, k, d in left:
        best = min(((abs((o - d).days), o, v, w) for k2, o, v, w in right if k is not None and k == k2 and d and o), default=None)
        if best or how == "left":
            want[i] = best or (None,) * 4
    assert got == want


def test_nearest_is_linear_in_a_hot_key(spark):
    """10^5 rows on each side of one key would be 10^10 pairs."""
    left = spark.range(100_000).select("id", F.lit(1).alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 20_000 * 2).cast("int")).alias("day"))
    right = spark.range(100_000).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 20_000 * 2 + 1).cast("int")).alias("other"), F.col("id").alias("v"))
    got = nearest_by_date(left, right, ["k"], "day", "other", ["v"], ["id"])
    assert got.agg(F.count("*"), F.min("days"), F.max("days")).first() == (100_000, 1, 1)
    assert got.filter("id = 0 or id = 5").orderBy("id").select("v").collect() == [(0,), (4,)]  # day 10 lies between 9 and 11


def test_best_alike_equals_pairs(spark):
    rng = np.random.default_rng(1)
    some = lambda n: [None if x == n else int(x) for x in rng.integers(0, n + 1, 150)]
    rows = list(zip(range(150), some(3), some(4), some(3), [int(x) for x in rng.integers(0, 50, 150)], strict=True))
    df = spark.createDataFrame(rows, "id long, a long, b long, c long, score long")
    order = F.struct("score", F.col("id").alias("who"))
    got = {r.id: r.best.who for r in best_alike(df, order, [Alike(("a", "b")), Alike(("a",), differ="c"), Alike(("b",), differ="c")], "best").collect()}
    alike = lambda r, s: None not in (r[1], r[2]) and r[1:3] == s[1:3] or r[3] != s[3] and (r[1] is not None and r[1] == s[1] or r[2] is not None and r[2] == s[2])
    assert got == {r[0]: min((s[4], s[0]) for s in rows if s is r or alike(r, s))[1] for r in rows}


def test_best_alike_is_linear_in_a_block(spark):
    """10^5 namesakes; each must differ from its best in a column of many values."""
    df = spark.range(100_000).select("id", F.lit("a").alias("name"), (F.col("id") % 1000).alias("born"))
    best = best_alike(df, F.struct(F.col("id").alias("who")), [Alike(("name",), differ="born")], "best")
    rows = best.filter("id in (0, 1000, 5, 99999)").select("id", "best.who").collect()
    # the least of all but the own class: 0, and 1 for the class of 0 beside the rows themselves
    assert dict(map(tuple, rows)) == {0: 0, 1000: 1, 5: 0, 99999: 0}


def test_empty_tables(spark):
    e = spark.createDataFrame([], "id long, k long, day date")
    assert rolling_count(e, ["k"], "day", 3, "n").count() == 0
    assert best_alike(e, F.struct("id"), [Alike(("k",), differ="day")], "b").count() == 0
    assert nearest_by_date(e, e.withColumnRenamed("day", "other"), ["k"], "day", "other", ["id"], ["k"]).count() == 0
