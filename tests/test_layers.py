"""Tables by parts: what a change rewrites, what two writers do to each other, what broken rows do."""

import csv
import datetime as dt
import decimal
import hashlib
import io
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimforge.plans import pipeline
from claimforge.sources.export import export_csv
from claimforge.sources.layers import Constraints, InvalidTables, Layers, children, rebuilt, replaced, upserted


def files(root):
    return {p: hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet")}


def table(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.publish("core", lambda _: {"t": upserted(spark.range(4000).select(F.col("id").alias("k"), F.lit("old").alias("v")), "k", buckets=64)})
    before = files(tmp_path)
    new = [(i * 397, "new") for i in range(10)] + [(100_000, "new")]
    layers.publish("core", lambda _: {"t": upserted(table(spark, new), "k")})
    now = layers.snapshot("core")
    changed = {p.parent.parent.name for p in set(files(tmp_path)) - set(before)}
    assert len(changed) == 1 and 1 <= len(list((tmp_path / "core" / "t" / changed.pop()).glob("part=*"))) <= 11
    assert all(files(tmp_path)[p] == h for p, h in before.items())
    assert rows(now.read("t")) == sorted([(i, "new" if (i, "new") in new else "old") for i in range(4000)] + [(100_000, "new")], key=str)
    assert len(now.tables["t"]["parts"]) == 64 and now.tables["t"]["split"]["buckets"] == 64
    for i in range(3):  # what two versions in a row no longer name goes
        layers.publish("core", lambda _, i=i: {"t": upserted(table(spark, [(0, f"v{i}")]), "k")})
    assert rows(layers.read("core", "t").filter("k = 0")) == [(0, "v2")]
    named = {p for v in layers.versions("core")[-2:] for t in layers.state("core", v)[1]["tables"].values() for p in t["parts"].values()}
    assert {str(p.parent.relative_to(tmp_path)) for p in files(tmp_path)} == named


def test_children_and_partitions(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    lines = "k long, n int, v string"
    layers.publish("core", lambda _: {"l": children(table(spark, [(1, 1, "a"), (1, 2, "a"), (2, 1, "a"), (3, 1, "a")], lines), table(spark, [], "k long"), "k", 8), "log": rebuilt(table(spark, [(1, "x"), (2, "y")]), "k", 1, 2)})
    before = files(tmp_path)
    layers.publish("core", lambda _: {"l": children(table(spark, [(1, 1, "b")], lines), table(spark, [(1,), (2,)], "k long"), "k"), "log": rebuilt(table(spark, [(2, "z"), (2, "w")]), "k", 2)})
    assert rows(layers.read("core", "l")) == [(1, 1, "b"), (3, 1, "a")] and rows(layers.read("core", "log")) == [(1, "x"), (2, "w"), (2, "z")]
    assert rows(layers.snapshot("core").read("log", ["2"])) == [(2, "w"), (2, "z")]
    now = {p for t in layers.snapshot("core").tables.values() for p in t["parts"].values()}
    assert any(str(p.parent.relative_to(tmp_path)) in now for p in before)  # the parts of 3 and of the first load
    layers.publish("core", lambda _: {"log": rebuilt(table(spark, []), "k", 1)})
    assert rows(layers.read("core", "log")) == [(2, "w"), (2, "z")]
    layers.publish("core", lambda _: {"log": replaced(table(spark, []))})
    assert layers.read("core", "log").count() == 0 and layers.read("core", "log").columns == ["k", "v"]


def test_broken_constraints_publish_nothing(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    limits = Constraints({"p": {"v is short": "length(v) < 3", "k is known": "k is not null"}}, {"p": [("k",), ("v",)]}, [("c", "p", "k")])
    good = lambda _: {"p": upserted(table(spark, [(1, "a"), (2, "b"), (3, None), (4, None)]), "k"), "c": upserted(table(spark, [(1, "x"), (None, "y")]), "k")}
    layers.publish("core", good, limits)
    before = files(tmp_path)
    bad = {
        "v is short": {"p": upserted(table(spark, [(5, "long")]), "k")},
        "k is known": {"p": upserted(table(spark, [(None, "q")]), "k")},
        "p: k is unique": {"p": upserted(table(spark, [(6, "q"), (6, "r")]), "k")},
        "p: v is unique": {"p": upserted(table(spark, [(7, "a")]), "k")},  # against a part that is not touched, perhaps
        "c have p": {"c": upserted(table(spark, [(9, "x")]), "k")},
    }
    for message, change in bad.items():
        with pytest.raises(InvalidTables, match=message):
            layers.publish("core", lambda _, change=change: change, limits)
    assert files(tmp_path) == before and layers.versions("core") == [1]
    layers.publish("core", lambda _: {"p": upserted(table(spark, [(9, "n")]), "k"), "c": upserted(table(spark, [(9, "x")]), "k")}, limits)
    assert layers.versions("core") == [1, 2]
    nothing = spark.createDataFrame([], "k long, v string")  # known to be empty before it is written
    layers.publish("core", lambda _: {"p": upserted(nothing, "k"), "q": upserted(nothing, "k")}, Constraints({"p": {"k is known": "k is not null"}, "q": {"k is known": "k is not null"}}))
    assert layers.read("core", "q").columns == ["k", "v"] and layers.read("core", "p").count() == 5


def test_checks_cost_a_write_and_two_jobs(spark, tmp_path):
    """Row checks are part of the write: a table without keys and references takes as many jobs with checks as without."""
    layers, tracker = Layers(spark, str(tmp_path)), spark.sparkContext.statusTracker()
    jobs = {}
    for n, checks in enumerate([{}, {f"check {i}": f"k <> {-1 - i}" for i in range(40)}]):
        spark.sparkContext.setJobGroup(f"write-{n}", "")
        layers.publish(f"l{n}", lambda _: {"t": replaced(spark.range(1000).withColumnRenamed("id", "k"))}, Constraints({"t": checks}))
        jobs[n] = len(tracker.getJobIdsForGroup(f"write-{n}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def together(n, work):
    found, errors, gate = [None] * n, [], threading.Barrier(n)

    def run(i):
        try:
            gate.wait()
            found[i] = work(i)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    return found


def test_loads_registered_together_get_ids_of_their_own(spark, tmp_path):
    got = together(8, lambda i: pipeline.register(Layers(spark, str(tmp_path)), f"batch {i % 6}"))
    ids = {f"batch {i % 6}": load for i, (load, _) in enumerate(got)}
    assert sorted(ids.values()) == [1, 2, 3, 4, 5, 6] and all(ids[f"batch {i % 6}"] == load and not done for i, (load, done) in enumerate(got))
    layers = Layers(spark, str(tmp_path))
    together(6, lambda i: pipeline.record(layers, i + 1, "succeeded", f"note {i}"))
    assert [(x["load_id"], x["status"], x["note"]) for x in layers.state("control")[1]["loads"]] == [(i + 1, "succeeded", f"note {i}") for i in range(6)]
    assert pipeline.register(layers, "batch 3") == (ids["batch 3"], True)


def test_only_one_writer_creates_a_version(spark, tmp_path):
    won = together(8, lambda i: Layers(spark, str(tmp_path)).advance("x", 0, {"by": i}))
    assert sum(won) == 1 and Layers(spark, str(tmp_path)).state("x") == (1, {"by": won.index(True)})
    assert not list(tmp_path.rglob("*.tmp"))


@pytest.mark.parametrize("shared", [True, False])
def test_writers_together_lose_no_row(spark, tmp_path, shared):
    """On the same buckets the loser merges anew, on others its files go along."""
    root = str(tmp_path)
    Layers(spark, root).publish("core", lambda _: {"t": upserted(table(spark, [(-1, "first")]), "k", buckets=1 if shared else 32)})
    made = [0] * 4

    def write(i):
        def changes(_):
            made[i] += 1
            return {"t": upserted(table(spark, [(i, f"w{i}"), (-1, f"w{i}")] if shared else [(i, f"w{i}")]), "k")}

        return Layers(spark, root).publish("core", changes)

    versions = together(4, write)
    found = dict(rows(Layers(spark, root).read("core", "t")))
    assert sorted(versions) == [2, 3, 4, 5] and {found[i] for i in range(4)} == {f"w{i}" for i in range(4)}
    assert found[-1] == f"w{versions.index(5)}" if shared else found[-1] == "first"
    if shared:
        assert sum(made) > 4


def test_a_writer_whose_base_is_gone_starts_anew(spark, tmp_path):
    root, tries = str(tmp_path), []
    Layers(spark, root).publish("core", lambda _: {"t": upserted(table(spark, [(0, "first")]), "k", buckets=1)})

    def slow(base):
        tries.append(base.version)
        if len(tries) == 1:  # three versions go by, and the files of the base are deleted
            for i in range(3):
                Layers(spark, root).publish("core", lambda _, i=i: {"t": upserted(table(spark, [(i, f"other {i}")]), "k")})
        return {"t": upserted(table(spark, [(9, "slow")]), "k")}

    assert Layers(spark, root).publish("core", slow) == 5 and tries == [1, 4]
    assert rows(Layers(spark, root).read("core", "t")) == [(0, "other 0"), (1, "other 1"), (2, "other 2"), (9, "slow")]
    with pytest.raises(ZeroDivisionError):
        Layers(spark, root).publish("core", lambda _: 1 / 0)


def test_export_equals_python(spark, tmp_path):
    moment = dt.datetime(2024, 2, 10, 18, 0, 0, 5)
    data = [(i, f't"{i}, x' if i % 3 else None, i % 2 == 0, decimal.Decimal(i) / 4, dt.date(2024, 1, 1 + i % 28), moment if i % 5 else None, "line\nbreak" if i == 7 else "é") for i in range(500)]
    schema = "id long, text string, flag boolean, amount decimal(12,2), day date, at timestamp, note string"
    df = spark.createDataFrame(data, schema).withColumn("filled", F.when(F.col("id") == 0, F.array(F.lit("amount"))).otherwise(F.array().cast("array<string>")))
    path = str(tmp_path / "out.csv")
    assert export_csv(df.repartition(7), path, ["text", "id"], "filled") == 500
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(schema.replace(",2)", ")").replace(",", " ").split()[::2])
    for r in sorted(data, key=lambda r: (r[1] is None, r[1] or "", r[0])):
        zoned = r[5] and r[5].replace(tzinfo=dt.timezone.utc)
        writer.writerow(["" if x is None else x for x in (r[0], r[1], r[2], 0 if r[0] == 0 else r[3].quantize(decimal.Decimal("0.01")), r[4], zoned, r[6])])
    assert Path(path).read_text() == out.getvalue()
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out.csv"]
    assert export_csv(df.limit(0), path, ["id"]) == 0 and Path(path).read_text().count("\n") == 1
