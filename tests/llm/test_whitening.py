"""Whitening against a dense eigensolver and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimforge.llm.whitening import fit, lanczos, op13_embedding_whitening, orthogonal, prepared, whiten

SCHEMA = "vec_id long, embedding array<float>, n int, x string"


def dense(x):
    """(eigenvalues, eigenvectors, trace, exact deviations) of integer rows."""
    n, sums = len(x), [int(s) for s in x.astype(object).sum(axis=0)]
    scaled = n * x.astype(object) - np.array(sums, object)
    y = scaled.astype(float) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    return values[::-1], vectors[:, ::-1], np.trace(v), [min(2**63 - 1, sum(int(a) ** 2 for a in r)) for r in scaled], y


def written(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_query_equals_dense(spark, tmp_path):
    rng = np.random.default_rng(0)
    v = (rng.normal(0, 1, (500, 24)) * np.linspace(3, 0.2, 24)).astype(np.float32)
    v[7] = v[9]
    rows = [(i, [float(a) for a in r], 0, "") for i, r in enumerate(v)]
    rows += [(None, [0.0] * 24, 0, ""), (5, [1.0] * 24, 0, ""), (600, None, 0, ""), (601, [float("nan")] + [0.0] * 23, 0, ""), (602, [None] + [0.0] * 23, 0, ""), (603, [float("-inf")] + [0.0] * 23, 0, ""), (604, [], 0, "")]
    kept = [r for r in rows if r[1] and all(a is not None and np.isfinite(a) for a in r[1])]
    x = np.floor(1024 * np.array([r[1] for r in kept])).astype(np.int64) + 100_000
    values, vectors, trace, deviations, y = dense(x)
    got = op13_embedding_whitening(spark, written(spark, rows, tmp_path)).collect()
    assert len(got) == 8 * len(kept) and {r.n for r in got} == {len(kept)} and max(r.identity_error for r in got) < 1e-9
    want = y @ vectors[:, :8] / np.sqrt(values[:8])
    signs = {}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-10
    for i, row in enumerate(kept):
        if len(by[row[0], 1]) == 1:
            for c in range(1, 9):
                (r,) = by[row[0], c]
                signs.setdefault(c, np.sign(r.whitened * want[i, c - 1]))
                assert r.deviation == deviations[i] and abs(r.whitened - signs[c] * want[i, c - 1]) < 1e-8
    assert sorted(r.deviation for r in by[5, 1]) == sorted(d for d, row in zip(deviations, kept, strict=True) if row[0] == 5)


@pytest.mark.parametrize("d, rank", [(3, 3), (40, 5), (100, 100)])
def test_lanczos_equals_dense(d, rank):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(rank, d)) * 10.0 ** np.linspace(2, 0, rank)[:, None]
    v = a.T @ a
    passes = []
    values, vectors = lanczos(lambda q: passes.append(q) or v @ q, d, 8)
    want = np.linalg.eigvalsh(v)[::-1][:8]
    assert np.allclose(values, want, rtol=1e-11, atol=1e-11 * want[0]) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * values) < 1e-11 * want[0]
    basis = np.column_stack(passes)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-12) and basis.shape[1] <= d


def test_breakdown_restarts():
    """Two eigenvalues only: the second block vanishes, and random directions take its place."""
    v = np.diag([5.0] * 3 + [1.0] * 57)
    values, _ = lanczos(lambda q: v @ q, 60, 8, block=8)
    assert np.allclose(values, [5, 5, 5, 1, 1, 1, 1, 1])
    rng = np.random.default_rng(0)
    basis = np.eye(6)[:, :2]
    new = orthogonal(np.column_stack([basis[:, 0], np.zeros(6), np.ones(6)]), basis, rng, 1e-10)
    assert new.shape == (6, 3) and np.allclose(new.T @ new, np.eye(3)) and np.allclose(basis.T @ new, 0)


def test_large_numbers_are_exact(spark):
    rows = [(i, [float(2**40 + i * 2**20), -float(i), 3.0], 0, "") for i in range(5)]
    ((model, prepared_rows),) = whiten(spark.createDataFrame(rows, SCHEMA))
    x = np.array([[int(np.floor(1024 * np.float32(a))) + 100_000 for a in r[1]] for r in rows])
    assert model.centre.sums == [int(s) for s in x.astype(object).sum(axis=0)]
    assert {r.vec_id: r.deviation for r in model.transform(prepared_rows).collect()} == dict(enumerate(dense(x)[3]))


def test_low_rank_few_and_no_rows(spark, tmp_path):
    rng = np.random.default_rng(4)
    flat = rng.normal(size=(60, 2)) @ rng.normal(size=(2, 12)) * 1e4
    rows = [(i, [float(a) for a in np.round(r)], 0, "") for i, r in enumerate(np.round(flat))]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<double>"))
    ((model, part),) = whiten(df)
    assert 2 <= len(model.values) <= 8 and model.identity_error(part) < 1e-4
    mixed = op13_embedding_whitening(spark, written(spark, [(1, [1.0, 2.0], 0, ""), (2, [3.0, 1.0], 0, ""), (3, [2.0, 7.0], 0, ""), (4, [5.0], 0, ""), (5, [6.5], 0, ""), (6, [1.0] * 3, 0, "")], tmp_path)).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in mixed) == [(1, 1, 3), (1, 2, 3), (2, 1, 3), (2, 2, 3), (3, 1, 3), (3, 2, 3), (4, 1, 2), (5, 1, 2)]
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty) == [] and prepared(empty, "vec_id", "embedding", 1, 0).count() == 0


def test_fit_reads_every_row(spark):
    rows = spark.range(2000).select(F.col("id").alias("vec_id"), F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("embedding"))
    model = fit(prepared(rows.repartition(6), "vec_id", "embedding", 1, 0), 2)
    assert model.centre.n == 2000 and model.centre.sums == [sum(i % 7 for i in range(2000)), sum(i % 11 for i in range(2000))]
