import numpy as np
import pytest

from claimforge.llm.exact_topk import Lists, top_k
from claimforge.llm.multi_index import nearest, traverse


def rows(n, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 0.2, (n, 8)).astype(np.float32)
    v[5] = v[9] = v[20]  # equal vectors
    out = [(i, [float(x) for x in v[i]], i) for i in range(n)]
    out[3] = (3, None, 0)
    out[4] = (4, [0.0] * 8, 0)
    out[6] = (6, [float("nan")] + [0.1] * 7, 0)
    out[7] = (7, [0.1, None] + [0.1] * 6, 0)
    # no id, rows that repeat an id with the same and with another vector, vectors of another length
    return out + [(None, [0.1] * 8, 0), (20, out[20][1], 1), (40, out[41][1], 1), (11, [1.0, 3.0], 0), (60, [2.0, -1.0], 0)]


def usable(data, zeros):
    return [(i, np.array(v)) for i, v, _ in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zeros or any(v))]


def best(data, every, k, score):
    """Rows by brute force; every row is a query of its own and a candidate of all others of its length."""
    out = []
    for at, (q, x) in enumerate(data):
        if q % every == 0:
            found = sorted((score(x, v), i) for n, (i, v) in enumerate(data) if n != at and len(v) == len(x))[:k]
            out += [(q, r, i, s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16_384, 37])
def test_top_k_equals_brute_force(spark, block):
    data = rows(400)
    whole = [(i, np.floor(64 * v).astype(int)) for i, v in usable(data, True)]
    want = [(q, r, i, -s) for q, r, i, s in best(whole, 20, 20, lambda x, v: -int(x @ v))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank int")
    assert sorted(tuple(r) for r in top_k(df, candidates=block, queries=8).collect()) == sorted(want)


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0), (20, [3.0, -1.0], 0)], "vec_id long, embedding array<float>, rank int")
    assert sorted(tuple(r) for r in top_k(df).collect()) == [(0, 1, 20, 64 * 64), (20, 1, 0, 64 * 64)]
    assert top_k(df.limit(0)).count() == 0 and nearest(df.limit(0)).count() == 0 and nearest(df.filter("vec_id = 0")).count() == 0


def test_large_components_are_exact(spark):
    """Products beyond what doubles hold, sums within a long and beyond it."""
    data = [(0, [2.0**40, 3.0, -(2.0**33)], 0), (1, [2.0**12, 1.0, 2.0**3], 0), (2, [2.0**12, 2.0, 2.0**3], 0), (3, [2.0**60, 0.0, 0.0], 0), (4, [-1e300, 1.0, 0.0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, rank int")
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v, _ in data}
    scores = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(whole[0], w, strict=True)))), i) for i, w in whole.items() if i)
    got = sorted(tuple(r) for r in top_k(df).collect())
    assert got == [(0, r, i, -s) for r, (s, i) in enumerate(scores, 1)]


def distance(x, v):
    return float(np.sqrt(((v - x) ** 2).sum()))


@pytest.mark.parametrize("n", [60, 400, 2000, 6000])
def test_recall(spark, n):
    """At the shipped share, for unclustered vectors and tables of every size."""
    data = rows(n, seed=2)
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank int")
    every = max(20, n // 100)
    got = [tuple(r) for r in nearest(df, every=every).collect()]
    want = best(usable(data, False), every, 10, distance)
    near = {(q, i): s for q, _, i, s in want}
    hits = [(q, i, s) for q, _, i, s in got if (q, i) in near]
    assert sorted(g[:2] for g in got) == [w[:2] for w in want] and len(hits) >= 0.9 * len(want)
    assert all(s >= 0 for *_, s in hits)


def test_all_pairs_give_the_exact_result(spark):
    data = rows(400)
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank int")
    got, want = sorted(tuple(r) for r in nearest(df, every=20, share=1.0).collect()), best(usable(data, False), 20, 10, distance)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-12)


def test_traverse_goes_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(7)
    got = traverse(a, b, np.ones(49, int), 49)
    assert got == sorted(range(49), key=lambda p: (a[p // 7] + b[p % 7]))
    assert traverse(a, b, np.ones(49, int), 5) == got[:5]


def test_queries_meet_parts_in_groups_of_bounded_size(spark):
    """Many small groups give what one group gives, and the plan deals work out by group as well."""
    df = spark.createDataFrame(rows(3000, seed=4), "vec_id long, embedding array<float>, rank int")
    one, many = (nearest(df, every=10, queries=n) for n in (10_000, 16))
    assert sorted(tuple(r) for r in one.collect()) == sorted(tuple(r) for r in many.collect())
    plan = many._jdf.queryExecution().analyzed().toString()
    assert next(x for x in plan.splitlines() if "FlatMapCoGroupsInArrow" in x).count("group#") >= 2


def test_bounds_hold_what_has_been_read():
    """At every depth the lower and upper bounds enclose the scores, from entries that were read alone."""
    rng = np.random.default_rng(3)
    v, q = np.floor(64 * rng.normal(0, 1, (50, 6))), np.floor(64 * rng.normal(0, 1, (4, 6)))
    lists = Lists(np.arange(50), np.arange(50), v)
    for depth in (1, 7, 30, 50):
        low = high = 0
        for reader, weights in zip(lists.ends, (np.maximum(q, 0), np.minimum(q, 0)), strict=True):
            reader.read_to(depth)
            assert (reader.read.sum(axis=0) == depth).all() and not reader.known[~reader.read].any()
            parts = reader.bounds(weights)
            low, high = low + parts[0], high + parts[1]
        assert (low <= v @ q.T).all() and (v @ q.T <= high).all()
    assert np.array_equal(low, high)
