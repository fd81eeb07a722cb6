import math

from claimforge.llm.mixing import mix, mixed_documents, targets


def water(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        out = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if out[s] > 3 * sizes[s]}
        if not over:
            return out | {s: 3 * sizes[s] for s in capped}
        capped |= over


def test_targets(spark):
    for sizes in ({"a": 10, "b": 500, "c": 80, None: 7}, {"x": 5}, {"a": 1, "b": 1, "c": 1000, "d": 3, "e": 9}, {"a": 0, "b": 4}):
        got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = water(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want), (got, want)


def test_mix(spark):
    rows = [(i, "w " * (i % 17) if i % 50 else None, ("a", "b", "c", None)[min(3, i % 7 // 2)], i) for i in range(4000)] + [(5, "w w", "a", 0)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix(df).collect()
    assert sorted(got) == sorted(mix(df).collect()) and len(got) == len(rows)
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in got)
    for s in ("a", "b", "c", None):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) / mine[0].target - 1) < 0.01
    df = df.selectExpr("*", "1 as rate", "2 as seed", "3 as copies")
    out = mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in got)
    assert mix(df.limit(0)).count() == 0 and mixed_documents(df.limit(0)).count() == 0
