import random

from claimforge.llm.jaccard_join import near_duplicates, one_of_each


def brute(rows):
    sets = {}
    for k, (i, t) in enumerate(rows):
        w = (t or "").lower().split()
        sets[k] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    n = [0] * len(rows)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                n[a] += 1
                n[b] += 1
                p, q = top(rows[a][0]), top(rows[b][0])
                up[max(p, q)] = min(p, q)
    return sorted((i, top(i), n[k]) for k, (i, _) in enumerate(rows))


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice((3, 8, 60, 200)))]
        for _ in range(rng.choice((1, 2, 5, 40))):
            t = list(base)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "one two"), (i + 4, "One  two"), (i + 5, "x y z " * 9000), (i + 6, "x y z " * 9000)]


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, node int")
    for block in (256, 7):
        got = sorted(tuple(r) for r in near_duplicates(df, block=block).collect())
        assert got == brute(rows)
    kept = {r.doc_id for r in one_of_each(df).collect()}
    assert kept == {c for _, c, _ in brute(rows)}


def test_odd_rows(spark):
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 0), (2, "a b c d e f", 0), (None, "a b c d e f", 0), (3, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, root int")
    assert sorted(tuple(r) for r in near_duplicates(df).collect()) == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]
    assert one_of_each(df).count() == 4
    assert near_duplicates(df.limit(0)).count() == 0 and one_of_each(df.limit(0)).count() == 0


def test_rows_go_by_id_and_text(spark):
    """Id 7 repeats: its copy of A goes and its other text stays; without ids and repeated, one row of a class stays."""
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    rows = [(3, a), (7, a), (7, b), (None, a), (None, a), (9, c), (9, c), (None, "s t u v w x"), (None, "s t u v w x"), (4, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in one_of_each(df).collect() if r.doc_id in (3, 7)) == [(3, a), (7, b)]
    kept = [tuple(r) for r in one_of_each(df, one_row=True).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(3, a), (7, b), (9, c), (None, "s t u v w x"), (4, None), (None, "")]))
    got = [tuple(r) for r in near_duplicates(df, nulls=True).collect()]
    want = [(3, 3, 3), (7, 3, 3), (7, 7, 0), (None, 3, 3), (None, 3, 3), (9, 9, 1), (9, 9, 1), (None, None, 1), (None, None, 1), (4, 4, 0), (None, None, 0)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_linked_texts_without_ids(spark):
    """Texts that only rows with a null id have are compared as well."""
    words = [f"w{i}" for i in range(100)]
    near = " ".join(words[:-1] + ["x"])
    df = spark.createDataFrame([(None, " ".join(words)), (None, near), (None, near), (2, " ".join(words[:-2] + ["y", "z"]))], "doc_id long, text string")
    assert sorted(map(str, (tuple(r) for r in near_duplicates(df, nulls=True).collect()))) == sorted(map(str, [(None, 2, 3)] * 3 + [(2, 2, 3)]))
    assert [r.doc_id for r in one_of_each(df, one_row=True).collect()] == [2]
