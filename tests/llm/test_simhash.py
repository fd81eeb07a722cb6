"""Fingerprints by their definition, anchors against all pairs, components against a plain search."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from claimforge.llm.simhash import anchors, fingerprint, links, near_copies


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


TEXTS = [None, "", " \t\n", "one", "Two words", "a b c", "A  b\tC", "ÀÉ straße x y z w", "x" * 300_000, "la " * 70_000, "a b c d e f g h i j", "日本語 の 文 です ね"]


def test_fingerprints_follow_the_definition():
    for t in TEXTS:
        if t is None or len(t) < 1000 or " " not in t:
            assert fingerprint((t or "").encode()) == plain(t)
    long = " ".join(f"w{i * i % 1009}" for i in range(140_000))  # more than two chunks of hashes
    assert fingerprint(long.encode()) == plain(long)


def test_hash_is_sparks(spark):
    (got,) = spark.sql("select xxhash64('a b c')").first()
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_anchors_cover(spark):
    """33 anchors at most within two bits, all of the code, and every pair at two bits or fewer shares one."""
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)] + [0, (1 << 64) - 1, 1 << 63]
    near = [b ^ (1 << i) ^ (1 << j) for b in base[:4] + base[-3:] for i in range(0, 64, 3) for j in range(i, 64, 5)]
    rows = spark.createDataFrame([(signed(x),) for x in {*base, *near}], "fp long")
    sets = {r.fp % (1 << 64): {a % (1 << 64) for a in r.a} for r in rows.select("fp", anchors(F.col("fp")).alias("a")).collect()}

    def syndrome(x):
        s = 0
        for p in range(1, 64):
            s ^= p if x >> (p - 1) & 1 else 0
        return s

    for x, found in sets.items():
        assert len(found) <= 33 and all(syndrome(a) == 0 and (a ^ x).bit_count() <= 2 for a in found)
    close = [(x, y) for x in sets for y in sets if x < y and (x ^ y).bit_count() <= 2]
    assert len(close) > 500 and all(sets[x] & sets[y] for x, y in close)
    got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in links(rows).collect()}
    assert got == {frozenset(p) for p in close}


def test_anchors_are_not_broadcast(spark):
    """Spark sized the 33 rows that explode makes of a fingerprint as one row and broadcast them all."""
    plan = links(spark.range(1000).select(F.xxhash64("id").alias("fp")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def components(rows):
    """The least id that each row reaches, by a search over all pairs."""
    fps = [plain(t) for _, t in rows]
    out = []
    for start in fps:
        seen, todo = {start}, [start]
        while todo:
            x = todo.pop()
            new = {y for y in fps if y not in seen and (x ^ y).bit_count() <= 2}
            seen |= new
            todo += new
        out.append(min((i for (i, _), f in zip(rows, fps, strict=True) if f in seen and i is not None), default=None))
    return sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, out, strict=True)), key=str)


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, t) for i, t in enumerate(t for t in TEXTS if t is None or len(t) < 1000)]
    for k in range(12):
        base = [words[i] for i in rng.integers(0, 50, 250)]
        for c in range(1 + k):
            copy = list(base)
            if c:
                copy[int(rng.integers(0, 250))] = f"edit{c}"
            rows.append((1000 - 20 * k - c, " ".join(copy)))
    rows += [rows[20], (None, rows[21][1]), (None, "only here and without an id"), (5000, rows[-1][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a", F.lit(1)).withColumn("odd `name.x", F.lit(2)).withColumn("fp", F.lit("x"))
    got = sorted((tuple(r) for r in near_copies(df).collect()), key=str)
    assert got == components(rows)
    assert len({c for _, _, c in got}) < len({f for _, f, _ in got})  # some link differs in bits


def test_empty_table(spark):
    assert near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
