import random
import re

import pytest

from claimforge.llm.line_dedup import dedup_lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def normal(line):
    return " ".join(re.split(r"[\s!-/:-@\[-`{-~]+", line.lower().strip(" \t\r\n\x0b\x0c!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")))


def met(a, b):
    """Whether two signatures agree on two blocks and are within the distance."""
    from claimforge.llm import line_dedup as m

    differ = [(x ^ y) & (2**64 - 1) for x, y in zip(a, b)]
    blocks = [differ[k // m.IN_LOW] >> (k % m.IN_LOW * m.WIDTH) & (2**m.WIDTH - 1) for k in range(m.N_BLOCKS)]
    return sum(x == 0 for x in blocks) >= 2 and sum(x.bit_count() for x in differ) <= m.DISTANCE


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 10))) for _ in range(500)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice((2, 6, 30, 60)))] for _ in range(40)]
    rows = []
    for i in range(60):
        out = []
        for _ in range(rng.randrange(1, 8)):
            w = list(rng.choice(bases))
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] += rng.choice(("x", "", "zq"))
            out.append(rng.choice((" ".join(w) + ".", " ".join(w).upper())))
        rows.append((i, "\n".join(out)))
    return rows


def test_equals_brute_force(spark):
    """All pairs of normalised lines that agree on two blocks of the signatures that the operator computes."""
    from claimforge.llm import line_dedup as m

    rows = corpus()
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, pos int")
    signed = m.line_rows(df, "doc_id", "text").collect()
    sims = {r.node: (r.low, r.high) for r in signed}
    where = {}
    for r in signed:
        where.setdefault(r.node, []).append((r.doc_id, r.pos))
    text = {node: normal(dict(rows)[min(at)[0]].split("\n")[min(at)[1]]) for node, at in where.items()}
    up = {n: n for n in sims}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    near = 0
    for a in sims:
        for b in sims:
            if a < b and met(sims[a], sims[b]):
                x, y = text[a], text[b]
                if edits(x, y) <= 0.2 * max(len(x), len(y)):
                    up[top(b)] = top(a)
                    near += 1
    assert near > 10
    keep = {}
    for n, at in where.items():
        keep[top(n)] = min(min(at), keep.get(top(n), min(at)))
    want = {(i, p) for n, at in where.items() for i, p in at if (i, p) != keep[top(n)]}
    got = dedup_lines(df).collect()
    assert {(r.doc_id, p) for r in got for p in r.removed} == want
    for r in got:
        lines = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in r.removed) and r.n_lines == len(lines) and r.source == "s" and r.pos == 1


def test_odd_rows(spark):
    long = "word " * 6_000
    rows = [(1, "Alpha beta.\n\n!!!\nalpha  BETA"), (2, None), (3, ""), (4, "alpha beta\nnew one"), (4, "alpha beta\nnew one"), (5, long + "\n" + long + "end"), (None, "new one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_lines): r for r in dedup_lines(df).collect()}
    assert got[1, 4].text == "Alpha beta.\n\n!!!" and got[1, 4].removed == [3]
    assert got[2, 0].text is None and got[3, 1].text == "" and got[None, 1].text == "new one"
    assert got[4, 2].removed == [0, 1] and got[4, 2].text == ""
    assert got[5, 2].removed == [1]
    assert dedup_lines(df).count() == len(rows) and dedup_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("a,b,ok", [("abcdefghij", "abcdefghxy", True), ("abcdefghij", "abcdefgxyz", False), ("", "", True), ("a " * 3000, "a " * 2400, True), ("a " * 3000, "a " * 2398, False)])
def test_edit_similarity(a, b, ok):
    from claimforge.llm.line_dedup import similar

    assert similar(a, b, 0.8) is ok


def test_similar_equals_the_edit_table():
    from claimforge.llm.line_dedup import similar

    rng = random.Random(6)
    for _ in range(1500):
        a = [rng.choice("abcé🙂 ") for _ in range(rng.randrange(0, 40))]
        b = list(a) if rng.random() < 0.8 else [rng.choice("abcé🙂 ") for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 9)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randrange(2)] = rng.choice(("", "x", "ab"))
        s = rng.choice((0.5, 0.8, 0.9))
        assert similar("".join(a), "".join(b), s) is (edits(a, b) <= (1 - s) * max(len(a), len(b)) + 1e-9)


def test_repeated_rows_sign_as_one(spark):
    """A row given three times, also without an id, has the signature of one, and still meets a near copy."""
    from claimforge.llm import line_dedup as m

    rng = random.Random(8)
    line = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300))
    near = line[:-1] + "z"
    schema = "doc_id long, text string"
    once, again = ({(r.doc_id, r.node): (r.chars, r.low, r.high) for r in m.line_rows(spark.createDataFrame(rows, schema), "doc_id", "text").collect()} for rows in ([(2, line), (None, line)], [(2, line)] * 3 + [(None, line)] * 2))
    assert once == again and {c for c, _, _ in once.values()} == {len(line)}
    sims = [(r.low, r.high) for r in m.line_rows(spark.createDataFrame([(1, near), (2, line)], schema), "doc_id", "text").collect()]
    assert met(*sims)
    got = dedup_lines(spark.createDataFrame([(1, near)] + [(2, line)] * 3, schema)).collect()
    assert sorted((r.doc_id, r.removed) for r in got) == [(1, [])] + [(2, [0])] * 3


def test_long_lines_are_compared_by_character():
    """Around and far beyond 300 characters: a typo in every fourth word, and few but long other words."""
    from claimforge.llm.line_dedup import similar

    for n in (40, 80, 3000):
        words = [f"word{k % 10}" for k in range(n)]
        assert similar(" ".join(words), " ".join("x" + w[1:] if k % 4 == 0 else w for k, w in enumerate(words)), 0.8)
        assert not similar(" ".join(words), " ".join("yz" * 9 if k % 6 == 0 else w for k, w in enumerate(words)), 0.8)


def test_signatures_equal_a_plain_count():
    """Bits set in more than half of the hashes of all 6-grams, also of a line that many bytes cannot count."""
    from claimforge.llm import line_dedup as m

    rng = random.Random(2)
    lines = [bytes(rng.choice(b"abc de") for _ in range(n)) for n in (1, 4, 5, 254, 255, 256, 1000, 70_000)] + ["日本語 été".encode()]
    whole = 2**64 - 1

    def mix(h):
        h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 & whole
        return h ^ h >> 32

    for line, low, high in zip(lines, *m.simhashes(lines), strict=True):
        counts = [0] * 84
        for i in range(len(line)):
            h = mix(int.from_bytes((line[i : i + 6] + b"\n" * 5)[:6], "little") + 1) >> 48
            h = mix((h + 1) * 0x9E3779B97F4A7C15 & whole) | (mix((h + 1) * 0xFF51AFD7ED558CCD & whole) & 2**24 - 1) << 64
            for k in range(84):
                counts[k] += h >> k & 1
        sig = sum((2 * c > len(line)) << k for k, c in enumerate(counts))
        assert (int(low), int(high)) == (sig & 2**56 - 1, sig >> 56)


def test_lines_of_one_word_and_short_lines(spark):
    """A long line without spaces joins by a typo; a line with no room for an edit only if it is equal."""
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefghijklmnop") for _ in range(2000))
    rows = [(1, line), (2, line[:900] + "z" + line[901:]), (3, "abcd"), (4, "abce"), (5, "abcd!")]
    got = {r.doc_id: r.removed for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0], 3: [], 4: [], 5: [0]}


@pytest.mark.parametrize("cut", [1, 3, 7, 1000])
def test_buckets_of_any_size_over_any_batches(spark, cut):
    """Streams cut into batches anywhere give all pairs of small buckets, and all nodes of large ones."""
    from claimforge.llm import line_dedup as m

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", cut)
    try:
        rng = random.Random(4)
        sigs = [rng.getrandbits(56) for _ in range(6)]
        rows, node = [], 0
        for sig, n in zip(sigs, (1, 2, m.PREVIOUS + 1, m.PREVIOUS + 2, 40, 3)):
            for _ in range(n):
                node += 1
                rows.append((node, sig ^ 1 << 55 if node % 7 == 0 else sig, sig >> 30, 100))
        got = m.bucket_rows(spark.createDataFrame(rows, "node long, low long, high long, chars int"), 0.8, (0,)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    a = 4 + m.PREVIOUS + 1
    b = a + m.PREVIOUS + 2
    groups = [range(1, 2), range(2, 4), range(4, a), range(a, b), range(b, b + 40), range(b + 40, b + 43)]
    assert sorted(r.node for r in got if r.mate is None) == [*groups[3], *groups[4]]
    pairs = {(min(r.node, r.mate), max(r.node, r.mate)) for r in got if r.mate is not None}
    want = {(a, b) for g in groups for b in g for a in g if a < b and (b - a <= m.PREVIOUS or a == g[0])}
    assert pairs == want


def test_a_pair_is_met_in_one_table_only(spark):
    """Nodes alike in all blocks or some of them are pairs once, not in each of the tables; twice the nodes give twice the rows."""
    from claimforge.llm import line_dedup as m

    rng = random.Random(5)
    sizes = {}
    for n in (100, 200):
        low, high = rng.getrandbits(m.IN_LOW * m.WIDTH), rng.getrandbits((m.N_BLOCKS - m.IN_LOW) * m.WIDTH)
        rows = [(i, low ^ (1 << rng.randrange(2 * m.WIDTH) if i % 3 == 0 else 0), high, 100) for i in range(n)]
        df = spark.createDataFrame(rows, "node long, low long, high long, chars int")
        found = [(r.node, r.mate) for r in m.bucket_rows(df, 0.8, tuple(range(len(m.TABLES)))).collect()]
        pairs = [p for p in found if p[1] is not None]
        assert len(pairs) == len(set(pairs))
        assert {i for p in pairs for i in p} == set(range(n))
        sizes[n] = len(found)
    assert sizes[200] < 2.2 * sizes[100]
