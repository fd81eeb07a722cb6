"""The automaton against regular expressions, the transformation against a plain one, exact round trips."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimforge.llm import fill_middle
from claimforge.llm.fill_middle import OP12_SQL, Automaton, fill_in_middle, op12_fill_in_middle, restored

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text, seed=1):
    text, h = text or "", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    t = UNITS.findall(text)
    i, j = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", None, None, text
    a, b, c = "".join(t[:i]), "".join(t[i:j]), "".join(t[j:])
    form = "spm" if h4 % 100 < 20 else "psm"
    return len(t), form, len(a), len(b), f"<P>{a}<S>{c}<M>{b}" if form == "psm" else f"<S>{c}<P>{a}<M>{b}"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aPSM<>é日😀 \n"), max_size=40), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.integers(1, 9))
def test_automaton_equals_regular_expressions(text, h1, h2, chunk):
    whole, fill_middle.CHUNK = fill_middle.CHUNK, chunk  # cuts, words, characters and sentinels over the ends of chunks
    try:
        n, sentinels, prefix, middle = Automaton().cuts(text.encode(), (h1, h2))
    finally:
        fill_middle.CHUNK = whole
    t = UNITS.findall(text)
    assert n == len(t) and sentinels == len(re.findall("<[PSM]>", text))
    if t and not sentinels:
        i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
        assert (prefix, middle) == (len("".join(t[:i])), len("".join(t[i:j])))


def test_state_forgets():
    """All states agree after as many bytes as the automaton remembers, so that chunks can be read at once."""
    for a in (Automaton(), Automaton(("<fim_prefix>", "<fim_suffix>", "<fim_middle>"))):
        rng = np.random.default_rng(1)
        for _ in range(3000):
            states = np.arange(len(a.follow))
            for b in rng.choice(list(b"<PSM>fim_prefix a\x80\xc3"), a.memory):
                states = a.follow[states, b]
            # what is left of the longest begun sentinel starts inside the bytes read
            assert len(set(states.tolist())) <= 2 and len({tuple(a.follow[s]) for s in states.tolist()}) <= 2


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    texts = [None, "", "a", "\n", "<P>", "x <S y S>", "a<M>b", "héllo wörld", "日本語です。", "😀😀 a", "no > sentinel <", "é combining", "x" * 1_200_000, "日" * 400_000, "ab, " * 300_000]
    texts += ["".join(rng.choice(list("ab cé<PSM>日\n."), int(rng.integers(1, 60)))) for _ in range(300)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "without an id"), (7, "repeated"), (7, "repeated")]


def test_equals_plain_transformation(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("odd `name.x", F.lit(2)).withColumn("Output", F.lit(0))
    made = fill_in_middle(df).withColumn("back", restored(F.col("output"), F.col("form")))
    assert "odd `name.x" in made.columns and len(made.columns) == 9
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect()), key=str)
    assert got == sorted(((i, *plain(i, t), t or "") for i, t in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_parameters(spark):
    df = spark.createDataFrame([(i, "some text here") for i in range(50)], "doc_id long, text string")
    marks = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")
    made = fill_in_middle(df, seed=9, plain=0, suffix_first=100, sentinels=marks).withColumn("back", restored(F.col("output"), F.col("form"), marks)).collect()
    assert {r.form for r in made} == {"spm"} and all(r.back == r.text and r.output.startswith("<fim_suffix>") for r in made)
    assert [r.form for r in fill_in_middle(spark.createDataFrame([(1, "a <fim_middle> b")], "doc_id long, text string"), plain=0, sentinels=marks).collect()] == ["plain"]
    assert fill_in_middle(df.limit(0)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    df = op12_fill_in_middle(spark, sf)
    assert sorted(map(tuple, df.collect())) == sorted(con.sql(OP12_SQL).fetchall()) and con.sql(OP12_SQL).columns == df.columns
