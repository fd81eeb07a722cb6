import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimforge.llm import subword
from claimforge.llm.token_counts import counter, token_counts

ALPHABET = list("abcdeirstTHE'  \n\t.,!?019") + ["é", "ß", "日", "本", "🙂", "'re", "'ll", "  ", "\n\n\n", "<|endoftext|>", "\x85", "　", "\x1c", "the "]


def plain(texts):
    t = Tokenizer.from_file(subword.default_path())
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def texts(n, size):
    rng = random.Random(5)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_totals_equal_the_library():
    made = [*texts(600, 60), "a" * 5000, " " * 3000, "'" * 999]
    assert [counter(subword.default_path()).total(t) for t in made] == plain(made)


def test_every_prefix_is_exact():
    dp = counter(subword.default_path())
    for t in texts(60, 40):
        assert dp.prefixes(t) == plain([t[:i] for i in range(len(t) + 1)]), repr(t)


@pytest.mark.parametrize("limit", [0, 1, 5, 12])
def test_truncation_needs_no_encoding(limit):
    dp = counter(subword.default_path())
    for t in texts(80, 40):
        if "<|" in t:
            continue
        counts = plain([t[:i] for i in range(len(t) + 1)])
        assert dp.within(t, limit) == max(i for i, n in enumerate(counts) if n <= limit), repr(t)


def test_ids_equal_the_library():
    made = texts(300, 60)
    t = Tokenizer.from_file(subword.default_path())
    assert [list(subword.encode(subword.default_path(), x)) for x in made] == [e.ids for e in t.encode_batch(made, add_special_tokens=False)]


def test_rows(spark):
    rows = [(1, None, "x", 9), (1, "", "x", 9), (2, "the cat sat", "y", 9), (2, "the cat sat", "y", 9), (None, "a " * 3000, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int")
    got = token_counts(df, limit=4, prefixes=True).orderBy("n_bytes").collect()
    assert [r.n_tokens for r in got] == [0, 0, 3, 3, plain(["a " * 3000])[0]]
    assert [r.over_limit for r in got] == [False, False, False, False, True]
    assert got[2].prefix_tokens[-1] == 3 and got[0].prefix_tokens == [0]
    assert token_counts(df.limit(0)).count() == 0


def test_tables_made_together_equal_those_made_alone():
    dp = counter(subword.default_path())
    rng = random.Random(9)
    pieces = sorted({p for t in texts(400, 60) for p in dp.split.findall(t)} | {" " + "".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 20))) for _ in range(500)})
    dp.tables.clear()
    dp.fill(pieces)
    assert len(dp.tables) > 400 and all(dp.tables[p] == dp.table(p.encode()) for p in pieces)
    assert [dp.tables[p][-1] for p in pieces] == plain(pieces)


def test_chunks_encode_independently():
    dp = counter(subword.default_path())
    made = [*texts(800, 60), "", " ", "a  b", "a   b", "a\n \nb", "  a", "a  "]
    for t in made:
        assert "".join(dp.chunked(t)) == t
        if "<|" not in t:
            assert [p for c in dp.chunked(t) for p in dp.split.findall(c)] == dp.split.findall(t), repr(t)


@pytest.mark.parametrize("limit", [3, 40, 200])
def test_truncation_of_long_texts(limit):
    dp = counter(subword.default_path())
    for t in texts(30, 900):
        if "<|" not in t:
            counts = plain([t[:i] for i in range(len(t) + 1)])
            assert dp.within(t, limit) == max(i for i, n in enumerate(counts) if n <= limit), repr(t)


def test_columns_of_odd_names_and_types_stay(spark):
    df = spark.createDataFrame([(1, "two words")], "doc_id long, text string").withColumn("odd `name", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("nested", F.struct(F.lit(1).alias("x y"), F.lit("z").alias("`")))
    got = token_counts(df, prefixes=True)
    assert got.columns[:5] == df.columns and got.schema["nested"].dataType == df.schema["nested"].dataType
    (row,) = got.collect()
    assert row["odd `name"] == 1 and row["nested"]["x y"] == 1 and row["n_tokens"] == 2
