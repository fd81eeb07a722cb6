import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

TEXTS = ["alpha beta gamma delta epsilon zeta\nshared line of words that repeats itself here", "one two three four five six seven eight\nshared line of words that repeats itself here", "", None, "  ", "word " * 30_000]
#: Names that operators use or have used inside.
CLASHES = ["p", "body", "score", "predicted", "held_out", "half", "features", "probability", "removed", "n_lines", "dh", "th", "node", "row", "__gone", "__rate", "rate", "seed", "keep"]


def documents(spark, texts=TEXTS, extra=()):
    rows = [(i, t, "en", "ab"[i % 2] if i % 5 else None, len(t or ""), *(float(i) for _ in extra)) for i, t in enumerate(texts, 1)]
    rows += [(None, "text without an id", None, None, 18, *(0.5 for _ in extra)), rows[0], rows[0]]
    fields = "doc_id long, text string, lang string, source string, n_chars int" + "".join(f", `{c}` double" for c in extra)
    return spark.createDataFrame(rows, fields)


@pytest.fixture
def sf_dir(spark, tmp_path):
    toxic = [(i, ("you are a stupid idiot and scum " if i % 3 == 0 else "the garden is calm and green ") * 3 + f"w{i}", "en", "s", 9) for i in range(100, 220)]
    spark.createDataFrame(toxic, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100, 220)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name,stage", cp.STAGES[:-1])
def test_stages_keep_columns_of_any_names(spark, sf_dir, name, stage):
    odd = F.struct(F.lit(1).alias("x y"), F.lit("z").alias("`"))
    docs = documents(spark, extra=CLASHES).withColumn("odd `name", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("nested", odd)
    got = stage(spark, docs, sf_dir)
    assert got.columns == docs.columns
    by_id = {r.doc_id: r for r in docs.collect()}
    rows = got.collect()
    assert rows and all(r[c] == by_id[r.doc_id][c] for r in rows for c in [*CLASHES, "lang", "source"])


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_stages_of_nothing(spark, sf_dir, name, stage):
    docs = documents(spark).limit(0)
    got = stage(spark, docs, sf_dir)
    assert got.count() == 0 and (name == "best_fit_packing" or got.columns == docs.columns)


def test_toxic_documents_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert {r.doc_id for r in cp.drop_toxic(spark, docs, sf_dir).collect()} == {i for i in range(100, 220) if i % 3}


def test_lines_and_emptied_documents_go(spark, sf_dir):
    docs = documents(spark, [*TEXTS, "Shared line of words, that repeats itself here!"])
    got = {}
    for r in cp.drop_repeated_lines(spark, docs, sf_dir).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_chars))
    assert got[2] == [("one two three four five six seven eight", 39)]
    assert len(got[1]) == 3 and {t for t, _ in got[1]} == {TEXTS[0]}
    assert 7 not in got and got[3] == [("", 0)] and got[4] == [(None, None)] and got[5] == [("  ", 2)]


def test_one_of_each_group_stays(spark, sf_dir):
    words = [f"w{i}" for i in range(60)]
    docs = documents(spark, [*TEXTS, " ".join(words), " ".join([*words[:-1], "other"])])
    ids = [r.doc_id for r in cp.keep_one_of_each(spark, docs, sf_dir).collect()]
    assert sorted(ids, key=str) == [1, 2, 3, 4, 5, 6, 7, None]


def test_sources_are_mixed_by_rows(spark, sf_dir):
    docs = documents(spark)
    ids = [r.doc_id for r in cp.mix_sources(spark, docs, sf_dir).collect()]
    assert set(ids) <= {r.doc_id for r in docs.collect()} and ids.count(1) % 3 == 0


def test_whole_run_packs_what_stays(spark, sf_dir):
    got = cp.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} <= {i for i in range(100, 220) if i % 3}
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert ends and max(ends.values()) <= 2048


@pytest.mark.parametrize("char", ["x", "日"])
def test_one_long_run_of_letters_passes_the_first_stage(spark, sf_dir, char):
    docs = documents(spark, [char * 1_000_000, "calm words"])
    assert {r.doc_id for r in cp.drop_toxic(spark, docs, sf_dir).select("doc_id").collect()} == {1, 2, None}
