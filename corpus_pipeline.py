"""The corpus pipeline: the stages that turn raw documents into packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. All but the
last return the columns of ``documents``; the last returns the places of token pieces in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.common import discard, quoted, store, tag
from claimforge.llm.jaccard_join import one_of_each
from claimforge.llm.line_dedup import dedup_lines
from claimforge.llm.mixing import mixed_documents
from claimforge.llm.packing import pack
from claimforge.llm.toxicity import scored_rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from labels outside the held-out fold, rejects go.

    A null or empty text is scored as a text without features; long texts are scored whole. Rows alike
    go or stay together. Without labels of both classes all score alike. An empty table stays empty.
    Further columns of any names stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return scored_rows(docs, labels).filter("score < 0.5").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents all of whose words were in such lines; ``n_chars`` follows the text.

    Null, empty and blank texts stay. Of equal lines the one of the least id stays, a null id being the
    least, then that of the least number. Rows alike in id and text are one document and end alike. Lines
    of any length are compared whole. An empty table stays empty. Further columns of any names stay.
    """
    n_lines, removed = tag("n_lines"), tag("removed")
    cut = dedup_lines(docs, names=(n_lines, removed))
    emptied = (F.size(removed) > 0) & ~F.col("text").rlike(r"\S")
    left = cut.filter(~F.coalesce(emptied, F.lit(False)))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*map(quoted, docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id, a null id being the greatest.

    Texts without words (null, empty, blank) all stay. Of rows alike in id and text one stays. Long texts
    are compared whole. An empty table stays empty. Further columns of any names stay.
    """
    return one_of_each(docs, one_row=True).select(*map(quoted, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that sources come near their target weights.

    A null source is a source of its own, a null id is drawn for as an empty one, rows that share an id
    are repeated alike. A document of a source without words goes. An empty table stays empty. Further
    columns of any names stay.
    """
    return mixed_documents(docs).select(*map(quoted, docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens.

    A null or empty text is its end token alone. Repeated rows are packed row by row, also without an id.
    Longer texts are cut into pieces of 2048. An empty table gives none. Other columns are not carried.
    """
    return pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the learnt and the fuzzy stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = store(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)  # only what this run has stored
        docs = made
    return docs
