"""Helpers shared by the corpus operators: stored intermediates, components, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without this setting gets a temporary folder; on a cluster it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="claimforge-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and never a recomputation. Shuffle files
    of the write go as soon as it ends.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/claimforge/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table that :func:`store` made and nothing reads any more."""
    spark = df.sparkSession
    root = f"{work_dir(spark)}/claimforge/"
    for file in df.inputFiles()[:1]:
        folder = file.rsplit("/", 1)[0]
        if "/claimforge/" in folder and root.split(":", 1)[-1].strip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batch in parts of about ``most`` bytes of text, a row at least, with their texts: what Python holds at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(batch):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()
        start = stop


def tag(name: str) -> str:
    """A column name that no table of a user has."""
    return f"{name}_{uuid.uuid4().hex}"


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever characters are in it."""
    return f"`{name.replace('`', '``')}`"


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns ``c0``, ``c1``, ...: what Spark hands to Python by name must have plain names."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def release(spark: SparkSession) -> None:
    """Let the driver free what no plan refers to: Spark deletes shuffle files and broadcasts only after its collector ran."""
    spark.sparkContext._jvm.System.gc()


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null ids give null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as ``(a, b)`` long pairs.

    Alternates large-star and small-star steps until the edge set is a forest of stars, each
    centred on the least id of its component. Every step is a join and an aggregation over the
    edges; nothing is collected. Returns ``(node, root)`` for every node other than a root.
    """
    # an edge (u, v) always has u > v
    e = store(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    seen = mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        nxt = store(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct(),
            "edges",
        )
        now = mark(nxt)
        discard(e)
        e = nxt
        if now == seen:
            release(e.sparkSession)
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
