"""Content hashes of files of any size, and the fingerprint of a batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a file is hashed as one value, by Spark itself.
WHOLE = 64 << 20
CHUNK = 8 << 20


def streamed(path: str, chunk: int = CHUNK) -> str:
    """sha256 of a file that is read in chunks: a task holds one of them."""
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        fs, inside = pafs.LocalFileSystem(), unquote(parts.path)
    else:
        fs, inside = pafs.FileSystem.from_uri(path)
    digest = hashlib.sha256()
    with fs.open_input_stream(inside, buffer_size=0) as stream:
        while block := stream.read(chunk):
            digest.update(block)
    return digest.hexdigest()


def file_hashes(spark: SparkSession, paths: list[str], whole: int = WHOLE, **options: str) -> DataFrame:
    """``path``, ``length`` and ``sha256`` of all files under ``paths``.

    Small files are hashed by Spark's reader, from any store that it knows, and large ones in chunks by tasks of their
    own. The limit on the length reaches the reader, which then never loads the content of a large file. Spark's readers do not see empty files.
    """
    files = spark.read.format("binaryFile").options(**options).load(paths)
    small = files.filter(F.col("length") <= whole).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > whole).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array([streamed(p) for p in batch.column("path").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), hashes], names=["path", "length", "sha256"])

    return small.unionByName(large.mapInArrow(run, "path string, length long, sha256 string"))


def fingerprint(hashes: DataFrame, folder: str) -> str:
    """sha256 over the paths inside ``folder`` and the hashes, in the order of the paths.

    A moved batch has the same one. The sorted lines pass through the driver one partition at a time: a path and a hash for each file.
    """
    inside = F.substring_index("path", f"{folder.rstrip('/').rsplit(':', 1)[-1]}/", -1)
    digest = hashlib.sha256()
    for r in hashes.select(inside.alias("inside"), "sha256").orderBy("inside").toLocalIterator(prefetchPartitions=True):
        digest.update(f"{r['inside']}\0{r['sha256']}\n".encode())
    return digest.hexdigest()
