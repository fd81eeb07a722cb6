"""A folder that all executors share, for tables that are used several times while a batch is loaded."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a local session without it gets a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="claimforge-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Workspace:
    """Writes tables once and reads them back, which keeps plans small and costs a lost executor a re-read.

    Everything is deleted together when the batch is done.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/batch-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
