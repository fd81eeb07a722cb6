"""Reading the test tables with exact money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str | Column) -> Column:
    """Doubles of the test data as exact amounts; sums of these do not depend on the order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")
