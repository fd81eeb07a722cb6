"""Text extracts and claim documents as raw rows: every value is text, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.sources.digest import file_hashes, fingerprint
from claimforge.sources.records import read_records

# The headers of the five extracts, in order.
EXTRACTS = {
    "Customer": (
        "customer_id", "first_name", "last_name", "date_of_birth", "gender", "address", "city", "province", "postal_code", "phone", "email",
        "customer_since", "last_updated",
    ),
    "Policy": (
        "policy_id", "customer_id", "policy_type", "plan_name", "coverage_type", "start_date", "end_date", "status", "sales_channel",
        "coverage_amount", "deductible_amount",
    ),
    "Claim": (
        "claim_id", "policy_id", "customer_id", "claim_type", "service_date", "claim_date", "claim_amount", "approved_amount", "claim_status",
        "region",
    ),
    "Claim_Payment": (
        "payment_id", "claim_id", "processing_start_date", "decision_date", "decision_outcome", "payment_date", "payment_amount", "payment_method",
        "payment_status", "transaction_reference", "denial_reason",
    ),
    "Policy_Premium": (
        "premium_id", "policy_id", "customer_id", "premium_amount", "premium_frequency", "age_band", "due_date", "paid_date", "payment_status",
        "payment_method",
    ),
}


def read_extract(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An extract with ``raw_row_id``, the number of each record (the header is 1); a header that differs is an error."""
    return read_records(spark, f"{folder}/{name}.csv", EXTRACTS[name], "raw_row_id")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per JSON file: ``stem``, ``raw_text``, ``payload`` (null if malformed) and ``byte_size``."""
    files = spark.read.text(f"{folder}/json", wholetext=True, pathGlobFilter="*.json")
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("stem"), F.col("value").alias("raw_text"),
        F.try_parse_json("value").alias("payload"), F.col("_metadata.file_size").alias("byte_size"),
    )


def discover(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Raise an error that names every extract missing from ``folder``, and the documents if there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    missing = [f"{n}.csv" for n in names if not fs.exists(path(f"{folder}/{n}.csv"))]
    if not fs.exists(path(f"{folder}/json")) or spark.read.format("binaryFile").options(pathGlobFilter="*.json").load(f"{folder}/json").select("path").isEmpty():
        missing.append("json/*.json")
    if missing:
        raise FileNotFoundError(f"{folder} lacks {', '.join(missing)}")


def batch_fingerprint(spark: SparkSession, folder: str, names: list[str]) -> str:
    """The fingerprint of the extracts and documents of a batch; other files in its folder do not count."""
    paths = [f"{folder}/{n}.csv" for n in names]
    hashes = file_hashes(spark, paths).unionByName(file_hashes(spark, [f"{folder}/json"], pathGlobFilter="*.json"))
    return fingerprint(hashes, folder)
