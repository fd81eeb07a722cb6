"""Checking what must hold of tables: row conditions, unique keys, references; each kind for all tables at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(checks: dict[str, str]) -> list[Column]:
    """An aggregate for each check that counts the rows for which its SQL condition is false; unknown is not broken."""
    return [F.count_if(~F.expr(holds)).alias(check) for check, holds in checks.items()]


def broken_rows(tables: dict[str, DataFrame], checks: dict[str, dict[str, str]]) -> DataFrame:
    """``what`` and ``rows`` of every broken row check: one aggregation without a shuffle of rows for each table."""
    parts = []
    for name, own in checks.items():
        counts = tables[name].agg(*row_counts(own))
        pairs = F.array(*(F.struct(F.lit(f"{name}: {check}").alias("what"), F.col(f"`{check}`").alias("rows")) for check in own))
        parts.append(counts.select(F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts).filter("rows > 0")


def repeated_keys(tables: list[tuple[str, tuple[str, ...], DataFrame]]) -> DataFrame:
    """``what`` and ``rows``: keys that occur more than once, of all given (name, key, table), by one grouping of all keys. Keys with a null are none."""
    keys = []
    for name, columns, rows in tables:
        known = rows.filter(" and ".join(f"`{k}` is not null" for k in columns))
        keys.append(known.select(F.lit(f"{name}: {', '.join(columns)} is unique").alias("what"), F.to_json(F.array(*(F.col(k).cast("string") for k in columns))).alias("key")))
    twice = reduce(DataFrame.unionByName, keys).groupBy("what", "key").count().filter("count > 1")
    return twice.groupBy("what").agg(F.count("*").alias("rows"))


def orphans(references: list[tuple[str, str, str, DataFrame, DataFrame]]) -> DataFrame:
    """``what`` and ``rows``: rows of (child, parent, key, children, parents) whose key no parent has; null keys refer to nothing."""
    parts = []
    for child, parent, key, rows, parents in references:
        alone = rows.select(F.col(key).alias("key")).filter("key is not null").join(parents.select(F.col(key).alias("key")), "key", "left_anti")
        parts.append(alone.select(F.lit(f"{child} have {parent}").alias("what")))
    return reduce(DataFrame.unionByName, parts).groupBy("what").agg(F.count("*").alias("rows"))
