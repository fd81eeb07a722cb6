"""Table changes as new states: upserts, rebuilt partitions, replaced children."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose keys are not among them."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti").select(*new.columns))


def rebuild(old: DataFrame, new: DataFrame, part: str, value) -> DataFrame:
    """``old`` without one value of a partitioning column, and ``new`` in its place."""
    return old.filter(~old[part].eqNullSafe(value)).unionByName(new)


def replace_children(old: DataFrame, new: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children of all touched parents go, also if there are no new ones for them.

    Tasks hold the keys of parents and stream the children: a sort of the children grew with the table.
    """
    touched = parents.select(key).distinct().hint("shuffle_hash")
    return old.join(touched, key, "left_anti").select(*new.columns).unionByName(new)
