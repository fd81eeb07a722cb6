"""Matching without pairs: counts in a trailing range of days, the nearest row in time, the best row alike.

Each of these is a self-join or a join with an inequality by its definition. Here it is a sort of the rows, or a
least value for each key, so that the work is linear in the rows of a key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of days in a bucket: with 8, an eighth of the rows is copied to the next bucket too.
RANGES = 8


def _tags(n: int) -> list[str]:
    """Column names that no table has."""
    mark = uuid.uuid4().hex
    return [f"c{i}_{mark}" for i in range(n)]


def rolling_count(df: DataFrame, keys: list[str], day: str, days: int, name: str) -> DataFrame:
    """Add the number of rows with the same keys in the ``days`` days that end with the row's own.

    The rows of a key are dealt to buckets of days, and the last days of a bucket go to the next one as well, so that
    each bucket counts on its own: one shuffle, and a key with many rows is many tasks. Rows without a key or day count none.
    """
    at, bucket = _tags(2)
    width = RANGES * days
    home, last = F.floor(F.col(at) / width), F.floor((F.col(at) + days - 1) / width)
    dealt = df.withColumn(at, F.datediff(F.col(day), F.lit("1970-01-01"))).withColumn(bucket, F.explode(F.when(home < last, F.array(home, last)).otherwise(F.array(home))))
    trailing = Window.partitionBy(*keys, bucket).orderBy(at).rangeBetween(1 - days, 0)
    counted = dealt.withColumn(name, F.count("*").over(trailing)).filter(F.col(bucket).eqNullSafe(home))
    known = reduce(lambda a, b: a & b, (F.col(x).isNotNull() for x in [*keys, day]))
    return counted.withColumn(name, F.when(known, F.col(name)).otherwise(0)).drop(at, bucket)


def nearest_by_date(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, values: list[str], id_columns: list[str], how: str = "inner") -> DataFrame:
    """For each left row the values of the right row nearest in time, and ``days`` between them.

    Ties go to the earlier day and then to the least values. Both sides are put in one order of a key's days: the last
    right row up to a left one and the first from it on are running values of that order, forwards and backwards, and the
    nearer one wins. Left rows without a match go with ``inner`` and have nulls with ``left``.
    """
    at, row, ids, best, before, after, *own = _tags(6 + len(keys))
    as_own = [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]
    nothing = lambda df, columns: F.lit(None).cast(df.select(F.struct(*columns)).schema[0].dataType)
    asked = left.select(*as_own, F.col(left_day).cast("date").alias(at), F.struct(*id_columns).alias(ids), nothing(right, values).alias(row))
    found = right.filter(F.col(right_day).isNotNull()).select(*as_own, F.col(right_day).cast("date").alias(at), nothing(left, id_columns).alias(ids), F.struct(*values).alias(row))
    here = F.when(F.col(row).isNotNull(), F.struct(F.col(at).alias("day"), F.col(row).alias("row")))
    # on a day right rows come before left ones, the least of them last
    running = lambda first: F.last(here, ignorenulls=True).over(Window.partitionBy(*own).orderBy(first, F.col(ids).isNotNull(), F.desc(row)).rowsBetween(Window.unboundedPreceding, 0))
    sides = asked.unionByName(found).withColumn(before, running(F.asc(at))).withColumn(after, running(F.desc(at))).filter(F.col(ids).isNotNull())
    known = reduce(lambda a, b: a & b, (F.col(x).isNotNull() for x in [*own, at]))
    distance = lambda x: F.when(known & F.col(x).isNotNull(), F.struct(F.abs(F.datediff(F.col(x)["day"], F.col(at))).alias("days"), F.col(x)["day"].alias("day"), F.col(x)["row"].alias("row")))
    out = sides.select(ids, F.least(distance(before), distance(after)).alias(best))
    if how == "inner":
        out = out.filter(F.col(best).isNotNull())
    return out.select(*(F.col(ids)[c].alias(c) for c in id_columns), F.col(best)["days"].alias("days"), F.col(best)["day"].alias(right_day), *(F.col(best)["row"][v].alias(v) for v in values))


@dataclass(frozen=True)
class Alike:
    """Rows are alike if they share all ``keys``, none of them null, and differ in ``differ`` (null being a value)."""

    keys: tuple[str, ...]
    differ: str | None = None


def best_alike(rows: DataFrame, order: Column, rules: list[Alike], name: str) -> DataFrame:
    """Add the least ``order`` among a row and all rows alike by one of the ``rules``.

    ``order`` is a struct that tells rows apart. A rule is a least value for each of its keys. Where rows must
    differ in a column, the two least values of different classes do: a row of the first one's class gets the second.
    """
    own, *found = _tags(1 + len(rules))
    first, second, rank, least = _tags(4)
    out = rows.withColumn(own, order)
    base = out
    for rule, column in zip(rules, found, strict=True):
        keys = list(rule.keys)
        known = base.filter(" and ".join(f"`{k}` is not null" for k in keys))
        if rule.differ is None:
            out = out.join(known.groupBy(*keys).agg(F.min(own).alias(column)), keys, "left")
            continue
        classes = known.groupBy(*keys, F.col(rule.differ).alias(first)).agg(F.min(own).alias(least))
        two = classes.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(least))).filter(F.col(rank) <= 2)
        place = lambda n: F.min(F.when(F.col(rank) == n, F.struct(least, first)))  # noqa: E731,B023
        pair = two.groupBy(*keys).agg(place(1).alias(first), place(2).alias(second))
        pick = F.when(F.col(first)[first].eqNullSafe(F.col(rule.differ)), F.col(second)[least]).otherwise(F.col(first)[least])
        out = out.join(pair, keys, "left").withColumn(column, pick).drop(first, second)
    return out.withColumn(name, F.array_min(F.array_compact(F.array(own, *found)))).drop(own, *found).select(*rows.columns, name)
