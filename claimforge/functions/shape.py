"""Ages, bands, calendar flags and array predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends of the age bands, in completed years.
AGE_BANDS = ((35, "Under 35"), (45, "35-44"), (55, "45-54"), (65, "55-64"), (75, "65-74"), (None, "75+"))


def age_years(born: Column, at: Column) -> Column:
    """Completed years; a birthday on 29 February counts from 1 March in other years."""
    return F.timestamp_diff("YEAR", born.cast("timestamp"), at.cast("timestamp"))


def age_band(years: Column) -> Column:
    out = F.when(years.isNull(), F.lit(None).cast("string"))
    for end, name in AGE_BANDS:
        out = out.otherwise(name) if end is None else out.when(years < end, name)
    return out


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def contains_all(held: Column, wanted: Column) -> Column:
    """Whether every wanted element is held; null if either array is null."""
    return F.size(F.array_except(wanted, held)) == 0


def length_or_null(a: Column) -> Column:
    """The length of an array, null for an empty one."""
    return F.when(F.size(a) > 0, F.size(a))
