"""Parsing typed values out of text; whatever does not parse is null and never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimforge.functions.normalize import clean_text

# A source's own way of writing dates, besides ISO and ``Mon D, YYYY``.
CONVENTIONS = {"DMY": (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), "MDY": (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), "YYYYMMDD": (r"^\d{8}$", "yyyyMMdd")}


def parse_amount(c: Column) -> Column:
    """Signed decimals, with ``$``, thousands commas and a trailing ``CAD`` taken off first."""
    plain = F.btrim(F.regexp_replace(F.regexp_replace(clean_text(c), r"(?i)\s*CAD\s*$", ""), "[$,]", ""), F.lit(" "))
    return F.when(plain.rlike(r"^[+-]?[0-9]+([.][0-9]+)?$"), plain).try_cast("decimal(38,10)")


def parse_integer(c: Column) -> Column:
    v = clean_text(c)
    return F.when(v.rlike("^[+-]?[0-9]+$"), v).try_cast("int")


def parse_boolean(c: Column) -> Column:
    v = F.lower(clean_text(c))
    return F.when(v.isin("true", "t", "1"), True).when(v.isin("false", "f", "0"), False)


def parse_date(c: Column, convention: str | None = None) -> Column:
    """ISO first, then the source's convention, then ``Mon D, YYYY``; days that do not exist are null."""
    v = clean_text(c)
    forms = [(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), *([CONVENTIONS[convention]] if convention else []), (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy")]
    return F.coalesce(*(F.try_to_date(F.when(v.rlike(p), F.initcap(v) if "MMM" in f else v), f) for p, f in forms))


def parse_timestamp(c: Column) -> Column:
    return clean_text(c).try_cast("timestamp")


def text_array(v: Column) -> Column:
    """A variant as an array of text: arrays as they are, a string split at commas, else null."""
    kind = F.schema_of_variant(v)
    pieces = F.filter(F.transform(F.split(F.try_variant_get(v, "$", "string"), ","), lambda x: F.btrim(x, F.lit(" "))), lambda x: x != "")
    return F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<string>")).when(kind == "STRING", pieces)
