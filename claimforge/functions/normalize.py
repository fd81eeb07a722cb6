"""Normalising text: identifiers, categories, places, contacts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of provinces and territories, letters only, by code.
PROVINCE_SPELLINGS = {
    "SK": ("sk", "sask", "saskatchewan"),
    "AB": ("ab", "alta", "alberta"),
    "MB": ("mb", "man", "manitoba"),
    "ON": ("on", "ontario"),
    "BC": ("bc", "britishcolumbia"),
    "NS": ("ns", "novascotia"),
    "PE": ("pe", "pei", "princeedwardisland"),
    "NL": ("nl", "newfoundland", "newfoundlandandlabrador"),
    "YT": ("yt", "yukon"),
    "NT": ("nt", "northwestterritories"),
    "QC": ("qc", "quebec"),
    "NB": ("nb", "newbrunswick"),
    "NU": ("nu", "nunavut"),
}
# First letters of postal codes by province.
POSTAL_LETTERS = {"SK": "S", "AB": "T", "MB": "R", "ON": "KLMNP", "BC": "V", "NS": "B", "PE": "C", "NL": "A", "YT": "Y", "NT": "X", "QC": "GHJ", "NB": "E"}
# Spellings of genders.
GENDER_SPELLINGS = {"F": ("f", "female"), "M": ("m", "male"), "X": ("x", "nonbinary")}


def _lookup(spellings: dict[str, tuple[str, ...] | str], key: Column) -> Column:
    pairs = [F.lit(x) for code, values in spellings.items() for v in values for x in (v, code)]
    return F.try_element_at(F.create_map(*pairs), key)


def clean_text(c: Column) -> Column:
    """Spaces at both ends go; what is then empty is null. Tabs and newlines are no spaces."""
    trimmed = F.btrim(c, F.lit(" "))
    return F.when(trimmed != "", trimmed)


def normalize_id(c: Column) -> Column:
    return F.upper(clean_text(c))


def normalize_category(c: Column) -> Column:
    """Lower case, with runs of white space and hyphens as one underscore."""
    return F.regexp_replace(F.lower(clean_text(c)), r"[\s-]+", "_")


def normalize_province(c: Column) -> Column:
    """The code of a known spelling, else the cleaned text in upper case."""
    letters = F.regexp_replace(F.lower(clean_text(c)), "[^a-z]", "")
    return F.coalesce(_lookup(PROVINCE_SPELLINGS, letters), F.upper(clean_text(c)))


def normalize_gender(c: Column) -> Column:
    letters = F.regexp_replace(F.lower(clean_text(c)), "[^a-z]", "")
    return F.coalesce(_lookup(GENDER_SPELLINGS, letters), F.upper(clean_text(c)))


def normalize_postal(c: Column) -> Column:
    """``A9A 9A9`` if the characters fit that pattern, else the cleaned text in upper case."""
    packed = F.upper(F.regexp_replace(clean_text(c), r"\s+", ""))
    spaced = F.concat(F.substring(packed, 1, 3), F.lit(" "), F.substring(packed, 4, 3))
    return F.when(packed.rlike("^[A-Z][0-9][A-Z][0-9][A-Z][0-9]$"), spaced).otherwise(F.upper(clean_text(c)))


def normalize_phone(c: Column) -> Column:
    """North American numbers as ``+1`` and ten digits; null without digits; else the cleaned text."""
    digits = F.regexp_replace(clean_text(c), "[^0-9]", "")
    return (
        F.when(F.length(digits) == 10, F.concat(F.lit("+1"), digits))
        .when((F.length(digits) == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits))
        .when(F.length(digits) > 0, clean_text(c))
    )


def postal_province(postal: Column, city: Column) -> Column:
    """The province of a postal code's first letter; X is Nunavut in Iqaluit."""
    letter = F.substring(normalize_postal(postal), 1, 1)
    far_north = (letter == "X") & (F.lower(clean_text(city)) == "iqaluit")
    return F.when(far_north, F.lit("NU")).otherwise(_lookup(POSTAL_LETTERS, letter))


def initcap_words(c: Column) -> Column:
    """Upper case after every character that is no letter or digit (``St. John'S``), lower case elsewhere.

    A mark is put before each such character's successor, the text is split there and capitalised.
    """
    parts = F.split(F.lower(c), r"(?<=[^\p{L}\p{N}])")
    capital = lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))
    return F.array_join(F.transform(parts, capital), "")
