import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimforge import functions as fn

D = datetime.date
CASES = [
    (fn.clean_text, "  a b ", "a b"), (fn.clean_text, "   ", None), (fn.clean_text, "\t", "\t"),
    (fn.normalize_id, " c00012 ", "C00012"),
    (fn.normalize_category, " Medical - Equipment ", "medical_equipment"),
    (fn.normalize_province, "Sask.", "SK"), (fn.normalize_province, "p.e.i.", "PE"), (fn.normalize_province, "NWT", "NWT"), (fn.normalize_province, " sk ", "SK"), (fn.normalize_province, "", None),
    (fn.normalize_gender, "Female", "F"), (fn.normalize_gender, "non-binary", "X"), (fn.normalize_gender, "other", "OTHER"), (fn.normalize_gender, " ", None),
    (fn.normalize_postal, "s4p3y2", "S4P 3Y2"), (fn.normalize_postal, "S4P 3Y2 ", "S4P 3Y2"), (fn.normalize_postal, "12345", "12345"),
    (fn.normalize_phone, "(306) 555-0142", "+13065550142"), (fn.normalize_phone, "+1 306 555 0142", "+13065550142"), (fn.normalize_phone, "555", "555"), (fn.normalize_phone, "n/a", None),
    (fn.parse_amount, "$1,250.00", Decimal("1250")), (fn.parse_amount, "1500 CAD", Decimal("1500")), (fn.parse_amount, " 12.5 ", Decimal("12.5")), (fn.parse_amount, "-5", Decimal("-5")), (fn.parse_amount, "abc", None), (fn.parse_amount, "1.2.3", None), (fn.parse_amount, "", None),
    (fn.parse_integer, "+12", 12), (fn.parse_integer, "99999999999", None), (fn.parse_integer, "1.0", None),
    (fn.parse_boolean, "T", True), (fn.parse_boolean, "0", False), (fn.parse_boolean, "yes", None),
    (fn.initcap_words, "st. john's", "St. John'S"), (fn.initcap_words, "ANNE-marie", "Anne-Marie"), (fn.initcap_words, "", ""),
    (fn.parse_timestamp, "2024-03-01T10:00:00+02:00", datetime.datetime(2024, 3, 1, 8)), (fn.parse_timestamp, "soon", None),
]
DATES = [
    ("2024-02-30", None, None), ("2024-02-29", None, D(2024, 2, 29)), ("31/02/2024", "DMY", None), ("02/03/2024", "DMY", D(2024, 3, 2)), ("02/03/2024", "MDY", D(2024, 2, 3)),
    ("20240203", "YYYYMMDD", D(2024, 2, 3)), ("Feb 3, 2024", "DMY", D(2024, 2, 3)), ("20240203", "DMY", None), ("", "DMY", None),
]


def test_text_functions(spark):
    df = spark.createDataFrame([(1,)], "x int")
    row = df.select(*(f(F.lit(v)).alias(f"c{i}") for i, (f, v, _) in enumerate(CASES))).first()
    got = [(f.__name__, v, row[i]) for i, (f, v, _) in enumerate(CASES)]
    assert got == [(f.__name__, v, w) for f, v, w in CASES]


def test_dates(spark):
    row = spark.range(1).select(*(fn.parse_date(F.lit(v), c).alias(f"c{i}") for i, (v, c, _) in enumerate(DATES))).first()
    assert list(row) == [w for _, _, w in DATES]


@pytest.mark.parametrize("postal,city,want", [("X0A 0H0", " Iqaluit", "NU"), ("X1A 2B3", "Yellowknife", "NT"), ("H2X1Y4", None, "QC"), (None, "x", None), ("9", "x", None)])
def test_postal_province(spark, postal, city, want):
    assert spark.range(1).select(fn.postal_province(F.lit(postal).cast("string"), F.lit(city).cast("string"))).first()[0] == want


def test_shapes(spark):
    row = spark.range(1).select(
        fn.age_years(F.lit(D(2004, 2, 29)), F.lit(D(2022, 2, 28))), fn.age_years(F.lit(D(2004, 2, 29)), F.lit(D(2022, 3, 1))),
        fn.age_band(F.lit(34)), fn.age_band(F.lit(75)), fn.age_band(F.lit(None).cast("int")),
        fn.contains_all(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"))), fn.contains_all(F.array(F.lit("a")), F.array(F.lit("b"))), fn.contains_all(F.lit(None).cast("array<string>"), F.array(F.lit("b"))),
        fn.length_or_null(F.array().cast("array<int>")), fn.is_weekend(F.lit(D(2024, 3, 2))), fn.is_weekend(F.lit(D(2024, 3, 4))),
    ).first()
    assert list(row) == [17, 18, "Under 35", "75+", None, True, False, None, None, True, False]


def test_text_array(spark):
    df = spark.createDataFrame([('["a","b"]',), ('"a, b,,"',), ("[]",), ("5",), (None,)], "j string").select(fn.text_array(F.try_parse_json("j")).alias("a"))
    assert [r.a for r in df.collect()] == [["a", "b"], ["a", "b"], [], None, None]
