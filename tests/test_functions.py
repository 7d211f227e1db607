"""Column helpers on the edge values listed for the function library."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import carespark.functions as fx

EDGE = [None, "", "  ", " a ", "0", "20240230", "2024-1-5", "2024-01-05", "garbage", "123456789\n", "1234567890",
        "20240105", "19991340"]


def col_values(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_string(spark):
    got = col_values(spark, EDGE[:4], fx.clean_string)
    assert got == [None, None, None, "a"]


def test_parse_date(spark):
    got = col_values(spark, EDGE, fx.parse_date)
    expect = [None, None, None, None, None, None, None, dt.date(2024, 1, 5), None, None, None,
              dt.date(2024, 1, 5), None]
    assert got == expect


def test_parse_datetime(spark):
    got = col_values(spark, [None, "", "2024-01-05 10:00:00", "garbage"], fx.parse_datetime)
    assert got == [None, None, dt.datetime(2024, 1, 5, 10, 0), None]


def test_amount_defaults_and_strict(spark):
    assert col_values(spark, [None, "", "12.5"], fx.amount) == [Decimal("0.00"), Decimal("0.00"), Decimal("12.50")]
    with pytest.raises(Exception):
        col_values(spark, ["abc"], fx.amount)


def test_claim_status_uses_raw_code(spark):
    assert col_values(spark, ["A", " a", "x", None], fx.claim_status) == ["Approved", "Unknown", "Unknown", "Unknown"]
    assert col_values(spark, [" a"], fx.normalize_code) == ["A"]


def test_line_of_business_passthrough(spark):
    assert col_values(spark, ["com", " MCD ", " zzz", None], fx.line_of_business) == \
        ["Commercial", "Medicaid", " zzz", None]


def test_valid_npi_newline_and_null(spark):
    got = col_values(spark, ["123456789\n", "1234567890", " 1234567890 ", "12345A7890", None], fx.is_valid_npi)
    assert got == [False, True, True, False, None]


def test_luhn_extra_check(spark):
    # 1234567893 is the standard valid example NPI.
    assert col_values(spark, ["1234567893", "1234567890"], fx.npi_luhn_ok) == [True, False]


def test_phone_zip(spark):
    assert col_values(spark, ["(555) 123-4567"], fx.standardize_phone) == ["5551234567"]
    assert col_values(spark, ["98101-1234"], fx.standardize_zip) == ["98101"]


def test_boundary_month_week_year(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2024, 1, 7), dt.date(2024, 1, 8)),
                                (dt.date(2023, 12, 31), dt.date(2024, 1, 1))], "a date, b date")
    r = df.select(fx.months_between_boundaries("a", "b"), fx.weeks_between_boundaries("a", "b"),
                  fx.years_between_boundaries("a", "b")).collect()
    assert [tuple(x) for x in r] == [(1, 0, 0), (0, 1, 0), (1, 1, 1)]


def test_day_of_week_sunday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 2, 29),)], "d date")
    assert [r[0] for r in df.select(fx.day_of_week_sun0("d")).collect()] == [0, 4]


def test_member_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (None, dt.date(2024, 1, 1)),
                                (dt.date(2024, 3, 1), dt.date(2024, 1, 1))], "s date, e date")
    assert [r[0] for r in df.select(fx.member_months("s", "e")).collect()] == [2, 0, 0]


def test_age(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(fx.age_years("d", dt.date(2024, 2, 28))).collect()] == [23, None]


def test_round_ratio_half_up_exact(spark):
    df = spark.createDataFrame([(1005, 1000), (201, 200), (-1005, 1000), (1, 0), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(fx.round_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [1.01, 1.01, -1.01, None, 0.67]


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    got = df.select(fx.surrogate_key("x", "y")).first()[0]
    import hashlib
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_ratio_sql_matches_column_ratio(spark):
    df = spark.createDataFrame([(1005, 1000), (201, 200), (-1005, 1000), (1, 0), (2, 3), (None, 5), (7, None)],
                               "n long, d long")
    a = [r[0] for r in df.select(fx.round_ratio(F.col("n"), F.col("d"), 2)).collect()]
    b = [r[0] for r in df.select(fx.ratio_expr("n", "d", 2)).collect()]
    assert a == b == [1.01, 1.01, -1.01, None, 0.67, None, None]
    g = [r[0] for r in df.select(fx.ratio_expr("n", "d", 1, guard="d > 0")).collect()]
    assert g == [1.0, 1.0, -1.0, 0.0, 0.7, None, 0.0]
