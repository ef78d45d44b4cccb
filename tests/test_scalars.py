"""Scalar functions: golden cases from the fixtures."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions import scalars as X
from tillroll.functions.locales import MONTHS_FR, MONTHS_IT, PROFILES
from tillroll.operators.clean import parse_report_datetime


def _one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col).collect()]


def test_to_number_eu_g8(spark):
    got = _one(spark, X.to_number_eu("x"), ["1.234,56", "12,50", "0", "1 234,56", None])
    assert got == [Decimal("1234.5600"), Decimal("12.5000"), Decimal("0.0000"), None, None]


def test_to_number_us_g9(spark):
    got = _one(spark, X.to_number_us("x"), ["1,234.56", "12.50", "1d", "-3.1"])
    assert got == [None, Decimal("12.5000"), None, Decimal("-3.1000")]


def test_round_half_even_g10(spark):
    got = _one(spark, X.round_half_even(F.col("x").cast("decimal(10,3)")), ["0.125", "0.135"])
    assert got == [Decimal("0.12"), Decimal("0.14")]
    assert _one(spark, X.div_round_half_even(F.col("x").cast("bigint"), F.lit(4)), ["2", "6", "10"]) == [0, 2, 2]


def test_french_dates_with_nbsp_g11(spark):
    got = _one(spark, F.to_date(parse_report_datetime("x", PROFILES["fr"])),
               ["3 sept. 2025 10:00:00 UTC", "3 août 2025 00:05:33 UTC", "1 mars 2025 23:59:59 UTC"])
    assert got == [dt.date(2025, 9, 3), dt.date(2025, 8, 3), dt.date(2025, 3, 1)]


def test_month_translation_needs_digit_and_spaces(spark):
    got = _one(spark, X.translate_months("x", MONTHS_IT),
               ["1 mar 2025", "marzo 1 mar", "xmar 2025", "1 mar", "2 set 2025 3 ott 2025"])
    assert got == ["1 Mar 2025", "marzo 1 mar", "xmar 2025", "1 mar", "2 Sep 2025 3 Oct 2025"]
    fast = _one(spark, X.translate_month_token("x", MONTHS_IT),
                ["1 mar 2025", "marzo 1 mar", "xmar 2025", "1 mar", "2 set 2025 3 ott 2025"])
    assert fast == got
    assert _one(spark, X.translate_month_token("x", MONTHS_FR), ["1 mars 2025 x"]) == ["1 Mar 2025 x"]


def test_us_and_german_dates(spark):
    us = _one(spark, parse_report_datetime("x", PROFILES["us"]),
              ["Mar 1, 2025 12:05:33 AM PST", "Jul 4, 2025 1:00:00 PM PDT", "not a date"])
    assert us == [dt.datetime(2025, 3, 1, 0, 5, 33), dt.datetime(2025, 7, 4, 13, 0, 0), None]
    de = _one(spark, parse_report_datetime("x", PROFILES["de"]), ["01.03.2025 00:05:33 UTC", "1.3.2025"])
    assert de == [dt.datetime(2025, 3, 1, 0, 5, 33), dt.datetime(2025, 3, 1)]


def test_strip_zone_is_literal_anywhere(spark):
    assert _one(spark, X.strip_zone("x", (" PST",)), ["a PST b", "PSTx"]) == ["a b", "PSTx"]


def test_date_parts_and_labels_g16(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 1),), (dt.date(2025, 3, 28),)], "d date")
    out = df.select(X.range_label(X.month_start_of("d"), "d").alias("l"),
                    X.weekday_name("d").alias("w")).collect()
    assert [r["l"] for r in out] == ["for March 1, 2025", "from March 1, 2025 to March 28, 2025"]
    assert [r["w"] for r in out] == ["Saturday", "Friday"]


def test_money_format(spark):
    got = _one(spark, X.money_format("x", "€"), [1234.5, -12.0, 1000000.0], "double")
    assert got == ["€1,234.50", "€-12.00", "€1,000,000.00"]


def test_plain_space_path_matches_unicode_rule(spark):
    """The cleaner's ASCII path (spaces unified one for one first) parses like the
    Unicode rule: a month name needs exactly one white space after the day."""
    p = PROFILES["fr"]
    texts = ["3 mars 2025 10:00:00 UTC", "1  mars 2025 10:00:00 UTC", "7\tjuil. 2025 01:02:03 UTC"]
    fast = _one(spark, parse_report_datetime("x", p), texts)
    ref = _one(spark, X.parse_datetime(X.strip_zone(X.normalize_spaces(X.translate_months("x", p.months)),
                                                    p.zones), p.datetime_patterns), texts)
    assert fast == ref
    assert fast[0] == dt.datetime(2025, 3, 3, 10, 0, 0) and fast[1] is None
