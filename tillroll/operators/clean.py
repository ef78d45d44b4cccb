"""Report cleaners: localized text report -> typed canonical transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.headers import canonical_select, locale_rename, normalize_headers
from tillroll.functions.locales import (DAILY_EXTRACT_DROP, DAILY_EXTRACT_KEEP, PROFILES,
                                        LocaleProfile)
from tillroll.functions.scalars import (MONEY, collapse_spaces, date_part, parse_datetime,
                                        plain_spaces, round_half_even, strip_zone, time_part,
                                        to_number_eu, to_number_us, translate_month_token,
                                        weekday_name, with_month_token)
from tillroll.operators.dims import with_asin


def _profile(p) -> LocaleProfile:
    return PROFILES[p] if isinstance(p, str) else p


def parse_report_datetime(c, profile) -> F.Column:
    """X1-X5 for one profile: months to English, white space, zone, then patterns."""
    p = _profile(profile)
    text = F.col(c) if isinstance(c, str) else c
    if p.normalize_spaces:
        # One-for-one to plain spaces first: the month rule (digit, one white
        # space, name, white space) then matches exactly where it did before,
        # with ASCII patterns; runs of spaces are collapsed after it.
        text = plain_spaces(text)
        if p.months:
            text = translate_month_token(text, p.months, plain=True)
        text = collapse_spaces(text)
    elif p.months:
        text = translate_month_token(text, p.months)
    return parse_datetime(strip_zone(text, p.zones), p.datetime_patterns)


def with_report_datetime(df: DataFrame, profile, text: str = "date_time", out: str = "_ts") -> DataFrame:
    """X1-X5 as ``parse_report_datetime``, in steps: the text is prepared once, then every
    pattern reads the prepared column (as one expression it would be prepared per pattern)."""
    p = _profile(profile)
    df = df.withColumn("_text", plain_spaces(text) if p.normalize_spaces else F.col(text))
    if p.months:
        df = with_month_token(df, "_text", p.months)
    ready = collapse_spaces("_text") if p.normalize_spaces else F.col("_text")
    df = df.withColumn("_text", strip_zone(ready, p.zones))
    return df.withColumn(out, parse_datetime("_text", p.datetime_patterns)).drop("_text")


def to_number(c, profile, strip_thousands: bool = False) -> F.Column:
    p = _profile(profile)
    if p.decimal_comma:
        return to_number_eu(c)
    text = F.replace(F.col(c), F.lit(","), F.lit("")) if strip_thousands else F.col(c)
    return to_number_us(text)


def _strict(value: F.Column, text: F.Column, what: str) -> F.Column:
    """Raise (fail the job) when non-empty text did not parse."""
    bad = value.isNull() & text.isNotNull() & (F.trim(text) != "")
    return F.when(bad, F.raise_error(F.concat(F.lit(f"unparsed {what}: "), text))).otherwise(value)


def standardize(raw: DataFrame, profile, strict: bool = False,
                strip_thousands: bool = False, keep_text: bool = False) -> DataFrame:
    """Headers, date-time and numbers of a raw report, before the projection.

    ``strict`` raises on a date or number that does not parse (default: null,
    see ``bad_dates`` / ``null_counts``); ``strip_thousands`` accepts
    ``1,234.56`` in dot-decimal reports (the source turns it into null);
    ``keep_text`` keeps the date-time text beside the parsed date.
    """
    p = _profile(profile)
    df = locale_rename(normalize_headers(raw, p), p)
    # Numbers first: the steps of the date then carry 8 bytes a number, not its text.
    nums = {c: to_number(c, p, strip_thousands) for c in p.numeric_columns if c in df.columns}
    if strict:
        nums = {c: _strict(v, F.col(c), c) for c, v in nums.items()}
    if not p.decimal_comma and "product_sales" in nums:
        nums["product_sales"] = round_half_even(nums["product_sales"], 2).cast(MONEY)
    df = with_report_datetime(df.withColumns(nums) if nums else df, p)
    if strict:
        df = df.withColumn("_ts", _strict(F.col("_ts"), F.col("date_time"), "date"))
    df = df.select(
        "*", date_part("_ts").alias("date"), time_part("_ts").alias("time"),
        weekday_name("_ts").alias("weekday"))
    return df.drop("_ts", "data_time", *([] if keep_text else ["date_time"]))


def clean(raw: DataFrame, profile, sku_dim: DataFrame | None = None,
          fill_missing: bool = False, strict: bool = False,
          strip_thousands: bool = False, standard: bool = False,
          extras=("market", "report_date", "source_file")) -> DataFrame:
    """A raw report (any locale) -> canonical typed transactions.

    ``sku_dim`` is ``(sku, ASIN)`` unique by sku; profiles whose projection has
    ``ASIN`` get it by a left lookup (null without a dimension). Rows whose
    date text fits no pattern keep a null ``date`` (see ``bad_dates``). With
    ``standard`` the input has been through ``standardize``; ``extras`` ride along.
    """
    p = _profile(profile)
    df = raw if standard else standardize(raw, p, strict=strict, strip_thousands=strip_thousands)
    if "ASIN" in p.columns:
        df = with_asin(df, sku_dim) if sku_dim is not None else df.withColumn(
            "ASIN", F.lit(None).cast("string"))
    types = {c: MONEY for c in p.numeric_columns}
    types.update({"date": "date"})
    return canonical_select(df, p.columns, extras=extras, fill_missing=fill_missing, types=types)


def bad_dates(raw: DataFrame, profile) -> DataFrame:
    """H6: rows whose date text fits no pattern (a quarantine, not an error)."""
    p = _profile(profile)
    df = locale_rename(normalize_headers(raw, p), p)
    return (with_report_datetime(df, p)
            .filter(F.col("date_time").isNotNull() & F.col("_ts").isNull()).drop("_ts"))


def null_counts(clean_df: DataFrame, columns) -> DataFrame:
    """H4: how many values of each numeric column did not parse (one row)."""
    present = [c for c in columns if c in clean_df.columns]
    return clean_df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in present])


def daily_extract(raw: DataFrame, sku_dim: DataFrame | None = None, profile="us") -> DataFrame:
    """The short dated extract of a US report: drop list, then keep list; a
    ``report_date`` rides along (K3 writes by it)."""
    p = _profile(profile)
    df = standardize(raw, p)
    df = with_asin(df, sku_dim) if sku_dim is not None else df.withColumn(
        "ASIN", F.lit(None).cast("string"))
    df = df.drop(*DAILY_EXTRACT_DROP)
    return canonical_select(df, DAILY_EXTRACT_KEEP)
