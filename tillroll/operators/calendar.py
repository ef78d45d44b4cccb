"""Report calendar: cutoff -> report date, month bounds, remaining days."""

from __future__ import annotations

import calendar as _cal
import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalars import (as_date, month_end_of, month_start_of,
                                        report_date_of, weekday_name)


def bounds(cutoff) -> dict:
    """Driver-side bounds of a cutoff parameter (dates only, no data)."""
    cutoff = as_date(cutoff)
    report = cutoff - _dt.timedelta(days=1)
    start = report.replace(day=1)
    end = report.replace(day=_cal.monthrange(report.year, report.month)[1])
    return {"cutoff": cutoff, "report_date": report, "month_start": start,
            "month_end": end, "is_last_day": report == end}


def calendar_bounds(cutoff_col) -> list[Column]:
    """Column form of ``bounds`` for a per-row cutoff."""
    c = F.col(cutoff_col) if isinstance(cutoff_col, str) else cutoff_col
    rd = report_date_of(c)
    return [
        rd.alias("report_date"),
        month_start_of(rd).alias("month_start"),
        month_end_of(rd).alias("month_end"),
        (rd == month_end_of(rd)).alias("is_last_day"),
    ]


def remaining_days_expr(cutoff) -> Column:
    """Array of the days cutoff..month end (empty when the report closes the month).

    Built from the month start, as ``sequence(cutoff, month_end)`` would fail
    on the 1st, when the cutoff is already in the next month.
    """
    b = bounds(cutoff)
    days = F.sequence(F.lit(b["month_start"]), F.lit(b["month_end"]))
    return F.filter(days, lambda d: d >= F.lit(b["cutoff"]))


def remaining_weekday_count(cutoff, weekday_col) -> Column:
    """How many remaining days fall on the weekday in ``weekday_col``."""
    return F.size(F.filter(remaining_days_expr(cutoff),
                           lambda d: weekday_name(d) == weekday_col))


def remaining_days(spark: SparkSession, cutoff) -> DataFrame:
    """The remaining calendar days as a DataFrame ``(day, weekday)`` (at most 31 rows)."""
    return (spark.range(1)
            .select(F.explode(remaining_days_expr(cutoff)).alias("day"))
            .withColumn("weekday", weekday_name("day")))
