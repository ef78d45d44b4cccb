"""Results table keyed by (report_date, market): upserts, group replacement, JSON form."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import as_date

RESULT_COLUMNS = ["report_date", "market", "actual_sales", "estimated_sales", "total_estimation"]
RESULTS_SCHEMA = ("report_date date, market string, actual_sales double, "
                  "estimated_sales double, total_estimation double")
# The legacy results document: date text -> list of market figures.
JSON_SCHEMA = ("map<string, array<struct<market: string, actual_sales: double, "
               "estimated_sales: double, total_estimation: double>>>")


def upsert_market(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same (report_date, market)."""
    keys = new.select("report_date", "market")
    return old.join(keys, ["report_date", "market"], "left_anti").unionByName(
        new.select(*RESULT_COLUMNS))


def replace_group(old: DataFrame, new: DataFrame, prefix: str,
                  report_date: _dt.date | str | None = None) -> DataFrame:
    """K6: on the replaced date(s), every market starting with ``prefix`` is dropped,
    then ``new`` is added; other dates and other markets stay.

    With ``report_date`` given, that one date is replaced (even by an empty
    ``new``: a market that failed disappears, as in the source). Otherwise the
    dates present in ``new`` are replaced.
    """
    in_group = F.col("market").startswith(prefix)
    if report_date is not None:
        kept = old.filter(~((F.col("report_date") == F.lit(as_date(report_date))) & in_group))
    else:
        dates = new.select(F.col("report_date").alias("_rd")).distinct()
        kept = old.join(dates, (old["report_date"] == dates["_rd"]) & in_group, "left_anti")
    return kept.unionByName(new.select(*RESULT_COLUMNS))


def results_for_date(results: DataFrame, report_date, require: bool = True) -> DataFrame:
    """the rows of one report date; absent -> error (as the summary needs it)."""
    out = results.filter(F.col("report_date") == F.lit(as_date(report_date)))
    if require and out.isEmpty():
        raise ValueError(f"no results for {as_date(report_date).isoformat()}")
    return out


def to_json_lines(results: DataFrame) -> DataFrame:
    """Results as JSON Lines in the legacy shape, one ``{date: [figures]}`` object per row.

    Merging the objects by key gives the legacy document; no task holds more
    than one row.
    """
    fig = F.struct("market", "actual_sales", "estimated_sales", "total_estimation")
    return results.select(F.to_json(F.create_map(
        F.date_format("report_date", "yyyy-MM-dd"), F.array(fig))).alias("json"))


def from_json_text(docs: DataFrame, col: str = "json", strict: bool = True) -> DataFrame:
    """Legacy results text (whole documents or JSON Lines) -> result rows.

    A null or blank document gives no rows. A malformed one fails the job
    (as the summary's read does); without ``strict`` it gives no rows.
    """
    text = docs.select(F.col(col).alias("m")).filter(F.trim("m") != "")
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    parsed = text.select(F.from_json("m", JSON_SCHEMA, mode).alias("m"))
    entries = parsed.select(F.explode("m").alias("k", "v"))
    rows = entries.select(F.col("k"), F.inline("v"))
    return rows.select(F.to_date("k").alias("report_date"), "market", "actual_sales",
                       "estimated_sales", "total_estimation")
