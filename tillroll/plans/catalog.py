"""Query catalog: every operator bound to the driver's tables, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Column names match between the two; money is exact cents shown as
``cents / 100`` doubles or ``decimal(18,4)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import scalars as X
from tillroll.operators import estimate as E
from tillroll.operators.calendar import bounds, calendar_bounds
from tillroll.operators.clean import clean, daily_extract
from tillroll.operators.dims import sku_dimension, sku_first, sku_map_json, with_asin
from tillroll.plans import bindings as B
from tillroll.plans import sql_mirror as M
from tillroll.session import load_table, remove_folder, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- estimate

@query("estimate_month_end", M.estimate_sql(B.ORDERS_TX_SQL, B.CUTOFF))
def q_estimate_month_end(spark, d):
    return E.estimate(B.orders_tx(spark, d), B.CUTOFF)


@query("estimate_on_first_of_month", M.estimate_sql(B.ORDERS_TX_SQL, B.CUTOFF_FIRST))
def q_estimate_on_first_of_month(spark, d):
    return E.estimate(B.orders_tx(spark, d), B.CUTOFF_FIRST)


@query("estimate_multi_market", M.estimate_sql(B.REGION_TX_SQL, B.CUTOFF))
def q_estimate_multi_market(spark, d):
    return E.estimate(B.region_tx(spark, d), B.CUTOFF)


@query("estimate_sparse_history", M.estimate_sql(B.EVENTS_TX_SQL, B.CUTOFF_EVENTS_SHALLOW))
def q_estimate_sparse_history(spark, d):
    return E.estimate(B.events_tx(spark, d), B.CUTOFF_EVENTS_SHALLOW)


@query("estimate_sub_cent", M.estimate_sql(B.THIRDS_TX_SQL, B.CUTOFF))
def q_estimate_sub_cent(spark, d):
    """Amounts with parts of a cent: sums are exact, figures round once."""
    return E.estimate(B.thirds_tx(spark, d), B.CUTOFF)


_b = bounds(B.CUTOFF)

ORACLE_DAILY_SALES = f"""
SELECT market, d AS date, dayname(d) AS weekday, CAST(cents AS DOUBLE) / 100 AS amount
FROM (SELECT market, d, sum(cents) AS cents FROM ({B.ORDERS_TX_SQL}) s
      WHERE d IS NOT NULL AND d < DATE '{_b['cutoff']}' GROUP BY market, d)"""


@query("daily_sales", ORACLE_DAILY_SALES)
def q_daily_sales(spark, d):
    return E.daily_sales(B.orders_tx(spark, d), cutoff=B.CUTOFF)


@query("mtd_actual", f"""
SELECT DATE '{_b['report_date']}' AS report_date, market,
       round_even(CAST(coalesce(sum(CASE WHEN d BETWEEN DATE '{_b['month_start']}' AND DATE '{_b['report_date']}'
                                         THEN cents END), 0) AS DOUBLE), 0) / 100 AS actual_sales
FROM ({B.ORDERS_TX_SQL}) s GROUP BY market""")
def q_mtd_actual(spark, d):
    return E.mtd_actual(B.orders_tx(spark, d), B.CUTOFF)


@query("day_totals_incremental", f"""
SELECT date_trunc('month', d)::DATE AS month, market, d AS date, CAST(sum(cents) AS DECIMAL(22,2)) AS cents
FROM ({B.ORDERS_TX_SQL}) s GROUP BY market, d""")
def q_day_totals_incremental(spark, d):
    """Day totals kept incrementally: totals of the orders before the cutoff, then the
    rest added (the cutoff falls mid-month, so one month gets both)."""
    tx = B.orders_tx(spark, d)
    early = F.to_date("date") < F.lit(bounds(B.CUTOFF)["cutoff"])
    first = E.merge_day_totals(None, E.daily_cents(tx.filter(early), keep_null_dates=True))
    later = E.daily_cents(tx.filter(~early), keep_null_dates=True)
    return E.merge_day_totals(first, later).select("month", "market", "date", "cents")


def _recent(spark, d, src, cutoff):
    return E.recent_weekdays(E.daily_cents(src(spark, d)), cutoff)


@query("recent_weekdays", f"""
WITH {M.ranked_sql(B.ORDERS_TX_SQL, B.CUTOFF)}
SELECT market, weekday, d AS date, rn, CAST(cents AS DOUBLE) / 100 AS amount FROM recent""")
def q_recent_weekdays(spark, d):
    r = _recent(spark, d, B.orders_tx, B.CUTOFF)
    return r.select("market", "weekday", "date", F.col("rn").cast("bigint").alias("rn"),
                    X.cents_to_amount("cents").alias("amount"))


def _two_sources_sql(body_fn) -> str:
    a = body_fn(B.ORDERS_TX_SQL, B.CUTOFF)
    b = body_fn(B.EVENTS_TX_SQL, B.CUTOFF_EVENTS_DEEP)
    return f"({a}) UNION ALL ({b})"


def _two_sources(spark, d, fn):
    a = fn(_recent(spark, d, B.orders_tx, B.CUTOFF))
    b = fn(_recent(spark, d, B.events_tx, B.CUTOFF_EVENTS_DEEP))
    return a.unionByName(b)


def _points_body(src, cutoff):
    return f"""
WITH {M.ranked_sql(src, cutoff)},
{M.points_sql()}
SELECT market, weekday, n, CAST(q1 AS DOUBLE) / 400 AS p1, CAST(q2 AS DOUBLE) / 400 AS p2,
       CAST(q3 AS DOUBLE) / 400 AS p3, CAST(q4 AS DOUBLE) / 400 AS p4 FROM pts"""


@query("cascading_points", _two_sources_sql(_points_body))
def q_cascading_points(spark, d):
    return _two_sources(spark, d, E.cascading_points)


def _average_body(src, cutoff):
    return f"""
WITH {M.ranked_sql(src, cutoff)},
{M.points_sql()}
SELECT market, weekday, n, CAST(avg_cents AS DOUBLE) / 100 AS avg_amount FROM prof"""


@query("weekday_average", _two_sources_sql(_average_body))
def q_weekday_average(spark, d):
    return _two_sources(spark, d, lambda r: E.weekday_average(r).select(
        "market", "weekday", "n", "avg_amount"))


@query("weekday_history_depth", f"""
WITH {M.ranked_sql(B.EVENTS_TX_SQL, B.CUTOFF_EVENTS_SHALLOW)}
SELECT market, weekday, count(*) AS days, count(*) >= 4 AS has_p1, count(*) >= 5 AS has_p2,
       count(*) >= 6 AS has_p3, count(*) >= 7 AS has_p4
FROM recent GROUP BY market, weekday""")
def q_weekday_history_depth(spark, d):
    return E.weekday_history_depth(_recent(spark, d, B.events_tx, B.CUTOFF_EVENTS_SHALLOW))


@query("forecast_days", f"""
WITH {M.ranked_sql(B.NO_SUNDAY_TX_SQL, B.CUTOFF)},
{M.points_sql()},
days AS (SELECT CAST(unnest(generate_series(DATE '{_b['month_start']}', DATE '{_b['month_end']}',
                                            INTERVAL 1 DAY)) AS DATE) AS day)
SELECT m.market, day, dayname(day) AS weekday, CAST(coalesce(avg_cents, 0) AS DOUBLE) / 100 AS forecast
FROM (SELECT DISTINCT market FROM ({B.NO_SUNDAY_TX_SQL})) m CROSS JOIN days
LEFT JOIN prof ON prof.market = m.market AND dayname(day) = prof.weekday WHERE day >= DATE '{_b['cutoff']}'""")
def q_forecast_days(spark, d):
    """Every remaining day of every market; one market has no Sundays, which count 0."""
    prof = E.weekday_average(_recent(spark, d, B.no_sunday_tx, B.CUTOFF))
    return E.forecast_days(prof, B.CUTOFF).select(
        "market", "day", "weekday", X.cents_to_amount("cents").alias("forecast"))


@query("forecast_remaining", f"""
WITH {M.ranked_sql(B.ORDERS_TX_SQL, B.CUTOFF)},
{M.points_sql()},
{M.calendar_sql(B.CUTOFF)}
SELECT market, CAST(coalesce(sum(avg_cents * k), 0) AS DOUBLE) / 100 AS estimated_sales
FROM prof LEFT JOIN cal USING (weekday) GROUP BY market""")
def q_forecast_remaining(spark, d):
    prof = E.weekday_average(_recent(spark, d, B.orders_tx, B.CUTOFF))
    return E.forecast_remaining(prof, B.CUTOFF)


# ---------------------------------------------------------------- calendar, scalars

_DATES_SQL = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS cutoff FROM orders"


def _dates(spark, d):
    return load_table(spark, d, "orders").select(F.to_date("o_orderdate").alias("cutoff")).distinct()


@query("calendar_bounds", f"""
SELECT cutoff, cutoff - 1 AS report_date, date_trunc('month', cutoff - 1)::DATE AS month_start,
       last_day(cutoff - 1) AS month_end, (cutoff - 1) = last_day(cutoff - 1) AS is_last_day
FROM ({_DATES_SQL})""")
def q_calendar_bounds(spark, d):
    return _dates(spark, d).select("cutoff", *calendar_bounds("cutoff"))


@query("date_labels", f"""
SELECT cutoff AS d, strftime(cutoff, '%Y-%m-%d') AS iso, strftime(cutoff, '%B %d') AS month_day,
       strftime(cutoff, '%B %-d, %Y') AS long, strftime(cutoff, '%m/%d/%Y') AS us,
       CASE WHEN day(cutoff) = 1 THEN 'for ' || strftime(cutoff, '%B %-d, %Y')
            ELSE 'from ' || strftime(date_trunc('month', cutoff), '%B %-d, %Y') || ' to '
                 || strftime(cutoff, '%B %-d, %Y') END AS range_label
FROM ({_DATES_SQL})""")
def q_date_labels(spark, d):
    lab = X.date_labels("cutoff")
    return _dates(spark, d).select(
        F.col("cutoff").alias("d"), lab["iso"].alias("iso"), lab["month_day"].alias("month_day"),
        lab["long"].alias("long"), lab["us"].alias("us"),
        X.range_label(X.month_start_of("cutoff"), "cutoff").alias("range_label"))


@query("round_half_even", """
SELECT o_orderkey, CAST(round_even(CAST(round(o_totalprice * 100) AS BIGINT) / 8.0, 0) AS DOUBLE) / 100 AS eighth,
       CAST(round_even(CAST(round(o_totalprice * 100) AS BIGINT) / 8.0, 0) AS BIGINT) AS eighth_cents
FROM orders""")
def q_round_half_even(spark, d):
    o = load_table(spark, d, "orders")
    return o.select("o_orderkey", X.cents_to_amount(
        X.div_round_half_even(X.to_cents("o_totalprice"), F.lit(8))).alias("eighth"),
        X.round_half_even(X.to_cents("o_totalprice").cast("decimal(18,0)") * F.lit("0.125").cast("decimal(4,3)"), 0)
        .cast("bigint").alias("eighth_cents"))


# ---------------------------------------------------------------- cleaners

def _sku_dim(spark, d):
    return sku_first(B.sku_dim_raw(spark, d))


@query("clean_us", B.clean_expected_sql("us", with_asin=True))
def q_clean_us(spark, d):
    return clean(B.raw_report(spark, d, "us"), "us", sku_dim=_sku_dim(spark, d))


@query("clean_us2", B.clean_expected_sql("us2"))
def q_clean_us2(spark, d):
    return clean(B.raw_report(spark, d, "us2", with_duplicate_header=True), "us2")


for _p in ("de", "it", "es", "fr"):
    def _mk(p):
        def fn(spark, d):
            return clean(B.raw_report(spark, d, p), p)
        fn.__name__ = f"q_clean_{p}"
        return fn
    query(f"clean_{_p}", B.clean_expected_sql(_p))(_mk(_p))


@query("sku_asin_left_join", f"""
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS sku, dim.asin AS ASIN
FROM lineitem LEFT JOIN ({B.SKU_DIM_FIRST_SQL}) dim ON CAST(l_partkey AS VARCHAR) = dim.sku""")
def q_sku_asin_left_join(spark, d):
    li = load_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("sku"))
    return with_asin(li, _sku_dim(spark, d))


@query("dim_sku_first", f"SELECT sku, asin AS ASIN FROM ({B.SKU_DIM_FIRST_SQL})")
def q_dim_sku_first(spark, d):
    return _sku_dim(spark, d)


@query("dim_sku_project", f"SELECT sku, asin AS ASIN FROM ({B.SKU_DIM_RAW_SQL})")
def q_dim_sku_project(spark, d):
    return sku_dimension(B.sku_dim_raw(spark, d))


@query("sku_map_json", f"SELECT sku, json_object(sku, asin) AS json FROM ({B.SKU_DIM_FIRST_SQL})")
def q_sku_map_json(spark, d):
    return sku_map_json(_sku_dim(spark, d))


# ---------------------------------------------------------------- headers, scalars on report text

from tillroll.functions.headers import (  # noqa: E402
    canonical_select, locale_rename, normalize_header, normalize_headers)  # noqa: E402
from tillroll.functions.locales import CANONICAL_COLUMNS, PROFILES  # noqa: E402
from tillroll.operators.clean import standardize, with_report_datetime  # noqa: E402

_LINE = f"({B.LINE_TX_SQL}) t"
_ORDER_ID_SQL = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
_TS_TEXT_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def _raw_select(profile: str, name) -> str:
    """Oracle: every text column of a raw report, named by ``name(canonical)``."""
    cols = [f'{x} AS "{name(c)}"' for c, x in B.raw_text_sql(profile).items()]
    return f"SELECT {', '.join(cols)} FROM {_LINE}"


@query("header_normalize", _raw_select("it", lambda c: normalize_header(B.raw_header("it", c), PROFILES["it"])))
def q_header_normalize(spark, d):
    return normalize_headers(B.raw_report(spark, d, "it"), PROFILES["it"])


@query("dedupe_columns", _raw_select("us2", lambda c: c))
def q_dedupe_columns(spark, d):
    return normalize_headers(B.raw_report(spark, d, "us2", with_duplicate_header=True), PROFILES["us2"])


for _p in ("de", "it", "es", "fr"):
    def _mk_lr(p):
        def fn(spark, d):
            return locale_rename(normalize_headers(B.raw_report(spark, d, p), PROFILES[p]), PROFILES[p])
        fn.__name__ = f"q_locale_rename_{p}"
        return fn
    query("locale_rename" if _p == "de" else f"locale_rename_{_p}", _raw_select(_p, lambda c: c))(_mk_lr(_p))


def _canonical_select_sql() -> str:
    present = set(B.REPORT_COLUMNS) | {"date", "time", "weekday"}
    money = set(PROFILES["us"].numeric_columns)
    cols = []
    for c in CANONICAL_COLUMNS:
        if c in present:
            cols.append(f'"{c}"')
        else:
            cols.append(f'CAST(NULL AS {"DECIMAL(18,4)" if c in money else "VARCHAR"}) AS "{c}"')
    return f"SELECT {', '.join(cols)} FROM ({B.clean_expected_sql('de')})"


@query("canonical_select", _canonical_select_sql())
def q_canonical_select(spark, d):
    from tillroll.functions.scalars import MONEY
    df = clean(B.raw_report(spark, d, "de"), "de")
    types = {c: MONEY for c in PROFILES["us"].numeric_columns}
    return canonical_select(df, CANONICAL_COLUMNS, fill_missing=True, types=types)


@query("strip_zone", f"""
SELECT {_ORDER_ID_SQL} AS order_id, strftime(ts, '%b %-d, %Y %-I:%M:%S %p') AS date_time FROM {_LINE}""")
def q_strip_zone(spark, d):
    df = normalize_headers(B.raw_report(spark, d, "us"))
    return df.select("order_id", X.strip_zone("date_time", (" PST", " PDT")).alias("date_time"))


def _parsed(spark, d, profile):
    p = PROFILES[profile]
    df = locale_rename(normalize_headers(B.raw_report(spark, d, profile), p), p)
    return with_report_datetime(df, p).select(
        "order_id", F.date_format("_ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


_PARSED_SQL = f"SELECT {_ORDER_ID_SQL} AS order_id, {_TS_TEXT_SQL} AS ts FROM {_LINE}"


@query("parse_us_datetime", _PARSED_SQL)
def q_parse_us_datetime(spark, d):
    return _parsed(spark, d, "us")


@query("parse_dayfirst_datetime", _PARSED_SQL)
def q_parse_dayfirst_datetime(spark, d):
    return _parsed(spark, d, "de")


@query("parse_mixed_datetime", _PARSED_SQL)
def q_parse_mixed_datetime(spark, d):
    return _parsed(spark, d, "fr")


def _translated_sql(profile: str) -> str:
    sep = "' '"
    return (f"SELECT {_ORDER_ID_SQL} AS order_id, CAST(day(ts) AS VARCHAR) || {sep} || strftime(ts, '%b') "
            f"|| {sep} || CAST(year(ts) AS VARCHAR) || ' ' || strftime(ts, '%H:%M:%S') || ' UTC' AS date_time "
            f"FROM {_LINE}")


for _p in ("it", "es", "fr"):
    def _mk_tr(p):
        def fn(spark, d):
            prof = PROFILES[p]
            df = locale_rename(normalize_headers(B.raw_report(spark, d, p), prof), prof)
            # the cleaner's step; French no-break spaces are plain by then
            ready = df.withColumn("date_time", X.plain_spaces("date_time"))
            return X.with_month_token(ready, "date_time", prof.months).select("order_id", "date_time")
        fn.__name__ = f"q_month_translate_{p}"
        return fn
    query(f"month_translate_{_p}", _translated_sql(_p))(_mk_tr(_p))


@query("date_parts", f"""
SELECT {_ORDER_ID_SQL} AS order_id, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time,
       dayname(ts) AS weekday FROM {_LINE}""")
def q_date_parts(spark, d):
    return standardize(B.raw_report(spark, d, "es"), "es").select("order_id", "date", "time", "weekday")


# Number text with the styles a report may hold: line 1 is written with
# thousands separators (US: ``1,234.56``, EU: French ``1 234,56``), which the
# cleaners do not accept; other lines use the plain style of their market.
def _number_text(eu: bool):
    plain = B._money_eu("ps") if eu else B._money_us("ps")
    odd = B.money_text("ps", " ", ",") if eu else B.money_text("ps", ",", ".")
    return F.when(F.col("l_linenumber") == 1, odd).otherwise(plain)


def _number_sql(eu: bool) -> str:
    return (f"SELECT {_ORDER_ID_SQL} AS order_id, CASE WHEN l_linenumber = 1 AND ps >= 100000 THEN NULL "
            f"ELSE CAST(CAST(ps AS DOUBLE) / 100 AS DECIMAL(18,4)) END AS product_sales FROM {_LINE}")


@query("to_number_us", _number_sql(False))
def q_to_number_us(spark, d):
    t = B.line_tx(spark, d)
    return t.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
                    X.to_number_us(_number_text(False)).alias("product_sales"))


@query("to_number_eu", _number_sql(True))
def q_to_number_eu(spark, d):
    t = B.line_tx(spark, d)
    return t.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
                    X.to_number_eu(_number_text(True)).alias("product_sales"))


@query("quarantine_dates", f"""
SELECT {_ORDER_ID_SQL} AS order_id, 'n/a' AS date_time FROM {_LINE} WHERE l_linenumber = 7""")
def q_quarantine_dates(spark, d):
    """H6: rows whose date text fits no pattern (every line number 7 says ``n/a``)."""
    from tillroll.operators.clean import bad_dates
    rep = B.raw_report_from(B.line_tx(spark, d), "de", keep=["l_linenumber"])
    col = B.raw_header("de", "date_time")
    rep = rep.withColumn(col, F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col(col)))
    return bad_dates(rep.drop("l_linenumber"), "de").select("order_id", "date_time")


@query("daily_extract", f"""
SELECT date, time, weekday, settlement_id, type, order_id, sku, ASIN, description, quantity, marketplace,
       account_type, fulfillment, order_city, order_state, order_postal, tax_collection_model,
       other_transaction_fees, other, product_sales, total FROM ({B.clean_expected_sql('us', with_asin=True)})""")
def q_daily_extract(spark, d):
    return daily_extract(B.raw_report(spark, d, "us"), sku_dim=_sku_dim(spark, d))


_MARKETS = {"de": "EU - Germany", "it": "EU - Italy", "es": "EU - Spain", "fr": "EU - France"}


@query("multi_market_union", f"""
SELECT m.market, CAST(t.ts AS DATE) AS date, dayname(CAST(t.ts AS DATE)) AS weekday,
       CAST(sum(t.ps) AS DOUBLE) / 100 AS amount
FROM {_LINE} CROSS JOIN (VALUES {', '.join(f"('{v}')" for v in _MARKETS.values())}) m(market)
GROUP BY m.market, CAST(t.ts AS DATE)""")
def q_multi_market_union(spark, d):
    parts = [clean(B.raw_report(spark, d, p), p).withColumn("market", F.lit(m)) for p, m in _MARKETS.items()]
    tx = parts[0]
    for p in parts[1:]:
        tx = tx.unionByName(p)
    return E.daily_sales(tx, amount="product_sales")


def _append_sql() -> str:
    old = "ts < TIMESTAMP '1998-01-01'"
    cols = B.raw_text_sql("us") | {"fulfillment": f"CASE WHEN {old} THEN 'Amazon' END",
                                   "account_type": f"CASE WHEN NOT {old} THEN 'Standard Orders' END"}
    return "SELECT " + ", ".join(f'{x} AS "{B.raw_header("us", c)}"' for c, x in cols.items()) + f" FROM {_LINE}"


@query("append_union_by_name", _append_sql())
def q_append_union_by_name(spark, d):
    from tillroll.sources.sinks import append_by_name
    t = B.line_tx(spark, d).withColumn("_old", F.col("ts") < F.lit("1998-01-01").cast("timestamp_ntz"))
    rep = B.raw_report_from(t, "us", keep=["_old"])
    master = rep.filter(F.col("_old")).drop("_old", "account type")
    new = rep.filter(~F.col("_old")).drop("_old", "fulfillment")
    return append_by_name(master, new)


# ---------------------------------------------------------------- results, summary

from tillroll.operators import results as R  # noqa: E402
from tillroll.operators import summary as S  # noqa: E402

_RD = bounds(B.CUTOFF)["report_date"]


@query("results_json_explode", B.results_sql())
def q_results_json_explode(spark, d):
    return R.from_json_text(R.to_json_lines(B.results_table(spark, d)))


@query("results_for_date", f"SELECT * FROM ({B.results_sql()}) WHERE report_date = DATE '{_RD}'")
def q_results_for_date(spark, d):
    return R.results_for_date(B.results_table(spark, d), _RD)


@query("group_flag", f"""
SELECT report_date, market, starts_with(market, '{B.EU_PREFIX}') AS starts_with_group,
       contains(market, '{B.EU_PREFIX}') AS contains_group FROM ({B.results_sql()})""")
def q_group_flag(spark, d):
    r = B.results_table(spark, d)
    return r.select("report_date", "market", F.col("market").startswith(B.EU_PREFIX).alias("starts_with_group"),
                    F.col("market").contains(B.EU_PREFIX).alias("contains_group"))


_NEW_AMERICA = B.results_sql("r_name = 'AMERICA' AND o_orderstatus = 'F'")
_NEW_EUROPE = B.results_sql("r_name = 'EUROPE' AND o_orderstatus = 'O'")


@query("results_upsert_market", f"""
WITH old AS ({B.results_sql()}), new AS ({_NEW_AMERICA})
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.report_date = old.report_date
                                     AND new.market = old.market)
UNION ALL SELECT * FROM new""")
def q_results_upsert_market(spark, d):
    return R.upsert_market(B.results_table(spark, d), B.results_rerun(spark, d, "AMERICA", "F"))


@query("results_replace_group", f"""
WITH old AS ({B.results_sql()}), new AS ({_NEW_EUROPE})
SELECT * FROM old WHERE NOT (starts_with(market, '{B.EU_PREFIX}')
                             AND report_date IN (SELECT report_date FROM new))
UNION ALL SELECT * FROM new""")
def q_results_replace_group(spark, d):
    return R.replace_group(B.results_table(spark, d), B.results_rerun(spark, d, "EUROPE", "O"), B.EU_PREFIX)


def _summary_sql() -> str:
    g = B.EU_PREFIX
    return f"""
WITH r AS (SELECT report_date, market, contains(market, '{g}') AS g,
                  CAST(round(actual_sales * 100) AS BIGINT) AS a, CAST(round(estimated_sales * 100) AS BIGINT) AS e,
                  CAST(round(total_estimation * 100) AS BIGINT) AS t FROM ({B.results_sql()})),
rows AS (SELECT report_date, CASE WHEN g THEN 1 ELSE 3 END AS ord, market,
                CASE WHEN g THEN '€' ELSE '$' END AS currency, a, e, t FROM r
         UNION ALL
         SELECT report_date, 2, 'Total {g}', '€', CAST(coalesce(sum(CASE WHEN g THEN a END), 0) AS BIGINT),
                CAST(coalesce(sum(CASE WHEN g THEN e END), 0) AS BIGINT),
                CAST(coalesce(sum(CASE WHEN g THEN t END), 0) AS BIGINT) FROM r GROUP BY report_date
         UNION ALL
         SELECT report_date, 4, 'Grand Total', '$', CAST(sum(a) AS BIGINT), CAST(sum(e) AS BIGINT),
                CAST(sum(t) AS BIGINT) FROM r GROUP BY report_date)
SELECT report_date, CAST(ord AS INTEGER) AS ord, market, currency, CAST(a AS DOUBLE) / 100 AS actual_sales,
       CAST(e AS DOUBLE) / 100 AS estimated_sales, CAST(t AS DOUBLE) / 100 AS total_estimation FROM rows"""


@query("summary_rollup", _summary_sql())
def q_summary_rollup(spark, d):
    return S.summary(B.results_table(spark, d), group=B.EU_PREFIX)


@query("money_format", f"""
SELECT report_date, ord, market,
       currency || format('{{:,.2f}}', actual_sales) AS actual_sales_text,
       currency || format('{{:,.2f}}', estimated_sales) AS estimated_sales_text,
       currency || format('{{:,.2f}}', total_estimation) AS total_estimation_text
FROM ({_summary_sql()})""")
def q_money_format(spark, d):
    return S.money_columns(S.summary(B.results_table(spark, d), group=B.EU_PREFIX))


def _html_sql() -> str:
    cell = S._CELL.replace("'", "''")
    return f"""
SELECT report_date, ord, market,
  '<tr' || (CASE ord WHEN 2 THEN ' style="background-color: #f9f9f9; font-weight: bold;"'
                     WHEN 4 THEN ' style="background-color: #e6f2ff; font-weight: bold;"' ELSE '' END) || '>'
  || '{cell}' || market || '</td>'
  || '{cell}' || currency || format('{{:,.2f}}', actual_sales) || '</td>'
  || '{cell}' || currency || format('{{:,.2f}}', estimated_sales) || '</td>'
  || '{cell}' || (CASE WHEN ord IN (2, 4) THEN currency || format('{{:,.2f}}', total_estimation)
                  ELSE '<strong>' || currency || format('{{:,.2f}}', total_estimation) || '</strong>' END)
  || '</td></tr>' AS html
FROM ({_summary_sql()})"""


@query("report_html", _html_sql())
def q_report_html(spark, d):
    return S.html_rows(S.summary(B.results_table(spark, d), group=B.EU_PREFIX))


# ---------------------------------------------------------------- file side

from tillroll.sources import files as FL  # noqa: E402

_LIST = f"({B.FILE_LISTING_SQL})"


@query("file_filter_unified", f"""
SELECT o_orderkey, market, file_name FROM {_LIST}
WHERE regexp_matches(file_name, '^(\\d{{4}}[A-Za-z]{{3}}\\d{{1,2}})-(\\d{{4}}[A-Za-z]{{3}}\\d{{1,2}})CustomUnifiedTransaction\\.csv')""")
def q_file_filter_unified(spark, d):
    return FL.filter_form(B.file_listing(spark, d), "unified").select("o_orderkey", "market", "file_name")


@query("file_filter_plain", f"""
SELECT o_orderkey, market, file_name FROM {_LIST}
WHERE regexp_matches(file_name, '^(\\d{{4}}[A-Za-z]{{3}}\\d{{1,2}})-(\\d{{4}}[A-Za-z]{{3}}\\d{{1,2}})CustomTransaction\\.csv')""")
def q_file_filter_plain(spark, d):
    return FL.filter_form(B.file_listing(spark, d), "plain").select("o_orderkey", "market", "file_name")


@query("file_filter_landed", f"""
SELECT o_orderkey, file_name, regexp_extract(file_name, '^([a-z]+)_sales_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.csv', 1) AS country,
       CAST(regexp_extract(file_name, '^([a-z]+)_sales_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.csv', 2) AS DATE) AS report_date
FROM {_LIST} WHERE regexp_matches(file_name, '^([a-z]+)_sales_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.csv')""")
def q_file_filter_landed(spark, d):
    pat = FL.PATTERNS["landed"]
    df = FL.filter_form(B.file_listing(spark, d), "landed")
    return df.select("o_orderkey", "file_name", F.regexp_extract("file_name", pat, 1).alias("country"),
                     F.to_date(F.regexp_extract("file_name", pat, 2)).alias("report_date"))


_UNI_RE = "(\\d{4}[A-Za-z]{3}\\d{1,2})-(\\d{4}[A-Za-z]{3}\\d{1,2})CustomUnifiedTransaction\\.csv"
_PLAIN_RE = "(\\d{4}[A-Za-z]{3}\\d{1,2})-(\\d{4}[A-Za-z]{3}\\d{1,2})CustomTransaction\\.csv"


@query("latest_file_by_mtime", f"""
SELECT market, max({{'m': modified, 'f': file_name}}).f AS file_name, max({{'m': modified, 'f': file_name}}).m AS modified
FROM {_LIST} WHERE regexp_matches(file_name, '^{_UNI_RE}') GROUP BY market""")
def q_latest_file_by_mtime(spark, d):
    return FL.latest_by_mtime(FL.filter_form(B.file_listing(spark, d), "unified"))


@query("latest_file_by_name_date", f"""
SELECT market, max({{'s': sd, 'f': file_name}}).f AS file_name, max({{'s': sd, 'f': file_name}}).s AS start_date
FROM (SELECT market, file_name, CAST(try_strptime(regexp_extract(file_name, '{_UNI_RE}', 1), '%Y%b%d') AS DATE) AS sd
      FROM {_LIST}) WHERE sd IS NOT NULL GROUP BY market""")
def q_latest_file_by_name_date(spark, d):
    return FL.latest_by_name_date(B.file_listing(spark, d), "unified")


def _manifest(spark, d):
    ls = B.file_listing(spark, d)
    return ls.filter(F.col("modified") < F.lit(B.MANIFEST_BEFORE).cast("timestamp_ntz")).select("file_name")


@query("new_files_anti", f"""
SELECT market, count(*) FILTER (WHERE regexp_matches(file_name, '^{_PLAIN_RE}')) AS new_files,
       coalesce(bool_or(regexp_matches(file_name, '^{_PLAIN_RE}')), FALSE) AS any_new
FROM {_LIST} l WHERE file_name NOT IN (SELECT file_name FROM {_LIST} WHERE modified < TIMESTAMP '{B.MANIFEST_BEFORE}')
GROUP BY market""")
def q_new_files_anti(spark, d):
    return FL.new_files(B.file_listing(spark, d), _manifest(spark, d), "plain")


@query("landed_name", f"""
SELECT o_orderkey, file_name, sd AS report_date,
       CASE WHEN sd IS NOT NULL THEN country || '_sales_' || strftime(sd, '%Y-%m-%d') || '.csv' END AS landed_name
FROM (SELECT *, CAST(try_strptime(regexp_extract(file_name, '{_PLAIN_RE}', 1), '%Y%b%d') AS DATE) AS sd
      FROM {_LIST} WHERE ends_with(file_name, 'CustomTransaction.csv'))""")
def q_landed_name(spark, d):
    return FL.landed_name(B.file_listing(spark, d)).select("o_orderkey", "file_name", "report_date", "landed_name")


# ---------------------------------------------------------------- ingest

@query("ingest_manifest_keys", f"""
WITH l AS (SELECT *, '/land/' || market || '/' || file_name AS path, o_orderkey AS size FROM {_LIST}),
seen AS (SELECT DISTINCT market, path, size, modified FROM l WHERE modified < TIMESTAMP '{B.MANIFEST_BEFORE}')
SELECT o_orderkey, market, file_name, substr(sha256(market || '|' || path), 1, 32) AS file_id,
       CAST(size AS VARCHAR) || '-' || strftime(modified, '%Y%m%d%H%M%S.%f') AS version
FROM l WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.market = l.market AND s.path = l.path AND s.size = l.size
                           AND s.modified = l.modified)
  AND (regexp_full_match(file_name, '{_UNI_RE}') OR regexp_full_match(file_name, '{_PLAIN_RE}')
       OR regexp_full_match(file_name, '([a-z]+)_sales_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.csv'))""")
def q_ingest_manifest_keys(spark, d):
    """New report files by market and path; names repeat across markets, versions within one."""
    ls = B.landed_listing(spark, d)
    seen = FL.fresh_files(ls.filter(F.col("modified") < F.lit(B.MANIFEST_BEFORE).cast("timestamp_ntz")), None)
    return FL.fresh_files(ls, seen).select("o_orderkey", "market", "file_name", "file_id", "version")


# Report lines by line number: blank second cell, either header, preamble with and without a comma, a row too wide.
_SPLIT_CELLS = {
    "_c0": "CASE l_linenumber WHEN 3 THEN 'date/time' WHEN 4 THEN 'Datum/Uhrzeit' WHEN 5 THEN 'All amounts in EUR' "
           "ELSE concat('day ', CAST(l_orderkey AS {text})) END",
    "_c1": "CASE l_linenumber WHEN 2 THEN NULL WHEN 5 THEN NULL ELSE CAST(l_partkey AS {text}) END",
    "_c2": "CASE l_linenumber WHEN 5 THEN NULL ELSE l_returnflag END",
    "_c3": "CASE l_linenumber WHEN 6 THEN 'more' END",
}


@query("report_rows_split", f"""
SELECT l_orderkey, l_linenumber, {', '.join(f'{x.format(text="VARCHAR")} AS {c}' for c, x in _SPLIT_CELLS.items())},
       CASE l_linenumber WHEN 3 THEN 'header' WHEN 4 THEN 'header' WHEN 5 THEN 'preamble' WHEN 6 THEN 'wide'
            ELSE 'data' END AS kind FROM {_LINE}""")
def q_report_rows_split(spark, d):
    from tillroll.sources.reports import report_rows
    cells = [F.expr(x.format(text="string")).alias(c) for c, x in _SPLIT_CELLS.items()]
    return report_rows(B.line_tx(spark, d).select("l_orderkey", "l_linenumber", *cells), 3)


@query("ingest_status", f"""
SELECT m.market, count(DISTINCT l_returnflag) AS files,
       count(*) FILTER (WHERE l_linenumber <> 7) AS "rows", count(*) FILTER (WHERE l_linenumber = 7) AS bad_dates,
       CAST(0 AS BIGINT) AS wide_rows, count(*) FILTER (WHERE l_linenumber = 6) AS null_amounts
FROM {_LINE} CROSS JOIN (VALUES {', '.join(f"('{v}')" for v in _MARKETS.values())}) m(market) GROUP BY m.market""")
def q_ingest_status(spark, d):
    """The ingest job's own record of the EU markets' report files (one per return flag, at full width): every line
    number 7 has no readable date, every line number 6 no readable amount. A market's files land when its turn comes,
    and go when they are taken."""
    from tillroll.plans.daily import MarketSource, file_states
    land, table = _written(spark, "land"), _written(spark, "clean")
    for p, m in _MARKETS.items():
        _report_files(spark, d, p, f"{land}/{p}", spoil=True)
        _ingest(spark, [MarketSource(m, p, f"{land}/{p}")], table)
        remove_folder(spark, f"{land}/{p}")
    counts = [F.sum(c).alias(c) for c in ("rows", "bad_dates", "wide_rows", "null_amounts")]
    return (file_states(spark, table).filter("state = 'taken'").groupBy("market")
            .agg(F.count("*").alias("files"), *counts))


#: The landed report files' names by return flag.
_REPORTS = {flag: f"market_sales_2025-03-0{k}.csv" for k, flag in enumerate("ANR", 1)}


def _report_files(spark, d, profile: str, folder: str, only=None, spoil: bool = False, flags="ANR") -> None:
    """One report file per return flag, as landed names; ``only`` filters the line items."""
    from tillroll.sources.sinks import publish_file
    line = F.col("l_linenumber")
    for flag in flags:
        tx = B.line_tx(spark, d).filter(F.col("l_returnflag") == flag)
        rep = B.raw_report_from(tx if only is None else tx.filter(only), profile, keep=["l_linenumber"])
        if spoil:
            day, amount = B.raw_header(profile, "date_time"), B.raw_header(profile, "product_sales")
            rep = rep.withColumns({day: F.when(line == 7, F.lit("n/a")).otherwise(F.col(day)),
                                   amount: F.when(line == 6, F.lit("n/a")).otherwise(F.col(amount))})
        publish_file(rep.drop("l_linenumber"), folder, _REPORTS[flag])


def _ingest(spark, sources, table: str, **kw) -> None:
    from tillroll.plans.daily import ingest_status
    failed = [r["error"] for r in ingest_status(spark, sources, table, **kw) if r["error"]]
    if failed:
        raise RuntimeError("; ".join(failed))


@query("ingest_clean_us", B.clean_expected_sql("us", with_asin=True))
def q_ingest_clean_us(spark, d):
    """Report files of 30 columns through the job, with the SKU lookup; every file arrives short
    first and whole in its second version, which replaces the first. Files come one by one and go when taken."""
    from tillroll.plans.daily import MarketSource, read_clean
    land, table = _written(spark, "land"), _written(spark, "clean")
    for flag in _REPORTS:
        for only in ("l_linenumber < 3", None):
            _report_files(spark, d, "us", land, only, flags=flag)
            _ingest(spark, [MarketSource("US", "us", land)], table, sku_dim=_sku_dim(spark, d))
        remove_folder(spark, land)
    return read_clean(spark, table).drop("file_id", "version", "run_id", "market", "report_date", "source_file")


@query("ingest_day_totals", f"""
SELECT 'EU - Germany' AS market, CAST(ts AS DATE) AS date, CAST(sum(ps) AS DECIMAL(22,2)) AS cents FROM {_LINE}
WHERE l_linenumber > 2 GROUP BY CAST(ts AS DATE)""")
def q_ingest_day_totals(spark, d):
    """A1: day totals after every file was replaced by a version without its first two lines per order: the old
    version's rows go out as negative deltas, the new one's come in. Files come one by one and go when taken."""
    from tillroll.plans.daily import MarketSource, read_day_totals
    land, table = _written(spark, "land"), _written(spark, "clean")
    for flag in _REPORTS:
        for only in (None, "l_linenumber > 2"):
            _report_files(spark, d, "de", land, only, flags=flag)
            _ingest(spark, [MarketSource("EU - Germany", "de", land)], table, day_table=f"{table}_days")
        remove_folder(spark, land)
    return read_day_totals(spark, f"{table}_days")


# ---------------------------------------------------------------- files written and read back

def _written(spark, name: str) -> str:
    """A new path in the shared folder."""
    return scratch_path(spark, name)


@query("read_master", _raw_select("us", lambda c: B.raw_header("us", c)))
def q_read_master(spark, d):
    """A master CSV read back as text, column by column. It is written compressed, in files of a bounded number
    of lines, as each is then read by one task."""
    from tillroll.sources.reports import read_master
    path = _written(spark, "master")
    (B.raw_report(spark, d, "us").write.option("header", True).option("compression", "gzip")
     .option("maxRecordsPerFile", 2_000_000).csv(path))
    return read_master(spark, path)


# Part columns as a master sheet writes them: whole numbers with gaps, decimals, mixed forms, dates, flags, padded codes.
_MASTER = {
    "part": "CAST(p_partkey AS {text})",
    "size": "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_size AS {text}) END",
    "price": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS {text})",
    "half": "CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS {text}) ELSE concat(CAST(p_partkey AS {text}), '.5') END",
    "mixed": "CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE CAST(p_partkey AS {text}) END",
    "code": "lpad(CAST(p_partkey AS {text}), 9, '0')",
    "day": "CAST(DATE '2024-01-01' + CAST(p_partkey % 300 AS INT) AS {text})",
    "big": "CASE WHEN p_size > 25 THEN 'true' ELSE 'FALSE' END",
    "name": "p_name",
    "blank": "''",
}
_MASTER_SQL = f"SELECT {', '.join(x.format(text="VARCHAR") + ' AS ' + c for c, x in _MASTER.items())} FROM part"


def _infer_sql(c: str) -> str:
    """One column's type: the first in the list that fits every value that is there."""
    fits = {"bigint": "'-?(0|[1-9][0-9]{0,17})'", "double": "'-?(0|[1-9][0-9]*)?(\\.[0-9]+)?'",
            "boolean": "'(?i)(true|false)'", "date": "'[0-9]{4}-[0-9]{2}-[0-9]{2}'"}
    cases = " ".join(f"WHEN bool_and(regexp_full_match({c}, {p})) THEN '{t}'" for t, p in fits.items())
    return f"SELECT '{c}' AS column_name, CASE {cases} ELSE 'string' END AS type FROM m WHERE {c} <> ''"


@query("master_types", f"WITH m AS ({_MASTER_SQL}) " + " UNION ALL ".join(_infer_sql(c) for c in _MASTER))
def q_master_types(spark, d):
    """The types of a master sheet's columns, inferred from all their values."""
    from tillroll.sources.infer import infer_types
    from tillroll.sources.reports import read_master
    return infer_types(read_master(spark, _master_file(spark, d)))


def _master_file(spark, d) -> str:
    path = _written(spark, "master")
    (load_table(spark, d, "part").select(*[F.expr(x.format(text="string")).alias(c) for c, x in _MASTER.items()])
     .write.option("header", True).csv(path))
    return path


@query("read_master_typed", f"""
SELECT CAST(part AS BIGINT) AS part, CASE WHEN size <> '' THEN CAST(size AS BIGINT) END AS size, CAST(price AS DOUBLE) AS price,
       CAST(half AS DOUBLE) AS half, mixed, code, CAST(day AS DATE) AS day, lower(big) = 'true' AS big, name
FROM ({_MASTER_SQL})""")
def q_read_master_typed(spark, d):
    """The master sheet read with its inferred types."""
    from tillroll.sources.reports import read_master
    return read_master(spark, _master_file(spark, d), types=True).drop("blank")


@query("publish_status", """
SELECT o_orderpriority || '.csv' AS name, o_orderpriority <> '5-LOW' AS ok,
       CASE WHEN o_orderpriority <> '5-LOW' THEN count(*) ELSE 0 END AS "rows",
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(sum(o_orderkey) AS BIGINT) END AS keys FROM orders GROUP BY o_orderpriority""")
def q_publish_status(spark, d):
    """One flat file per order priority, of which one fails; the status table beside what the files hold."""
    from tillroll.sources.sinks import publish_all
    path = _written(spark, "published")
    orders = load_table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    names = [r[0] for r in orders.select("o_orderpriority").distinct().collect()]      # five priorities
    broken = F.when(F.col("o_orderpriority") == "5-LOW", F.raise_error(F.lit("no report"))).otherwise(F.col("o_orderstatus"))
    frames = {f"{n}.csv": orders.filter(F.col("o_orderpriority") == n).withColumn("o_orderstatus", broken) for n in names}
    publish_all(frames, path, status_path=f"{path}_status", flat=True)
    held = (spark.read.schema("o_orderkey long, o_orderpriority string, o_orderstatus string").option("header", True).csv(path)
            .groupBy(F.concat("o_orderpriority", F.lit(".csv")).alias("name"))
            .agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys")))
    return spark.read.parquet(f"{path}_status").join(held, "name", "left").select(
        "name", "ok", F.coalesce("rows", F.lit(0)).alias("rows"), "keys")


@query("overwrite_clean", """
SELECT o_orderkey, o_orderpriority AS market,
       CASE WHEN o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders""")
def q_overwrite_clean(spark, d):
    """K2: one market of a clean table written again; the others' partitions stay."""
    from tillroll.sources.sinks import overwrite_clean
    path = _written(spark, "clean")
    rows = load_table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("market"), F.col("o_totalprice").alias("amount"))
    overwrite_clean(rows, path)
    overwrite_clean(rows.filter("market = '1-URGENT'").withColumn("amount", -F.col("amount")), path)
    return spark.read.parquet(path)


@query("dated_extract", f"""
SELECT {_ORDER_ID_SQL} AS order_id, CAST(ps AS DECIMAL(18,0)) AS cents,
       CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS report_date FROM {_LINE}""")
def q_dated_extract(spark, d):
    """K3: extracts by date as CSV, read back (the month plays the report date)."""
    from tillroll.sources.sinks import write_dated_extract
    path = _written(spark, "extract")
    write_dated_extract(B.line_tx(spark, d).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"), F.col("ps").alias("cents"),
        F.trunc(F.to_date("ts"), "MM").alias("report_date")), path)
    return spark.read.schema("order_id string, cents decimal(18,0), report_date date").option("header", True).csv(path)


@query("cutoff_in_month", """
SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS cutoff FROM orders""")
def q_cutoff_in_month(spark, d):
    day = F.col("o_orderdate")
    return load_table(spark, d, "orders").select(
        "o_orderkey", X.cutoff_in_month(F.year(day), F.month(day), F.dayofmonth(day)).alias("cutoff"))
