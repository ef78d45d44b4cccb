"""Binding of the report notions to the driver's TPC-H-like tables.

Each binding is a Spark derivation of the given tables (so its work grows
with them) and, where an oracle needs the same rows, a DuckDB SQL mirror of
the same derivation. Line items play settlement transactions; orders play
day-level sales; order priority, event type or region/nation play markets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.locales import PROFILES
from tillroll.session import compiled_rows, load_table

# Cutoffs used by the queries (parameters, never the clock).
CUTOFF = "1998-06-16"             # mid-month: report 1998-06-15
CUTOFF_FIRST = "1998-07-01"       # first of month: report closes June
CUTOFF_EVENTS_DEEP = "2024-01-31"  # events: 4 and 5 days per weekday
CUTOFF_EVENTS_SHALLOW = "2024-01-25"  # events: 3 and 4 days per weekday
EU_PREFIX = "EUROPE"              # group of markets in the multi-market binding

NBSP = "\u00a0"


# -- day-level sales -------------------------------------------------------

def orders_tx(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("market"), F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("amount"))


ORDERS_TX_SQL = ("SELECT o_orderpriority AS market, CAST(o_orderdate AS DATE) AS d, "
                 "CAST(round(o_totalprice * 10000) AS BIGINT) * 0.01 AS cents FROM orders")


def thirds_tx(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose amounts are a third of the price: most have parts of a cent."""
    return orders_tx(spark, d).withColumn("amount", F.col("amount") / F.lit(3.0))


THIRDS_TX_SQL = ("SELECT o_orderpriority AS market, CAST(o_orderdate AS DATE) AS d, "
                 "CAST(round(o_totalprice / 3.0::DOUBLE * 10000) AS BIGINT) * 0.01 AS cents FROM orders")


def no_sunday_tx(spark: SparkSession, d: str) -> DataFrame:
    """Orders with one market that has no Sundays: its Sunday orders count on the Monday after."""
    moved = (F.col("market") == "1-URGENT") & (F.dayofweek("date") == 1)
    return orders_tx(spark, d).withColumn(
        "date", F.when(moved, F.date_add(F.to_date("date"), 1)).otherwise(F.to_date("date")))


NO_SUNDAY_TX_SQL = ("SELECT market, CASE WHEN market = '1-URGENT' AND dayofweek(d) = 0 THEN d + 1 ELSE d END AS d, "
                    f"cents FROM ({ORDERS_TX_SQL})")


def events_tx(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "events").select(
        F.col("event_type").alias("market"), F.col("ts").alias("date"),
        F.col("value").alias("amount"))


EVENTS_TX_SQL = ("SELECT event_type AS market, CAST(ts AS DATE) AS d, "
                 "CAST(round(value * 10000) AS BIGINT) * 0.01 AS cents FROM events")


def region_tx(spark: SparkSession, d: str) -> DataFrame:
    """Orders with market = '<region> - <nation>' of the customer.

    No side is hinted: Catalyst and AQE broadcast one only when its measured
    size allows.
    """
    o = load_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = load_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = load_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load_table(spark, d, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
    tx = o.join(cust, o.o_custkey == cust.c_custkey, "inner")
    return tx.select(F.concat_ws(" - ", "r_name", "n_name").alias("market"),
                     F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("amount"))


REGION_TX_SQL = ("SELECT concat_ws(' - ', r_name, n_name) AS market, CAST(o_orderdate AS DATE) AS d, "
                 "CAST(round(o_totalprice * 10000) AS BIGINT) * 0.01 AS cents FROM orders "
                 "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
                 "JOIN region ON n_regionkey = r_regionkey")


# -- transactions (line items) ---------------------------------------------

_TS_SECS = "(l_orderkey * 7919 + l_linenumber * 104729) % 86400"


def line_tx(spark: SparkSession, d: str) -> DataFrame:
    """Line items as settlement transactions, money in exact cents."""
    li = load_table(spark, d, "lineitem")
    ep = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return li.select(
        F.expr(f"l_shipdate + make_dt_interval(0, 0, 0, {_TS_SECS})").alias("ts"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("qty"),
        ep.alias("ps"),
        F.expr("cast(round(l_tax * 100) as bigint)").alias("tax_pct"),
    ).select(
        "*",
        F.expr("ps * tax_pct div 100").alias("tax"),
        F.expr("ps * 15 div 100").alias("fee"),
    ).withColumn("tot", F.col("ps") + F.col("tax") - F.col("fee"))


LINE_TX_SQL = f"""
SELECT ts, l_orderkey, l_linenumber, l_partkey, l_returnflag, qty, ps, tax_pct,
       ps * tax_pct // 100 AS tax, ps * 15 // 100 AS fee,
       ps + ps * tax_pct // 100 - ps * 15 // 100 AS tot
FROM (SELECT l_shipdate + to_seconds({_TS_SECS}) AS ts, l_orderkey, l_linenumber, l_partkey,
             l_returnflag, CAST(l_quantity AS BIGINT) AS qty,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS ps,
             CAST(round(l_tax * 100) AS BIGINT) AS tax_pct
      FROM lineitem)
"""


#: ``00`` to ``99``: a constant array, so two digits take no number formatting.
TWO_DIGITS = " ".join(f"{k:02d}" for k in range(100))


def _whole_and_rest(c: str):
    """Sign, whole units and two digits of cents, by integer arithmetic."""
    v = F.col(c)
    a = F.abs(v)
    return (F.when(v < 0, F.lit("-")).otherwise(F.lit("")), F.call_function("div", a, F.lit(100)),
            F.get(F.split(F.lit(TWO_DIGITS), " "), (a % 100).cast("int")))


def _money_us(c: str):
    sign, whole, rest = _whole_and_rest(c)
    return F.concat(sign, whole.cast("string"), F.lit("."), rest)


def grouped_digits(v, sep: str):
    """Non-negative integer (< 10^18) -> digits with a separator every three places.

    Up to six digits are cut by arithmetic; more are zero-padded to 18 digits, of which six
    groups are joined and leading zeros and separators trimmed.
    """
    padded = F.lpad(v.cast("string"), 18, "0")
    groups = F.concat_ws(sep, *[F.substring(padded, 1 + 3 * k, 3) for k in range(6)])
    return (F.when(v < 1000, v.cast("string"))
            .when(v < 1000000, F.concat(F.call_function("div", v, F.lit(1000)).cast("string"), F.lit(sep),
                                        F.lpad((v % 1000).cast("string"), 3, "0")))
            .otherwise(F.ltrim(groups, F.lit("0" + sep))))


def money_text(c: str, thousands: str, decimal: str):
    """Cents -> ``-1.234,56`` style text by integer arithmetic (no per-row formatter)."""
    sign, whole, rest = _whole_and_rest(c)
    return F.concat(sign, grouped_digits(whole, thousands), F.lit(decimal), rest)


def _money_eu(c: str):
    return money_text(c, ".", ",")


def _date_text(profile: str, ts: str = "ts", sep_col=None):
    t = F.col(ts)
    if profile in ("us", "us2"):
        return F.concat(F.date_format(t, "MMM d, yyyy h:mm:ss a"), F.lit(" PST"))
    if profile == "de":
        return F.concat(F.date_format(t, "dd.MM.yyyy HH:mm:ss"), F.lit(" UTC"))
    months = F.array(*[F.lit(m) for m in PROFILES[profile].months])
    sep = sep_col if sep_col is not None else F.lit(" ")
    return F.concat(F.dayofmonth(t).cast("string"), sep, F.element_at(months, F.month(t)), sep,
                    F.year(t).cast("string"), F.lit(" "), F.date_format(t, "HH:mm:ss"), F.lit(" UTC"))


# Columns of the generated reports, canonical names in report order: all that a report of the EU (27)
# and of the US (30) holds.
US_ONLY = ["account_type", "Regulatory_Fee", "Tax_On_Regulatory_Fee"]
REPORT_COLUMNS_US = ["date_time"] + [c for c in PROFILES["us2"].columns if c not in ("date", "time", "weekday")]
REPORT_COLUMNS = [c for c in REPORT_COLUMNS_US if c not in US_ONLY]

# Money columns of a report by the line's values, in cents (both engines read these expressions).
MONEY_CENTS = {
    "product_sales": "ps", "product_sales_tax": "tax", "shipping_credits": "qty * 12",
    "shipping_credits_tax": "qty", "gift_wrap_credits": "l_linenumber * 110", "giftwrap_credits_tax": "l_linenumber * 9",
    "Regulatory_Fee": "l_linenumber * 25", "Tax_On_Regulatory_Fee": "l_linenumber * 2",
    "promotional_rebates": "-(qty * 31)", "promotional_rebates_tax": "-(qty * 3)", "marketplace_withheld_tax": "-tax",
    "selling_fees": "-fee", "fba_fees": "-(qty * 350)", "other_transaction_fees": "-l_linenumber",
    "other": "l_linenumber * 100000", "total": "tot",
}
# Text columns likewise.
TEXT_SQL = {
    "settlement_id": "CAST(l_orderkey AS {text})",
    "type": "CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Order' END",
    "order_id": "concat(CAST(l_orderkey AS {text}), '-', CAST(l_linenumber AS {text}))",
    "sku": "CAST(l_partkey AS {text})", "description": "concat('part ', CAST(l_partkey AS {text}))",
    "account_type": "'Standard Orders'", "fulfillment": "'Amazon'",
    "order_city": "concat('City ', CAST(qty AS {text}))", "order_state": "l_returnflag",
    "order_postal": "concat('0', CAST(l_partkey AS {text}))", "tax_collection_model": "'MarketplaceFacilitator'",
}


def report_columns(profile: str) -> list[str]:
    return REPORT_COLUMNS_US if profile in ("us", "us2") else REPORT_COLUMNS


_RAW_DATE_HEADER = {"us": "date/time", "us2": "date/time", "de": "Datum/Uhrzeit",
                    "it": "Data/Ora:", "es": "fecha y hora", "fr": "date/heure"}

MARKETPLACE = {"us": "Amazon.com", "us2": "Amazon.com", "de": "Amazon.de", "it": "Amazon.it",
               "es": "Amazon.es", "fr": "Amazon.fr"}


def raw_header(profile: str, canonical: str) -> str:
    """The header as a report writes it (before normalizing)."""
    if canonical == "date_time":
        return _RAW_DATE_HEADER[profile]
    headers = PROFILES[profile].headers
    if not headers:
        return canonical.replace("_", " ")
    local = next(k for k, v in headers.items() if v == canonical)
    return local.replace("_", " ")


def raw_report(spark: SparkSession, d: str, profile: str, with_duplicate_header: bool = False) -> DataFrame:
    """A settlement report as written by one market: localized headers, all text.

    In French reports every line with line number 2 uses no-break spaces
    around the month. With ``with_duplicate_header`` a second date column
    ``date time`` (junk text) follows the first; both normalize to
    ``date_time`` and the first must win.
    """
    return raw_report_from(line_tx(spark, d), profile, with_duplicate_header)


def raw_report_from(tx: DataFrame, profile: str, with_duplicate_header: bool = False,
                    keep=()) -> DataFrame:
    """``raw_report`` over a given ``line_tx`` frame; ``keep`` columns ride along."""
    compiled_rows(tx.sparkSession)
    eu = profile not in ("us", "us2")
    money = _money_eu if eu else _money_us
    sep = F.when(F.col("l_linenumber") == 2, F.lit(NBSP)).otherwise(F.lit(" ")) if profile == "fr" else None
    values = {c: F.expr(x.format(text="string")) for c, x in TEXT_SQL.items()}
    values |= {"date_time": _date_text(profile, sep_col=sep), "quantity": F.col("qty").cast("string"),
               "marketplace": F.lit(MARKETPLACE[profile])}
    tx = tx.withColumns({f"_{c}": F.expr(x).cast("bigint") for c, x in MONEY_CENTS.items()})
    values |= {c: money(f"_{c}") for c in MONEY_CENTS}
    cols = []
    for c in report_columns(profile):
        cols.append(values[c].alias(raw_header(profile, c)))
        if c == "date_time" and with_duplicate_header:
            cols.append(F.lit("not a date").alias("date time"))
    return tx.select(*cols, *keep)


def raw_text_sql(profile: str) -> dict[str, str]:
    """The text of each column of a raw report, by canonical name, for DuckDB."""
    eu = profile not in ("us", "us2")
    out = {c: x.format(text="VARCHAR") for c, x in TEXT_SQL.items()}
    out |= {"date_time": date_text_sql(profile), "quantity": "CAST(qty AS VARCHAR)",
            "marketplace": f"'{MARKETPLACE[profile]}'"}
    out |= {c: money_text_sql(f"CAST({x} AS BIGINT)", eu) for c, x in MONEY_CENTS.items()}
    return {c: out[c] for c in report_columns(profile)}


def clean_expected_sql(profile: str, with_asin: bool = False) -> str:
    """Oracle: the canonical rows a cleaner must return, read from the source values."""
    cols = ["CAST(ts AS DATE) AS date", "strftime(ts, '%H:%M:%S') AS time", "dayname(ts) AS weekday"]
    if with_asin:
        cols.append("dim.asin AS ASIN")
    for c in report_columns(profile):
        if c in MONEY_CENTS:
            value = f"CAST(CAST({MONEY_CENTS[c]} AS DOUBLE) / 100 AS DECIMAL(18,4))"
        elif c == "quantity":
            value = "CAST(qty AS DECIMAL(18,4))"
        elif c == "marketplace":
            value = f"'{MARKETPLACE[profile]}'"
        elif c != "date_time":
            value = TEXT_SQL[c].format(text="VARCHAR")
        else:
            continue
        cols.append(f'{value} AS "{c}"')
    src = f"({LINE_TX_SQL}) t"
    if with_asin:
        src += f" LEFT JOIN ({SKU_DIM_FIRST_SQL}) dim ON CAST(t.l_partkey AS VARCHAR) = dim.sku"
    return f"SELECT {', '.join(cols)} FROM {src}"


# -- SKU dimension ---------------------------------------------------------

def sku_dim_raw(spark: SparkSession, d: str) -> DataFrame:
    """Material master sheet: ``(row_no, seller-sku, ASIN)``.

    Parts of size 45 and over are missing (their line items get no ASIN);
    parts of brand ``Brand#1`` appear twice, the later row with another ASIN,
    so the first row must win.
    """
    p = load_table(spark, d, "part").filter(F.col("p_size") < 45)
    asin = F.concat(F.lit("B0"), F.upper(F.lpad(F.hex(F.col("p_partkey") * 7919), 8, "0")))
    first = p.select((F.col("p_partkey") * 2).alias("row_no"),
                     F.col("p_partkey").cast("string").alias("seller-sku"), asin.alias("ASIN"))
    again = p.filter(F.col("p_brand") == "Brand#1").select(
        (F.col("p_partkey") * 2 + 1000000001).alias("row_no"),
        F.col("p_partkey").cast("string").alias("seller-sku"),
        F.concat(F.lit("BX"), F.col("p_partkey").cast("string")).alias("ASIN"))
    return first.unionByName(again)


SKU_DIM_RAW_SQL = """
SELECT p_partkey * 2 AS row_no, CAST(p_partkey AS VARCHAR) AS sku,
       'B0' || upper(lpad(hex(p_partkey * 7919), 8, '0')) AS asin
FROM part WHERE p_size < 45
UNION ALL
SELECT p_partkey * 2 + 1000000001, CAST(p_partkey AS VARCHAR), 'BX' || CAST(p_partkey AS VARCHAR)
FROM part WHERE p_size < 45 AND p_brand = 'Brand#1'
"""

SKU_DIM_FIRST_SQL = f"""
SELECT sku, asin FROM (
  SELECT sku, asin, row_number() OVER (PARTITION BY sku ORDER BY row_no) AS rk FROM ({SKU_DIM_RAW_SQL})
) WHERE rk = 1
"""


# -- text mirrors (DuckDB) of the report texts -------------------------------

def date_text_sql(profile: str, ts: str = "ts") -> str:
    if profile in ("us", "us2"):
        return f"strftime({ts}, '%b %-d, %Y %-I:%M:%S %p') || ' PST'"
    if profile == "de":
        return f"strftime({ts}, '%d.%m.%Y %H:%M:%S') || ' UTC'"
    months = ", ".join(f"'{m}'" for m in PROFILES[profile].months)
    sep = "(CASE WHEN l_linenumber = 2 THEN chr(160) ELSE ' ' END)" if profile == "fr" else "' '"
    return (f"CAST(day({ts}) AS VARCHAR) || {sep} || list_extract([{months}], month({ts})) || {sep} "
            f"|| CAST(year({ts}) AS VARCHAR) || ' ' || strftime({ts}, '%H:%M:%S') || ' UTC'")


def money_text_sql(cents: str, eu: bool) -> str:
    if eu:
        return f"translate(format('{{:,.2f}}', CAST({cents} AS DOUBLE) / 100), ',.', '.,')"
    return (f"(CASE WHEN {cents} < 0 THEN '-' ELSE '' END) || CAST(abs({cents}) // 100 AS VARCHAR) "
            f"|| '.' || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0')")


# -- results table ----------------------------------------------------------

URGENT = ("1-URGENT", "2-HIGH")


def region_orders(spark: SparkSession, d: str) -> DataFrame:
    o = load_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice",
                                              "o_orderpriority", "o_orderstatus")
    c = load_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = load_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load_table(spark, d, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
    return o.join(cust, o.o_custkey == cust.c_custkey, "inner").select(
        F.concat_ws(" - ", "r_name", "n_name").alias("market"), "r_name",
        F.to_date("o_orderdate").alias("report_date"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        "o_orderpriority", "o_orderstatus")


def _results_from(df: DataFrame) -> DataFrame:
    urgent = F.col("o_orderpriority").isin(*URGENT)
    agg = df.groupBy("report_date", "market").agg(
        F.sum("cents").alias("a"), F.coalesce(F.sum(F.when(urgent, F.col("cents"))), F.lit(0)).alias("e"))
    return agg.select("report_date", "market", (F.col("a") / F.lit(100.0)).alias("actual_sales"),
                      (F.col("e") / F.lit(100.0)).alias("estimated_sales"),
                      ((F.col("a") + F.col("e")) / F.lit(100.0)).alias("total_estimation"))


def results_table(spark: SparkSession, d: str) -> DataFrame:
    """A results table (report_date, market, three figures) derived from orders by nation."""
    return _results_from(region_orders(spark, d))


def results_rerun(spark: SparkSession, d: str, region: str, status: str) -> DataFrame:
    """A later run for one region's markets, counting only orders of one status."""
    ro = region_orders(spark, d)
    return _results_from(ro.filter((F.col("r_name") == region) & (F.col("o_orderstatus") == status)))


REGION_ORDERS_SQL = """
SELECT concat_ws(' - ', r_name, n_name) AS market, r_name, CAST(o_orderdate AS DATE) AS report_date,
       CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority, o_orderstatus
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""


def results_sql(where: str = "TRUE") -> str:
    return f"""
SELECT report_date, market, CAST(a AS DOUBLE) / 100 AS actual_sales, CAST(e AS DOUBLE) / 100 AS estimated_sales,
       CAST(a + e AS DOUBLE) / 100 AS total_estimation
FROM (SELECT report_date, market, CAST(sum(cents) AS BIGINT) AS a,
             CAST(coalesce(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN cents END), 0) AS BIGINT) AS e
      FROM ({REGION_ORDERS_SQL}) ro WHERE {where} GROUP BY report_date, market)"""


# -- file listing -------------------------------------------------------------

COUNTRIES = ["germany", "italy", "spain", "france"]


def file_listing(spark: SparkSession, d: str) -> DataFrame:
    """One report file per order: the form varies with the order key (7 variants:
    unified, plain, landed, unified with a bad month, 'copy of' + unified,
    unified + '.part', plain with a bad month)."""
    o = load_table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyyMMMd")
    bad = F.concat(F.year("o_orderdate").cast("string"), F.lit("Xyz"),
                   F.dayofmonth("o_orderdate").cast("string"))
    uni = F.concat(day, F.lit("-"), day, F.lit("CustomUnifiedTransaction.csv"))
    country = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    v = F.col("o_orderkey") % 7
    name = (F.when(v == 0, uni)
            .when(v == 1, F.concat(day, F.lit("-"), day, F.lit("CustomTransaction.csv")))
            .when(v == 2, F.concat(country, F.lit("_sales_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv")))
            .when(v == 3, F.concat(bad, F.lit("-"), bad, F.lit("CustomUnifiedTransaction.csv")))
            .when(v == 4, F.concat(F.lit("copy of "), uni))
            .when(v == 5, F.concat(uni, F.lit(".part")))
            .otherwise(F.concat(bad, F.lit("-"), day, F.lit("CustomTransaction.csv"))))
    modified = F.expr("o_orderdate + make_dt_interval(1, 0, 0, (o_orderkey * 7919) % 86400)")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("market"), name.alias("file_name"),
                    modified.alias("modified"), country.alias("country"))


FILE_LISTING_SQL = """
SELECT o_orderkey, o_orderpriority AS market, country,
       o_orderdate + INTERVAL 1 DAY + to_seconds((o_orderkey * 7919) % 86400) AS modified,
       CASE o_orderkey % 7
         WHEN 0 THEN uni
         WHEN 1 THEN dd || '-' || dd || 'CustomTransaction.csv'
         WHEN 2 THEN country || '_sales_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv'
         WHEN 3 THEN bad || '-' || bad || 'CustomUnifiedTransaction.csv'
         WHEN 4 THEN 'copy of ' || uni
         WHEN 5 THEN uni || '.part'
         ELSE bad || '-' || dd || 'CustomTransaction.csv' END AS file_name
FROM (SELECT *, dd || '-' || dd || 'CustomUnifiedTransaction.csv' AS uni
      FROM (SELECT o_orderkey, o_orderpriority, o_orderdate,
                   strftime(o_orderdate, '%Y%b%-d') AS dd,
                   CAST(year(o_orderdate) AS VARCHAR) || 'Xyz' || CAST(day(o_orderdate) AS VARCHAR) AS bad,
                   list_extract(['germany', 'italy', 'spain', 'france'], CAST(o_custkey % 4 + 1 AS INTEGER)) AS country
            FROM orders))"""


def landed_listing(spark: SparkSession, d: str) -> DataFrame:
    """``file_listing`` as files in one folder per market: the same name may lie in several."""
    ls = file_listing(spark, d)
    return ls.withColumns({"path": F.concat(F.lit("/land/"), "market", F.lit("/"), "file_name"),
                           "size": F.col("o_orderkey")})


# Files already seen before the run: everything modified before 1998.
MANIFEST_BEFORE = "1998-01-01"
