"""Summary of a report date: group rows, group total, other rows, grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.locales import DEFAULT_GROUP
from tillroll.functions.scalars import cents_to_amount, money_format, to_cents

MEASURES = ["actual_sales", "estimated_sales", "total_estimation"]

# Symbols and table styling of the summary as the source report shows it.
GROUP_CURRENCY = "€"
OTHER_CURRENCY = "$"
CELL_STYLE = "padding: 8px; border: 1px solid #ddd;"
GROUP_TOTAL_STYLE = "background-color: #f9f9f9; font-weight: bold;"
GRAND_TOTAL_STYLE = "background-color: #e6f2ff; font-weight: bold;"

# Row order of the report.
ORD_GROUP_ROW, ORD_GROUP_TOTAL, ORD_OTHER_ROW, ORD_GRAND_TOTAL = 1, 2, 3, 4


def summary(results: DataFrame, group: str = DEFAULT_GROUP) -> DataFrame:
    """Per report date: each market, the group subtotal (always, 0 when the group is
    empty), and the grand total of every market (currencies added as they are).

    Each result row is expanded to itself, its share of the group total (0
    outside the group) and its share of the grand total, and all are summed
    in one aggregate, so ``results`` is read once. Sums run over exact
    cents. ``currency`` tells which symbol a row shows. ``results`` is keyed by
    (report_date, market); rows that repeat a key add up.
    """
    flag = F.col("market").contains(group)
    cents = results.select("report_date", "market", flag.alias("g"),
                           *[to_cents(m).alias(m) for m in MEASURES])

    def share(order, market, currency, keep=None):
        return F.struct(order.cast("int").alias("ord"), market.alias("market"), currency.alias("currency"),
                        *[(F.when(keep, F.col(m)).otherwise(F.lit(0)) if keep is not None else F.col(m)).alias(m)
                          for m in MEASURES])

    g = F.col("g")
    parts = F.array(
        share(F.when(g, F.lit(ORD_GROUP_ROW)).otherwise(F.lit(ORD_OTHER_ROW)), F.col("market"),
              F.when(g, F.lit(GROUP_CURRENCY)).otherwise(F.lit(OTHER_CURRENCY))),
        share(F.lit(ORD_GROUP_TOTAL), F.lit(f"Total {group}"), F.lit(GROUP_CURRENCY), g),
        share(F.lit(ORD_GRAND_TOTAL), F.lit("Grand Total"), F.lit(OTHER_CURRENCY)))
    rows = cents.select("report_date", F.explode(parts).alias("t")).select("report_date", "t.*")
    out = rows.groupBy("report_date", "ord", "market", "currency").agg(*[F.sum(m).alias(m) for m in MEASURES])
    return out.select("report_date", "ord", "market", "currency",
                      *[cents_to_amount(m).alias(m) for m in MEASURES])


def money_columns(summary_df: DataFrame) -> DataFrame:
    """The three figures as money text with the row's currency symbol."""
    return summary_df.select("report_date", "ord", "market",
                             *[money_format(m, F.col("currency")).alias(f"{m}_text") for m in MEASURES])


_CELL = f'<td style="{CELL_STYLE}">'


def html_rows(summary_df: DataFrame) -> DataFrame:
    """K9: one HTML table row per summary row, ``(report_date, ord, market, html)``.

    The document of a date is its rows in (ord, market) order between a fixed
    head and foot (see ``tillroll.sources.sinks.write_report_html``).
    """
    m = money_columns(summary_df)
    total = F.col("ord").isin(ORD_GROUP_TOTAL, ORD_GRAND_TOTAL)
    style = (F.when(F.col("ord") == ORD_GROUP_TOTAL, F.lit(f' style="{GROUP_TOTAL_STYLE}"'))
             .when(F.col("ord") == ORD_GRAND_TOTAL, F.lit(f' style="{GRAND_TOTAL_STYLE}"'))
             .otherwise(F.lit("")))
    last = F.when(total, F.col("total_estimation_text")).otherwise(
        F.concat(F.lit("<strong>"), F.col("total_estimation_text"), F.lit("</strong>")))
    html = F.concat(F.lit("<tr"), style, F.lit(">"),
                    F.lit(_CELL), F.col("market"), F.lit("</td>"),
                    F.lit(_CELL), F.col("actual_sales_text"), F.lit("</td>"),
                    F.lit(_CELL), F.col("estimated_sales_text"), F.lit("</td>"),
                    F.lit(_CELL), last, F.lit("</td></tr>"))
    return m.select("report_date", "ord", "market", html.alias("html"))
