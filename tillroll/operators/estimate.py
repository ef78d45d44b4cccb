"""Month-end sales estimate: actuals to date plus a same-weekday forecast.

Money is exact inside the plan (ten-thousandths per transaction, cents with
two more places per day), so sums do not depend on the order in which partitions
are combined; a figure is rounded to cents once, half to even, when it leaves.

Plan shape of ``estimate`` (see ``explain``):
  1. scan -> partial hash agg on (market, date) -> shuffle -> final agg
     (the only shuffle over transactions; a hot market is pre-aggregated
     map-side, so it sends one row per (date, map task));
  2. shuffle the day totals on market (markets x days rows, not transactions);
     the weekday window, the per-weekday and the per-market aggregates all
     reuse that partitioning, so no further exchange is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.scalars import (cents_to_amount, div_round_half_even, to_units,
                                        units_to_cents, weekday_name, whole_cents)
from tillroll.operators.calendar import bounds, remaining_days_expr, remaining_weekday_count

# Weights of r0..r6 (newest first) in the mean of the cascading 4-day points,
# by history depth n, and the divisor that turns the weighted sum into the mean.
# p1=(r0+r1+r2+r3)/4, p2=(r1+r2+r3+r4)/4, p3=(r2+r3+r4+r5)/4,
# p4=(r3+r4+r5+r6+r0)/4 (five values over four, kept as the source does).
WEIGHTS = {
    4: ([1, 1, 1, 1, 0, 0, 0], 4),
    5: ([1, 2, 2, 2, 1, 0, 0], 8),
    6: ([1, 2, 3, 3, 2, 1, 0], 12),
    7: ([2, 2, 3, 4, 3, 2, 1], 16),
}
# Optional correction: p4 divided by five. Common divisor 80.
WEIGHTS_BIAS_CORRECTED_7 = ([9, 10, 15, 19, 14, 9, 4], 80)

DEPTH = 7


def _std(tx: DataFrame, market: str, date: str, amount: str) -> DataFrame:
    return tx.select(F.col(market).alias("market"), F.to_date(F.col(date)).alias("date"),
                     to_units(F.col(amount)).alias("units"))


def daily_cents(tx: DataFrame, market: str = "market", date: str = "date",
                amount: str = "amount", keep_null_dates: bool = False) -> DataFrame:
    """Day totals ``(market, date, cents)``, exact (``decimal(22,2)``); all-null days sum to 0."""
    day = (_std(tx, market, date, amount).groupBy("market", "date")
           .agg(units_to_cents(F.coalesce(F.sum("units"), F.lit(0))).alias("cents"), F.count("date").alias("_dated")))
    # by the count, not by the date: that filter would be pushed through the projections
    # which parse the date, and repeat all their expressions in one
    return (day if keep_null_dates else day.filter("_dated > 0")).drop("_dated")


def merge_day_totals(old: DataFrame | None, add: DataFrame) -> DataFrame:
    """Add new day totals to stored ones: ``(market, date, cents)`` plus ``month``.

    Day totals are additive, so an append-only transaction table never needs
    its history re-read: old + new, summed per (month, market, date).
    """
    add = add.withColumn("month", F.trunc("date", "MM"))
    both = add if old is None else add.unionByName(old.select("market", "date", "cents", "month"))
    return both.groupBy("month", "market", "date").agg(F.sum("cents").cast("decimal(22,2)").alias("cents"))


def daily_sales(tx: DataFrame, market: str = "market", date: str = "date",
                amount: str = "amount", cutoff=None) -> DataFrame:
    """``(market, date, weekday, amount)``; days before ``cutoff`` if given."""
    day = daily_cents(tx, market, date, amount)
    if cutoff is not None:
        day = day.filter(F.col("date") < F.lit(bounds(cutoff)["cutoff"]))
    return day.select("market", "date", weekday_name("date").alias("weekday"),
                      cents_to_amount("cents").alias("amount"))


def mtd_actual(tx: DataFrame, cutoff, market: str = "market", date: str = "date",
               amount: str = "amount") -> DataFrame:
    """A2/F1: month-to-date actual per market; a market without rows in range gives 0.

    The range is a filter on the date column itself, so it reaches the scan;
    the market list comes from a scan of that column alone.
    """
    b = bounds(cutoff)
    in_range = (F.col(date) >= F.lit(b["month_start"])) & (F.col(date) < F.lit(b["cutoff"]))
    sums = (_std(tx.filter(in_range), market, date, amount).groupBy("market")
            .agg(F.sum("units").alias("units")))
    markets = tx.select(F.col(market).alias("_m")).distinct()
    return (markets.join(sums, F.col("_m").eqNullSafe(F.col("market")), "left")
            .select(F.lit(b["report_date"]).alias("report_date"), F.col("_m").alias("market"),
                    cents_to_amount(whole_cents(units_to_cents(F.coalesce("units", F.lit(0)))))
                    .alias("actual_sales")))


def recent_weekdays(day: DataFrame, cutoff, depth: int = DEPTH) -> DataFrame:
    """The newest ``depth`` days with rows of each weekday before the cutoff.

    ``day`` is ``(market, date, cents)`` (markets x days rows). It is
    hash-partitioned by market once, which also serves the window on
    (market, weekday) and any later per-weekday or per-market aggregate.
    ``rn`` is 1 for the newest day; the filter on ``row_number`` is planned as
    a WindowGroupLimit.
    """
    b = bounds(cutoff)
    w = Window.partitionBy("market", "weekday").orderBy(F.col("date").desc())
    return (day.filter(F.col("date") < F.lit(b["cutoff"])).repartition("market")
            .withColumn("weekday", weekday_name("date"))
            .withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= depth))


def _weighted(n: int, weights=None) -> F.Column:
    ws, _ = weights or WEIGHTS[n]
    arr = F.array(*[F.lit(x) for x in ws])
    return F.sum(F.when(F.col("rn") <= n, F.col("cents") * F.element_at(arr, F.col("rn").cast("int"))))


def _average_cents(bias_corrected: bool = False) -> F.Column:
    """Weekday average in cents (half to even) from n and the weighted sums s4..s7."""
    d7 = WEIGHTS_BIAS_CORRECTED_7[1] if bias_corrected else WEIGHTS[7][1]
    n = F.col("n")
    return (F.when(n >= 7, div_round_half_even("s7", F.lit(d7)))
            .when(n == 6, div_round_half_even("s6", F.lit(WEIGHTS[6][1])))
            .when(n == 5, div_round_half_even("s5", F.lit(WEIGHTS[5][1])))
            .when(n == 4, div_round_half_even("s4", F.lit(WEIGHTS[4][1])))
            .otherwise(F.lit(0).cast("bigint")))


def _weekday_sums(bias_corrected: bool = False) -> list:
    w7 = WEIGHTS_BIAS_CORRECTED_7 if bias_corrected else None
    return [F.count("*").alias("n"), _weighted(4).alias("s4"), _weighted(5).alias("s5"),
            _weighted(6).alias("s6"), _weighted(7, w7).alias("s7")]


def cascading_points(recent: DataFrame) -> DataFrame:
    """The four cascading 4-day points per (market, weekday), as amounts (null if too few days)."""
    r = [F.max(F.when(F.col("rn") == i + 1, F.col("cents"))) for i in range(DEPTH)]
    agg = recent.groupBy("market", "weekday").agg(
        F.count("*").alias("n"), *[x.alias(f"r{i}") for i, x in enumerate(r)])

    def pt(cols, k):
        total = sum((F.col(c) for c in cols), F.lit(0))
        return F.when(F.col("n") >= k, total / F.lit(400.0))

    return agg.select(
        "market", "weekday", "n",
        pt(["r0", "r1", "r2", "r3"], 4).alias("p1"),
        pt(["r1", "r2", "r3", "r4"], 5).alias("p2"),
        pt(["r2", "r3", "r4", "r5"], 6).alias("p3"),
        pt(["r3", "r4", "r5", "r6", "r0"], 7).alias("p4"))


def weekday_average(recent: DataFrame, bias_corrected: bool = False) -> DataFrame:
    """``(market, weekday, n, avg_cents, avg_amount)``; fewer than 4 days -> 0."""
    return (recent.groupBy("market", "weekday").agg(*_weekday_sums(bias_corrected))
            .select("market", "weekday", "n", _average_cents(bias_corrected).alias("avg_cents"))
            .withColumn("avg_amount", cents_to_amount("avg_cents")))


def weekday_history_depth(recent: DataFrame) -> DataFrame:
    """Days of history per (market, weekday) and which points exist."""
    return (recent.groupBy("market", "weekday").agg(F.count("*").alias("days"))
            .select("market", "weekday", "days",
                    *[(F.col("days") >= k).alias(f"has_p{k - 3}") for k in (4, 5, 6, 7)]))


def forecast_days(profile: DataFrame, cutoff) -> DataFrame:
    """``(market, day, weekday, cents)`` for every remaining day of every market;
    a weekday without a profile counts 0."""
    days = (profile.select("market").distinct()
            .select("market", F.explode(remaining_days_expr(cutoff)).alias("day"))
            .withColumn("weekday", weekday_name("day")))
    return (days.join(profile.select("market", "weekday", "avg_cents"), ["market", "weekday"], "left")
            .select("market", "day", "weekday", F.coalesce("avg_cents", F.lit(0)).alias("cents")))


def forecast_remaining(profile: DataFrame, cutoff) -> DataFrame:
    """Forecast per market = sum over remaining days of the weekday average.

    Each profile row is multiplied by the number of remaining days on its
    weekday (an expression over the <=31-day calendar), so no join is needed;
    a weekday without a profile contributes 0.
    """
    k = remaining_weekday_count(cutoff, F.col("weekday"))
    return (profile.groupBy("market")
            .agg(F.coalesce(F.sum(F.col("avg_cents") * k), F.lit(0)).cast("bigint").alias("cents"))
            .select("market", cents_to_amount("cents").alias("estimated_sales")))


def estimate(tx: DataFrame, cutoff, market: str = "market", date: str = "date",
             amount: str = "amount", bias_corrected: bool = False,
             daily: DataFrame | None = None) -> DataFrame:
    """Month-end estimate per market.

    Returns ``(report_date, market, actual_sales, estimated_sales,
    total_estimation)``. ``daily`` may be a precomputed ``(market, date,
    cents)`` day-total table (with null dates kept) to skip step 1.
    """
    b = bounds(cutoff)
    day = daily if daily is not None else daily_cents(tx, market, date, amount, keep_null_dates=True)
    # Day totals are markets x days: co-locate each market once, every later
    # operator (window, per-weekday agg, per-market agg) reuses this layout.
    day = day.repartition("market")

    hist = F.coalesce(F.col("date") < F.lit(b["cutoff"]), F.lit(False))
    # Rows after the cutoff or without a date sit in their own (market, null)
    # group: they carry no weight but keep the market in the output.
    w = Window.partitionBy("market", "weekday").orderBy(F.col("date").desc())
    ranked = (day.withColumn("weekday", F.when(hist, weekday_name("date")))
              .withColumn("rn", F.row_number().over(w))
              .filter(F.col("rn") <= DEPTH))

    in_month = F.col("date").between(F.lit(b["month_start"]), F.lit(b["report_date"]))
    per_wd = ranked.groupBy("market", "weekday").agg(
        F.sum(F.when(in_month, F.col("cents"))).alias("actual"), *_weekday_sums(bias_corrected))
    avg = F.when(F.col("weekday").isNull(), F.lit(0)).otherwise(_average_cents(bias_corrected))
    k = remaining_weekday_count(b["cutoff"], F.col("weekday"))
    per_wd = per_wd.select("market", "actual", (avg * k).alias("forecast"))

    per_market = per_wd.groupBy("market").agg(
        F.coalesce(F.sum("actual"), F.lit(0)).alias("a"),
        F.coalesce(F.sum("forecast"), F.lit(0)).cast("bigint").alias("e"))
    # each figure from the exact sums: the total is not the sum of rounded parts
    return per_market.select(
        F.lit(b["report_date"]).alias("report_date"), "market",
        cents_to_amount(whole_cents("a")).alias("actual_sales"),
        cents_to_amount("e").alias("estimated_sales"),
        cents_to_amount(whole_cents(F.col("a") + F.col("e"))).alias("total_estimation"))
