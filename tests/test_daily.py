"""End to end: report files of two markets -> clean table -> estimate -> results -> summary."""

import datetime as dt
import glob

from test_io_clean import DE_HEADER, US_HEADER, _csv

from tillroll.plans.daily import MarketSource, ingest, read_results, run_daily, update_results
from tillroll.operators.results import RESULTS_SCHEMA


def _us_rows(d, amount):
    return [(d.strftime("%b ") + str(d.day) + d.strftime(", %Y 10:00:00 AM PST"), "1", "Order", f"u-{d}", "s",
             "d", "1", f"{amount:.2f}", f"{amount:.2f}")]


def _de_rows(d, amount):
    txt = f"{amount:.2f}".replace(".", ",")
    return [(d.strftime("%d.%m.%Y 10:00:00 UTC"), "9", "Bestellung", f"d-{d}", "S", "x", "1", txt, txt)]


def test_daily_run_end_to_end(spark, tmp):
    d = dt.date(2025, 2, 1)
    while d <= dt.date(2025, 3, 20):       # Sat..Thu have 7 days of history, Fri 6
        name = d.strftime("%Y%b") + str(d.day)
        _csv(f"{tmp}/us/{name}-{name}CustomUnifiedTransaction.csv", US_HEADER, _us_rows(d, 100))
        _csv(f"{tmp}/de/germany_sales_{d.isoformat()}.csv", DE_HEADER, _de_rows(d, 50))
        d += dt.timedelta(days=1)
    sources = [MarketSource("US", "us", f"{tmp}/us"), MarketSource("EU - Germany", "de", f"{tmp}/de"),
               MarketSource("EU - Italy", "it", f"{tmp}/it-missing")]
    s = run_daily(spark, sources, f"{tmp}/clean", f"{tmp}/results", "2025-03-21", "EU", f"{tmp}/html")
    first = s.collect()
    got = {r["market"]: (r["ord"], r["actual_sales"], r["estimated_sales"]) for r in first}
    # remaining Mar 21..31: two Fridays at the 6-day average (flat), nine days at 17/16 of it
    assert got["US"] == (3, 2000.0, 2 * 100 + 9 * 106.25)
    assert got["EU - Germany"] == (1, 1000.0, round(2 * 50 + 9 * 53.12, 2))    # 53.125 -> 53.12
    assert got["Total EU"] == (2, 1000.0, 578.08) and got["Grand Total"][1] == 3000.0
    assert glob.glob(f"{tmp}/html/report_date=2025-03-20/*.txt")
    # rerun: manifest makes the append a no-op; results stay keyed
    assert ingest(spark, sources, f"{tmp}/clean") == 0
    s2 = run_daily(spark, sources, f"{tmp}/clean", f"{tmp}/results", "2025-03-21", "EU", f"{tmp}/html")
    assert sorted(map(tuple, s2.collect())) == sorted(map(tuple, first))
    assert read_results(spark, f"{tmp}/results").count() == 2


def test_update_results_group_replacement_keeps_other_dates(spark, tmp):
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    first = spark.createDataFrame([(d1, "EU - A", 1.0, 1.0, 2.0), (d1, "EU - B", 1.0, 1.0, 2.0),
                                   (d1, "US", 5.0, 0.0, 5.0), (d2, "EU - A", 3.0, 0.0, 3.0)], RESULTS_SCHEMA)
    update_results(spark, f"{tmp}/r", first)
    new = spark.createDataFrame([(d1, "EU - A", 9.0, 0.0, 9.0)], RESULTS_SCHEMA)
    update_results(spark, f"{tmp}/r", new, group_prefix="EU")
    rows = sorted((r["report_date"], r["market"], r["total_estimation"])
                  for r in read_results(spark, f"{tmp}/r").collect())
    assert rows == [(d1, "EU - A", 9.0), (d1, "US", 5.0), (d2, "EU - A", 3.0)]


def test_group_replacement_can_empty_a_date(spark, tmp):
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    update_results(spark, f"{tmp}/r", spark.createDataFrame(
        [(d1, "EU - A", 1.0, 1.0, 2.0), (d2, "US", 3.0, 0.0, 3.0)], RESULTS_SCHEMA))
    update_results(spark, f"{tmp}/r", spark.createDataFrame([], RESULTS_SCHEMA),
                   group_prefix="EU", report_date=d1)
    rows = sorted((r["report_date"], r["market"]) for r in read_results(spark, f"{tmp}/r").collect())
    assert rows == [(d2, "US")]


def test_estimate_prunes_market_partitions(spark, tmp):
    from tillroll.plans.daily import estimate_markets
    df = spark.createDataFrame([("US", dt.date(2025, 3, 1), dt.date(2025, 3, 1), 1.0),
                                ("DE", dt.date(2025, 3, 1), dt.date(2025, 3, 1), 2.0)],
                               "market string, report_date date, date date, product_sales double")
    df.write.partitionBy("market", "report_date").parquet(f"{tmp}/clean")
    est = estimate_markets(spark, f"{tmp}/clean", "2025-03-02", markets=["US"])
    plan = est._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(market" in plan and "US" in plan
    assert [r["market"] for r in est.collect()] == ["US"]


def test_null_counts(spark):
    from tillroll.operators.clean import null_counts
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    r = null_counts(df, ["a", "b", "c"]).collect()[0]
    assert (r["a"], r["b"]) == (1, 2)


def test_day_total_table_matches_full_recompute(spark, tmp):
    from tillroll.plans.daily import estimate_markets
    sources = [MarketSource("US", "us", f"{tmp}/us"), MarketSource("EU - Germany", "de", f"{tmp}/de")]
    d = dt.date(2025, 1, 20)
    while d <= dt.date(2025, 3, 20):
        name = d.strftime("%Y%b") + str(d.day)
        _csv(f"{tmp}/us/{name}-{name}CustomUnifiedTransaction.csv", US_HEADER, _us_rows(d, 10 + d.day))
        if d.day % 3:
            _csv(f"{tmp}/de/germany_sales_{d.isoformat()}.csv", DE_HEADER, _de_rows(d, 5 + d.day))
        if d == dt.date(2025, 2, 27):     # first run sees files up to here
            ingest(spark, sources, f"{tmp}/clean", day_table=f"{tmp}/days")
        d += dt.timedelta(days=1)
    ingest(spark, sources, f"{tmp}/clean", day_table=f"{tmp}/days")
    ingest(spark, sources, f"{tmp}/clean", day_table=f"{tmp}/days")        # nothing new
    full = sorted(map(tuple, estimate_markets(spark, f"{tmp}/clean", "2025-03-21").collect()))
    fast = sorted(map(tuple, estimate_markets(spark, f"{tmp}/clean", "2025-03-21",
                                              day_table=f"{tmp}/days").collect()))
    assert full == fast and len(full) == 2
