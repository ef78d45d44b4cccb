"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3, median reported), BENCH_QUERIES (comma list, optional).
Each run materializes the whole result through the ``noop`` sink, so the
full plan executes and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "estimate_month_end",
    "estimate_multi_market",
    "estimate_on_first_of_month",
    "daily_sales",
    "weekday_average",
    "clean_us",
    "clean_fr",
    "multi_market_union",
    "sku_asin_left_join",
    "summary_rollup",
    "results_upsert_market",
    "new_files_anti",
]


# Ingestion path: report files written once as CSV (untimed), then timed
# read_report (header found by content) + clean, as a daily job would run.
INGEST = {"ingest_csv_us": "us", "ingest_csv_fr": "fr"}


def prepare_reports(spark, sf_dir: str, scratch: str) -> None:
    from tillroll.plans.bindings import raw_report
    for name, profile in INGEST.items():
        (raw_report(spark, sf_dir, profile).repartition(32)
         .write.mode("overwrite").option("header", True).csv(os.path.join(scratch, name)))


# The cleaners are timed on stored report text, so that they and not the
# writing of the text are measured.
CLEAN = {"clean_us": "us", "clean_fr": "fr"}


def prepare_text(spark, sf_dir: str, scratch: str) -> None:
    from tillroll.plans.bindings import raw_report
    for profile in CLEAN.values():
        (raw_report(spark, sf_dir, profile).repartition(32)
         .write.mode("overwrite").parquet(os.path.join(scratch, f"text_{profile}")))


def clean_query(name: str, scratch: str):
    from tillroll.operators.clean import clean
    from tillroll.operators.dims import sku_first
    from tillroll.plans.bindings import sku_dim_raw

    def run(spark, sf_dir):
        profile = CLEAN[name]
        dim = sku_first(sku_dim_raw(spark, sf_dir)) if profile == "us" else None
        return clean(spark.read.parquet(os.path.join(scratch, f"text_{profile}")), profile, sku_dim=dim)
    return run


def ingest_query(name: str, scratch: str):
    from tillroll.operators.clean import clean
    from tillroll.operators.dims import sku_first
    from tillroll.plans.bindings import sku_dim_raw
    from tillroll.sources.reports import read_report

    def run(spark, sf_dir):
        profile = INGEST[name]
        dim = sku_first(sku_dim_raw(spark, sf_dir)) if profile == "us" else None
        return clean(read_report(spark, os.path.join(scratch, name)), profile, sku_dim=dim)
    return run


# At scale the estimate reads the incrementally kept day totals, not every
# transaction: built once here (untimed) from orders, then the estimate is timed.
DAY_TABLE_QUERY = "estimate_from_day_totals"


def prepare_day_table(spark, sf_dir: str, scratch: str) -> str:
    from tillroll.operators.estimate import daily_cents, merge_day_totals
    from tillroll.plans.bindings import orders_tx
    path = os.path.join(scratch, "day_totals")
    from tillroll.sources.sinks import salted
    (salted(merge_day_totals(None, daily_cents(orders_tx(spark, sf_dir), keep_null_dates=True)), ["month"])
     .write.mode("overwrite").partitionBy("month").parquet(path))
    return path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = ([q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
             or HEADLINE + list(INGEST) + [DAY_TABLE_QUERY])

    from tillroll.plans.catalog import QUERIES
    from tillroll.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    import tempfile
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    queries = dict(QUERIES)
    if any(n in CLEAN for n in names):
        prepare_text(spark, sf_dir, scratch)
        queries.update({n: clean_query(n, scratch) for n in CLEAN})
    if any(n in INGEST for n in names):
        prepare_reports(spark, sf_dir, scratch)
        queries.update({n: ingest_query(n, scratch) for n in INGEST})
    if DAY_TABLE_QUERY in names:
        from tillroll.operators.estimate import estimate
        from tillroll.plans.bindings import CUTOFF
        day_path = prepare_day_table(spark, sf_dir, scratch)
        queries[DAY_TABLE_QUERY] = lambda s, d: estimate(None, CUTOFF, daily=s.read.parquet(day_path).select(
            "market", "date", "cents"))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:           # warm-up: JIT, file listing caches
        run(n)
    out = {}
    for n in names:
        out[n] = round(statistics.median(run(n) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
