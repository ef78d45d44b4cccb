"""Ingest: nothing lost, nothing doubled, whatever arrives and wherever a run breaks off."""

import csv
import datetime as dt
import io
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from test_io_clean import DE_HEADER, US_HEADER, _csv

from tillroll.functions import scalars as X
from tillroll.functions.locales import PROFILES
from tillroll.operators import estimate as E
from tillroll.operators.clean import parse_report_datetime, with_report_datetime
from tillroll.operators.results import RESULTS_SCHEMA, from_json_text
from tillroll.plans import daily as D
from tillroll.plans.daily import (MarketSource, file_states, ingest, ingest_status, read_clean, read_day_totals,
                                  read_quarantine, read_results, run_daily, update_results)
from tillroll.sources.reports import read_report
from tillroll.sources.sinks import publish_all, write_report_html

DE = MarketSource("EU - Germany", "de", "")


def _de(day, order, amount="10,00", settlement="9", when="10:00:00 UTC"):
    return (f"{day}.03.2025 {when}", settlement, "Bestellung", order, "S", "x", "1", amount, amount)


def _src(folder, market="EU - Germany", profile="de"):
    return MarketSource(market, profile, folder)


def _rows(spark, table):
    return sorted((r["market"], r["order_id"]) for r in read_clean(spark, table).collect())


def test_rows_with_blank_cells_are_data(spark, tmp):
    _csv(f"{tmp}/de/a.csv", DE_HEADER, [_de(1, "o-1"), _de(1, "o-2", settlement="")])
    assert sorted(r["Bestellnummer"] for r in read_report(spark, f"{tmp}/de").collect()) == ["o-1", "o-2"]


def test_same_name_in_two_markets(spark, tmp):
    name = "2025Mar1-2025Mar1CustomTransaction.csv"
    _csv(f"{tmp}/de/{name}", DE_HEADER, [_de(1, "o-de")])
    assert ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t") == 1
    _csv(f"{tmp}/it/{name}", DE_HEADER, [_de(1, "o-it")])
    both = [_src(f"{tmp}/de"), _src(f"{tmp}/it", "EU - Italy")]
    assert ingest(spark, both, f"{tmp}/t") == 1
    assert _rows(spark, f"{tmp}/t") == [("EU - Germany", "o-de"), ("EU - Italy", "o-it")]


def test_only_report_names_count(spark, tmp):
    for name in ("germany_sales_2025-03-01.csv", "copy of germany_sales_2025-03-01.csv", "notes.csv",
                 "germany_sales_2025-03-01.csv.part.csv"):
        _csv(f"{tmp}/de/{name}", DE_HEADER, [_de(1, name)])
    assert ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t") == 1
    assert _rows(spark, f"{tmp}/t") == [("EU - Germany", "germany_sales_2025-03-01.csv")]


def test_crash_before_the_manifest_doubles_nothing(spark, tmp, monkeypatch):
    for d in (1, 2):
        _csv(f"{tmp}/de/germany_sales_2025-03-0{d}.csv", DE_HEADER, [_de(d, f"o-{d}"), _de(d, f"n-{d}", when="??")])
    good = D.commit

    def broken(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(D, "commit", broken)               # all is written but for the commit
    assert "lost" in ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t", day_table=f"{tmp}/days")[0]["error"]
    assert spark.read.parquet(f"{tmp}/t").count() == 2
    monkeypatch.setattr(D, "commit", lambda spark, table, *a, **k: (
        broken() if table.endswith("days") else good(spark, table, *a, **k)))      # the day totals are not reached
    assert "lost" in ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t", day_table=f"{tmp}/days")[0]["error"]
    assert read_day_totals(spark, f"{tmp}/days").count() == 0
    monkeypatch.setattr(D, "commit", good)
    s = ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t", day_table=f"{tmp}/days")[0]
    assert (s["files"], s["error"]) == (0, None)            # taken before; the totals catch up
    assert [(r["state"], r["rows"], r["bad_dates"]) for r in file_states(spark, f"{tmp}/t").collect()] == [("taken", 1, 1)] * 2
    assert _rows(spark, f"{tmp}/t") == [("EU - Germany", "o-1"), ("EU - Germany", "o-2")]
    assert sorted((r["date"].day, r["cents"]) for r in read_day_totals(spark, f"{tmp}/days").collect()) == [
        (1, 1000), (2, 1000)]
    assert read_quarantine(spark, f"{tmp}/t").count() == 2


def test_a_new_version_of_a_file_replaces_the_old(spark, tmp):
    path = f"{tmp}/de/germany_sales_2025-03-01.csv"
    _csv(path, DE_HEADER, [_de(1, "o-1"), _de(1, "o-2")])
    ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t", day_table=f"{tmp}/days")
    _csv(path, DE_HEADER, [_de(1, "o-1"), _de(1, "o-2"), _de(1, "o-3")])
    assert ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t", day_table=f"{tmp}/days") == 1
    assert [o for _, o in _rows(spark, f"{tmp}/t")] == ["o-1", "o-2", "o-3"]
    assert [r["cents"] for r in read_day_totals(spark, f"{tmp}/days").collect()] == [3000]


def test_versions_without_good_rows_leave_nothing_behind(spark, tmp):
    path, days = f"{tmp}/de/germany_sales_2025-03-01.csv", f"{tmp}/days"
    src = [_src(f"{tmp}/de")]
    _csv(path, DE_HEADER, [_de(1, "o-1"), _de(1, "o-2"), _de(1, "bad", when="??")])
    _csv(f"{tmp}/de/germany_sales_2025-03-02.csv", DE_HEADER, [_de(2, "p-1")])
    s = ingest_status(spark, src, f"{tmp}/t", day_table=days)[0]
    assert (s["files"], s["rows"], s["bad_dates"]) == (2, 3, 1)
    _csv(path, DE_HEADER, [_de(1, "bad", when="???")])
    s = ingest_status(spark, src, f"{tmp}/t", day_table=days)[0]
    assert (s["files"], s["rows"], s["bad_dates"]) == (1, 0, 1)
    assert [o for _, o in _rows(spark, f"{tmp}/t")] == ["p-1"]
    assert [(r["date"].day, r["cents"]) for r in read_day_totals(spark, days).collect()] == [(2, 1000)]
    _csv(path, ["no", "report"], [("a", "b")])                 # refused: the version before stays in force
    _csv(f"{tmp}/de/germany_sales_2025-03-02.csv", ["no", "report"], [("a", "b")])
    s = ingest_status(spark, src, f"{tmp}/t", day_table=days)[0]
    assert (s["files"], s["refused"]) == (0, 2) and "0 headers" in s["error"] and "1 more" in s["error"]
    assert [o for _, o in _rows(spark, f"{tmp}/t")] == ["p-1"]
    os.remove(path)
    s = ingest_status(spark, src, f"{tmp}/t", day_table=days)[0]
    assert (s["gone"], s["refused"], s["error"]) == (1, 0, None)      # the other is not read again
    assert sorted(r["state"] for r in file_states(spark, f"{tmp}/t").collect()) == ["gone", "refused"]
    _csv(path, DE_HEADER, [_de(3, "o-9")])
    assert ingest(spark, src, f"{tmp}/t", day_table=days) == 1
    assert [o for _, o in _rows(spark, f"{tmp}/t")] == ["o-9", "p-1"]
    full = E.daily_cents(read_clean(spark, f"{tmp}/t").withColumnRenamed("product_sales", "amount"))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, read_day_totals(spark, days).collect()))
    folders = [p for p, subs, _ in os.walk(days) if os.path.basename(p).startswith("run_id=")]
    assert len(folders) <= 2                                  # one month


def test_a_refused_file_blocks_neither_stream_nor_market(spark, tmp):
    from tillroll.streaming.ingest import run_ingest
    go = lambda: run_ingest(spark, f"{tmp}/de", f"{tmp}/t", f"{tmp}/cp", "de", "EU - Germany", max_files=1)
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", ["broken"], [])
    go()
    for d in (2, 3):
        _csv(f"{tmp}/de/germany_sales_2025-03-0{d}.csv", DE_HEADER, [_de(d, f"o-{d}")])
    go()
    assert [o for _, o in _rows(spark, f"{tmp}/t")] == ["o-2", "o-3"]
    states = sorted((r["state"], r["reason"]) for r in file_states(spark, f"{tmp}/t").collect() if r["state"] == "refused")
    assert states == [("refused", "0 headers found")]
    assert ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t")[0]["error"] is None     # the batch form knows it too
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1")])
    assert ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t") == 1


def test_full_width_reports_are_planned_at_once(spark, tmp):
    import time

    from conftest import SF_SMALL

    from tillroll.operators.clean import clean
    from tillroll.operators.dims import sku_first
    from tillroll.plans import bindings as B
    dim = sku_first(B.sku_dim_raw(spark, SF_SMALL))
    for p, width in (("us", 30), ("fr", 27)):
        raw = B.raw_report(spark, SF_SMALL, p)
        assert len(raw.columns) == width
        raw.limit(50).coalesce(1).write.option("header", True).csv(f"{tmp}/{p}")
        out = clean(read_report(spark, f"{tmp}/{p}"), p, sku_dim=dim).join(dim, "sku")
        start = time.perf_counter()
        out._jdf.queryExecution().executedPlan()
        assert time.perf_counter() - start < 5                # seconds; doubled with every column before
        assert out.count() > 0


def test_a_hundred_thousand_names(spark, tmp):
    for d in (1, 2, 3):
        _csv(f"{tmp}/de/germany_sales_2025-03-0{d}.csv", DE_HEADER, [_de(d, f"o-{d}")])
    real = D.list_files(spark, f"{tmp}/de", market_from_dir=False)
    path = F.concat(F.lit(f"file://{tmp}/de/old/"), F.col("id").cast("string"), F.lit("/germany_sales_2024-01-01.csv"))
    many = spark.range(100_000).select(path.alias("path"), F.lit("germany_sales_2024-01-01.csv").alias("file_name"),
                                       F.lit(dt.datetime(2025, 1, 1)).alias("modified"), F.lit(1).cast("long").alias("size"))
    s = D.take_files(spark, real.unionByName(many), _src(f"{tmp}/de"), f"{tmp}/t")
    assert (s["files"], s["refused"], s["rows"]) == (3, 100_000, 3)
    s = D.take_files(spark, real.unionByName(many), _src(f"{tmp}/de"), f"{tmp}/t")
    assert (s["files"], s["refused"], s["gone"]) == (0, 0, 0)


def test_rows_of_a_table_with_one_filled_cell_are_kept(spark, tmp):
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1"), ("", "", "", "o-2", "", "", "", "", "")])
    s = ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t")[0]
    assert (s["rows"], s["sparse_rows"]) == (1, 1)
    assert "o-2" in read_quarantine(spark, f"{tmp}/t").first()["line"]


def test_an_update_of_the_results_shows_whole_or_not_at_all(spark, tmp, monkeypatch):
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    make = lambda x: spark.createDataFrame([(d, "EU - A", x, 0.0, x) for d in (d1, d2)], RESULTS_SCHEMA)
    read = lambda: sorted((r["report_date"], r["actual_sales"]) for r in read_results(spark, f"{tmp}/r").collect())
    update_results(spark, f"{tmp}/r", make(1.0))
    good = D.commit

    def broken(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(D, "commit", broken)
    with pytest.raises(OSError):
        update_results(spark, f"{tmp}/r", make(2.0))
    assert read() == [(d1, 1.0), (d2, 1.0)]
    monkeypatch.setattr(D, "commit", good)
    update_results(spark, f"{tmp}/r", make(3.0))
    update_results(spark, f"{tmp}/r", spark.createDataFrame([], RESULTS_SCHEMA), group_prefix="EU", report_date=d1)
    assert read() == [(d2, 3.0)]


def test_unreadable_manifest_is_an_error_not_a_fresh_start(spark, tmp):
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1")])
    ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t")
    for f in os.listdir(f"{tmp}/t/_manifest"):
        if f.endswith(".parquet"):
            with open(f"{tmp}/t/_manifest/{f}", "wb") as out:
                out.write(b"broken")
    _csv(f"{tmp}/de/germany_sales_2025-03-02.csv", DE_HEADER, [_de(2, "o-2")])
    s = ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t")[0]
    assert s["error"] and s["files"] == 0
    assert _rows(spark, f"{tmp}/t") == [("EU - Germany", "o-1")]


def test_each_file_under_its_own_header(spark, tmp):
    wider = [*DE_HEADER[:3], "Versand", *DE_HEADER[3:]]
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1")])
    ingest(spark, [_src(f"{tmp}/de")], f"{tmp}/t")
    row = _de(2, "o-2")
    _csv(f"{tmp}/de/germany_sales_2025-03-02.csv", wider, [(*row[:3], "Amazon", *row[3:])])
    _csv(f"{tmp}/de/germany_sales_2025-03-03.csv", DE_HEADER, [(*_de(3, "o-3"), "one too many")])
    _csv(f"{tmp}/de/germany_sales_2025-03-04.csv", ["no", "header"], [("a", "b")])
    s = ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t")[0]
    assert (s["files"], s["rows"], s["wide_rows"]) == (2, 1, 1) and "2025-03-04.csv: 0 headers" in s["error"]
    got = {r["order_id"]: r["fulfillment"] for r in read_clean(spark, f"{tmp}/t").collect()}
    assert got == {"o-1": None, "o-2": "Amazon"}


@pytest.mark.parametrize("extra", [["one"], ["", "two", "x, y"], ["one", "", 'say "three"', "two\nlines"]])
def test_wide_rows_stay_whole_in_quarantine(spark, tmp, extra):
    wide = [*_de(1, "o-2", settlement=""), *(extra if extra[0] else ["a", *extra])]
    wide[5] = "x, y"
    path = f"{tmp}/de/germany_sales_2025-03-01.csv"
    _csv(path, DE_HEADER, [_de(1, "o-1"), [v.replace('"', '""') for v in wide]])
    s = ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t")[0]
    assert (s["rows"], s["wide_rows"], s["error"]) == (1, 1, None)
    held = spark.read.parquet(f"{tmp}/t_quarantine").collect()
    assert [next(csv.reader(io.StringIO(r["line"], newline=""))) for r in held] == [wide]


def test_stray_preamble_goes_to_quarantine(spark, tmp):
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1")],
         preamble=["one cell", "Includes marketplace, seller and other transactions", '"x"'])
    s = ingest_status(spark, [_src(f"{tmp}/de")], f"{tmp}/t")[0]
    assert (s["rows"], s["bad_dates"]) == (1, 1)
    held = spark.read.parquet(f"{tmp}/t_quarantine").collect()
    assert [r["source_file"] for r in held] == ["germany_sales_2025-03-01.csv"] and "seller" in held[0]["line"]
    status = spark.read.parquet(f"{tmp}/t_status").collect()
    assert [(r["market"], r["rows"], r["bad_dates"]) for r in status] == [("EU - Germany", 1, 1)]


def test_a_failed_market_is_not_published(spark, tmp):
    _csv(f"{tmp}/de/germany_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1")])
    _csv(f"{tmp}/it/italy_sales_2025-03-01.csv", DE_HEADER, [_de(1, "o-1")])
    sources = [_src(f"{tmp}/de"), _src(f"{tmp}/it", "EU - Italy")]
    run_daily(spark, sources, f"{tmp}/t", f"{tmp}/r", "2025-03-02", "EU", f"{tmp}/h", day_table=f"{tmp}/days")
    _csv(f"{tmp}/de/germany_sales_2025-03-02.csv", DE_HEADER, [_de(2, "o-2")])
    _csv(f"{tmp}/it/italy_sales_2025-03-02.csv", ["broken"], [])
    s = run_daily(spark, sources, f"{tmp}/t", f"{tmp}/r", "2025-03-03", "EU", f"{tmp}/h", day_table=f"{tmp}/days")
    assert {r["market"] for r in s.collect()} == {"EU - Germany", "Total EU", "Grand Total"}


def test_results_of_another_date_raise(spark, tmp):
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    both = spark.createDataFrame([(d1, "A", 1.0, 0.0, 1.0), (d2, "A", 2.0, 0.0, 2.0)], RESULTS_SCHEMA)
    with pytest.raises(ValueError, match="other dates"):
        update_results(spark, f"{tmp}/r", both, group_prefix="A", report_date=d1)
    update_results(spark, f"{tmp}/r", both)
    with open(next(os.path.join(p, f) for p, _, fs in os.walk(f"{tmp}/r") for f in fs if f.endswith(".parquet")), "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):  # unreadable results are not empty results
        update_results(spark, f"{tmp}/r", both)


def test_figures_round_once(spark):
    day = dt.date(2025, 3, 1)
    tx = spark.createDataFrame([("m", day, x) for x in (1.005, 0.004, 0.004, 2.675)], "market string, date date, amount double")
    assert E.estimate(tx, "2025-03-02").first()["actual_sales"] == 3.69
    assert E.mtd_actual(tx, "2025-03-02").first()["actual_sales"] == 3.69
    assert E.daily_sales(tx).first()["amount"] == 3.688


def test_month_to_date_reaches_the_scan(spark, tmp):
    df = spark.createDataFrame([("a", dt.date(2025, 3, 1), 1.0), ("b", dt.date(2024, 1, 1), 1.0)],
                               "market string, date date, amount double")
    df.write.parquet(f"{tmp}/x")
    got = E.mtd_actual(spark.read.parquet(f"{tmp}/x"), "2025-03-15")
    assert "GreaterThanOrEqual(date,2025-03-01)" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["market"], r["actual_sales"]) for r in got.collect()) == [("a", 1.0), ("b", 0.0)]


def test_every_remaining_day_is_forecast(spark):
    profile = spark.createDataFrame([("m", "Monday", 700)], "market string, weekday string, avg_cents long")
    got = {r["day"].day: r["cents"] for r in E.forecast_days(profile, "2025-03-25").collect()}
    assert got == {d: 700 if d == 31 else 0 for d in range(25, 32)}


@pytest.mark.parametrize("profile", ["us", "de", "it", "es", "fr"])
def test_staged_dates_equal_the_expression(spark, profile):
    p = PROFILES[profile]
    months = list(p.months) or ["Mar"]
    texts = [None, "", "kaputt", "1 nov. 2 nov. 2025", "2025-03-01", "Mar 1, 2025 1:02:03 PM PST", "01.03.2025 04:05:06 UTC"]
    texts += [f"{k % 28 + 1}{s}{m}{s}2025 1{k % 10}:05:33 UTC" for k, m in enumerate(months) for s in (" ", " ", "  ")]
    texts += [f"3 {a} 4 {b} 2025" for a in months[:2] for b in months[:2]]
    df = spark.createDataFrame([(t,) for t in texts], "date_time string")
    staged = [tuple(r) for r in with_report_datetime(df, p).select("date_time", "_ts").collect()]
    assert staged == [tuple(r) for r in df.select("date_time", parse_report_datetime("date_time", p)).collect()]
    if p.months:
        plain = df.withColumn("x", X.plain_spaces("date_time"))
        assert [r[0] for r in X.with_month_token(plain, "x", p.months).select("x").collect()] == [
            r[0] for r in plain.select(X.translate_months("x", p.months)).collect()]


def test_market_union_plan_is_small_enough_to_compile(spark):
    from conftest import SF_SMALL

    from tillroll.plans.catalog import QUERIES
    plan = QUERIES["multi_market_union"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 40_000


def test_document_and_publishing(spark, tmp):
    import glob

    from tillroll.operators import summary as S
    res = spark.createDataFrame([(dt.date(2025, 3, 2), "EU - DE", 10.0, 1.0, 11.0)], RESULTS_SCHEMA)
    write_report_html(S.html_rows(S.summary(res, group="EU")), tmp + "/html")
    text = "".join(open(f).read() for f in sorted(glob.glob(tmp + "/html/report_date=2025-03-02/*.txt")))
    assert "from March 1, 2025 to March 2, 2025" in text and "Column Guide" in text and "auto-generated" in text
    assert publish_all({}, f"file://{tmp}/pub") is False
    bad = res.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    assert publish_all({"a": res, "b": bad}, f"file://{tmp}/pub", status_path=f"{tmp}/status") is False
    assert sorted((r["name"], r["ok"]) for r in spark.read.parquet(f"{tmp}/status").collect()) == [("a", True), ("b", False)]


def test_malformed_results_document_raises(spark):
    docs = spark.createDataFrame([('{"2025-03-01": [{"market": ',)], "json string")
    with pytest.raises(Exception):
        from_json_text(docs).collect()
    assert from_json_text(docs, strict=False).collect() == []


def test_newest_report_becomes_a_dated_extract(spark, tmp):
    row = ("Mar 2, 2025 12:05:33 AM PST", "1", "Order", "new", "s", "d", "1", "19.99", "1")
    _csv(f"{tmp}/us/2025Mar2-2025Mar2CustomUnifiedTransaction.csv", US_HEADER, [row])
    _csv(f"{tmp}/us/2025Mar1-2025Mar1CustomUnifiedTransaction.csv", US_HEADER, [(row[0], "1", "Order", "old", *row[4:])])
    out = D.newest_extract(spark, f"{tmp}/us", f"{tmp}/x").collect()
    assert [(r["order_id"], r["report_date"], r["product_sales"]) for r in out] == [
        ("new", dt.date(2025, 3, 2), Decimal("19.9900"))]
    assert os.path.isdir(f"{tmp}/x/report_date=2025-03-02")


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from tillroll.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(getConf=lambda: conf, master="spark://head:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
