"""What lies on disk while the ingest job runs and when it has ended."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tillroll.plans import catalog as C
from tillroll.plans import daily as D
from tillroll.session import scratch_path, shuffles_removed
from tillroll.sources import reports as RP


@pytest.fixture()
def tables(spark, tmp):
    """Line items of three flags and seven lines per order, and their parts."""
    k = F.col("id")
    (spark.range(420).select(
        (k / 7).cast("long").alias("l_orderkey"), (k % 7 + 1).alias("l_linenumber"), (k % 20).alias("l_partkey"),
        F.element_at(F.array(*map(F.lit, "ANR")), (k % 3 + 1).cast("int")).alias("l_returnflag"),
        (k % 50).cast("double").alias("l_quantity"), (k * 1.25).alias("l_extendedprice"), F.lit(0.08).alias("l_tax"),
        F.expr("timestamp_ntz'1997-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int))").alias("l_shipdate"))
     .write.parquet(f"{tmp}/lineitem.parquet"))
    (spark.range(20).select(k.alias("p_partkey"), k.alias("p_size"), F.lit("Brand#1").alias("p_brand"))
     .write.parquet(f"{tmp}/part.parquet"))
    return tmp


@pytest.mark.parametrize("name, landed", [("ingest_status", [3] * 4), ("ingest_day_totals", [1] * 6), ("ingest_clean_us", [1] * 6)])
def test_reports_land_when_their_turn_comes(spark, tables, monkeypatch, name, landed):
    paths, seen, ingest = [], [], C._ingest
    monkeypatch.setattr(C, "_written", lambda s, n: paths.append(f"{tables}/{n}") or paths[-1])
    count = lambda: len(glob.glob(f"{tables}/land/**/*.csv", recursive=True))
    monkeypatch.setattr(C, "_ingest", lambda *a, **k: seen.append(count()) or ingest(*a, **k))
    rows = C.QUERIES[name](spark, tables).collect()
    assert seen == landed and count() == 0
    if name == "ingest_status":
        assert {tuple(r[c] for c in ("files", "rows", "bad_dates", "null_amounts")) for r in rows} == {(3, 360, 60, 60)} and len(rows) == 4
    elif name == "ingest_clean_us":
        assert sorted(r["order_id"] for r in rows) == sorted(f"{k // 7}-{k % 7 + 1}" for k in range(420))
    else:
        assert sum(r["cents"] for r in rows) == sum(k * 125 for k in range(420) if k % 7 > 1)


def test_a_run_leaves_nothing_staged(spark, tmp, monkeypatch):
    os.makedirs(f"{tmp}/de")
    with open(f"{tmp}/de/germany_sales_2025-03-01.csv", "w", encoding="utf-8") as f:
        f.write("Datum/Uhrzeit,Typ,Umsätze\n01.03.2025 10:00:00 UTC,Bestellung,\"1,50\"\n")
    src = [D.MarketSource("EU - Germany", "de", f"{tmp}/de")]
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    staged = lambda: {n for n in (os.listdir(folder) if os.path.isdir(folder) else ())
                      if n.split("-")[0] in ("run", "rows", "heads", "fresh", "gone")}
    before, commit = staged(), D.commit

    def broken(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(D, "commit", broken)
    assert "lost" in D.ingest_status(spark, src, f"{tmp}/t")[0]["error"] and staged() == before
    monkeypatch.setattr(D, "commit", commit)
    assert D.ingest_status(spark, src, f"{tmp}/t")[0]["rows"] == 1 and staged() == before
    assert D.read_clean(spark, f"{tmp}/t").count() == 1


def test_shuffle_files_go_with_the_write(spark, tmp):
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    spark._jvm.System.gc()
    time.sleep(3)                                           # what earlier tests left goes first
    before = held()
    with shuffles_removed(spark):
        spark.range(1000).repartition(7).write.parquet(f"{tmp}/a")
    for _ in range(40):
        if held() <= before:
            break
        time.sleep(0.25)
    assert held() <= before and spark.read.parquet(f"{tmp}/a").count() == 1000


def test_a_master_is_stored_compressed(spark, tables, monkeypatch):
    path = f"{tables}/master"
    monkeypatch.setattr(C, "_written", lambda s, n: path)
    monkeypatch.setattr(RP, "SPLIT_BYTES", 1)               # also the pass over the text of large files
    df = C.QUERIES["read_master"](spark, tables)
    rows = df.collect()
    text = sum(len(",".join(v or "" for v in r)) + 1 for r in rows)
    assert len(rows) == 420 and len(df.columns) == 30
    assert sum(os.path.getsize(p) for p in glob.glob(f"{path}/part-*")) < text / 2


@pytest.mark.parametrize("least", [1, 1 << 40])
def test_a_compressed_master_keeps_line_breaks(spark, tmp, monkeypatch, least):
    monkeypatch.setattr(RP, "SPLIT_BYTES", least)
    (spark.createDataFrame([("1", "a\nb"), ("2", "c")], "no string, name string").coalesce(1)
     .write.option("header", True).option("compression", "gzip").csv(f"{tmp}/m"))
    assert sorted(map(tuple, RP.read_master(spark, f"{tmp}/m").collect())) == [("1", "a\nb"), ("2", "c")]
