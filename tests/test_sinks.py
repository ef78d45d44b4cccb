"""Sinks and remaining sources: master read, dynamic overwrite, dated extract, publish, cutoff."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tillroll.functions.scalars import cutoff_in_month
from tillroll.sources.reports import read_master
from tillroll.sources.sinks import overwrite_clean, publish, publish_all, write_dated_extract


def _rows(spark, rows):
    return spark.createDataFrame(rows, "market string, report_date date, v int")


def test_overwrite_clean_replaces_only_present_partitions(spark, tmp):
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    overwrite_clean(_rows(spark, [("m", d1, 1), ("m", d2, 2)]), f"{tmp}/c")
    overwrite_clean(_rows(spark, [("m", d2, 9)]), f"{tmp}/c")
    got = sorted((r["report_date"], r["v"]) for r in spark.read.parquet(f"{tmp}/c").collect())
    assert got == [(d1, 1), (d2, 9)]


def test_dated_extract_folders(spark, tmp):
    write_dated_extract(_rows(spark, [("m", dt.date(2025, 3, 1), 1)]), f"{tmp}/x")
    assert glob.glob(f"{tmp}/x/report_date=2025-03-01/*.csv")


def test_read_master_keeps_text(spark, tmp):
    os.makedirs(f"{tmp}/m")
    with open(f"{tmp}/m/master.csv", "w") as f:
        f.write("sku,quantity\n00123,1\n10-20141 FFP,2\n")
    rows = read_master(spark, f"{tmp}/m").collect()
    assert [r["sku"] for r in rows] == ["00123", "10-20141 FFP"]


def test_publish_all_counts_failures(spark, tmp):
    df = _rows(spark, [("m", dt.date(2025, 3, 1), 1)])
    target = publish(df, "file://" + tmp + "/pub", "a")
    assert target.endswith("/pub/a") and glob.glob(f"{tmp}/pub/a/*.csv")
    bad = df.select(F.when(F.col("v") > 0, F.raise_error(F.lit("boom"))).cast("string").alias("x"))
    assert publish_all({"b": df}, "file://" + tmp + "/pub") is True
    assert publish_all({"b": df, "c": bad}, "file://" + tmp + "/pub") is False


def test_cutoff_in_month_raises_on_impossible_day(spark):
    df = spark.createDataFrame([(2025, 2, 28)], "y int, m int, d int")
    assert df.select(cutoff_in_month("y", "m", "d")).collect()[0][0] == dt.date(2025, 2, 28)
    with pytest.raises(Exception):
        spark.createDataFrame([(2025, 2, 30)], "y int, m int, d int").select(
            cutoff_in_month("y", "m", "d")).collect()


def test_a_flat_report_is_one_file(spark, tmp):
    from tillroll.sources.sinks import publish_file
    base = "file://" + tmp + "/pub"
    df = spark.range(0, 500, 1, 7).select(F.col("id").alias("a, b"), F.concat(F.lit('say "x", '), F.col("id")).alias("text"))
    assert publish_file(df.orderBy("id"), base, "r.csv") == f"{base}/r.csv"
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp}/pub/r.csv")
    assert os.path.isfile(f"{tmp}/pub/r.csv") and back.columns == ["a, b", "text"]
    with open(f"{tmp}/pub/r.csv") as f:
        assert [line.split(",")[0] for line in f][1:] == [str(k) for k in range(500)]
    publish_file(df.limit(3), base, "r.csv")                                # replaces
    assert sum(1 for _ in open(f"{tmp}/pub/r.csv")) == 4
    with pytest.raises(Exception):
        publish_file(df.withColumn("text", F.raise_error(F.lit("boom")).cast("string")), base, "r.csv")
    assert sum(1 for _ in open(f"{tmp}/pub/r.csv")) == 4 and sorted(os.listdir(f"{tmp}/pub")) == [".r.csv.crc", "r.csv"]
    publish_file(df.limit(0), base, "none.csv")
    assert open(f"{tmp}/pub/none.csv").read() == '"a, b",text\n'
    status = f"{tmp}/status"
    assert publish_all({"x.csv": df, "y.csv": df.select(F.raise_error(F.lit("no")).alias("z"))}, base, status_path=status, flat=True) is False
    assert sorted((r["name"], r["ok"]) for r in spark.read.parquet(status).collect()) == [("x.csv", True), ("y.csv", False)]
    assert os.path.isfile(f"{tmp}/pub/x.csv") and not os.path.exists(f"{tmp}/pub/y.csv")


@pytest.mark.parametrize("values, want", [
    (["1", "-20", "", None], "bigint"), (["1", "2.5"], "double"), ([".5", "1e3", "7"], "double"), (["007", "1"], "string"),
    (["1" * 19], "double"), (["true", "FALSE", ""], "boolean"), (["true", "1"], "string"), (["2025-03-01"], "date"),
    (["2025-03-01", "2025-03-01 10:00:00"], "timestamp"), (["2025-02-30"], "string"), (["2025-03-01", "5"], "string"),
    (["", None], "string"), ([], "string"), (["1,5"], "string"), (["-"], "string"), (["e5"], "string"), ([" 3 "], "bigint")])
def test_types_are_what_all_values_fit(spark, values, want):
    from tillroll.sources.infer import infer_types, typed
    df = spark.createDataFrame([(v, "x") for v in values], "`a.b` string, other string")
    assert [tuple(r) for r in infer_types(df).collect()][0] == ("a.b", want)
    out = typed(df)
    assert out.columns == ["a.b", "other"] and out.count() == len(values)
    if want != "string":
        assert out.select(F.count("`a.b`")).first()[0] == sum(bool(v) for v in values)
