"""Plan shapes the design relies on (checked on the smallest tables)."""

from conftest import SF_SMALL

from tillroll.operators import estimate as E
from tillroll.operators.clean import clean
from tillroll.plans import bindings as B


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_seven_per_weekday_is_a_window_group_limit(spark):
    plan = _plan(E.recent_weekdays(E.daily_cents(B.orders_tx(spark, SF_SMALL)), B.CUTOFF))
    assert "WindowGroupLimit" in plan


def test_cleaners_are_narrow_and_jvm_only(spark):
    for p in ("us2", "de", "it", "es", "fr"):
        plan = _plan(clean(B.raw_report(spark, SF_SMALL, p), p))
        assert "Exchange" not in plan, p
        assert "Python" not in plan and "ArrowEval" not in plan, p


def test_estimate_scan_reads_three_columns(spark):
    plan = _plan(E.estimate(B.orders_tx(spark, SF_SMALL), B.CUTOFF))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_report_plans_have_no_method_that_the_jvm_interprets(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    try:
        clean(B.raw_report(spark, SF_SMALL, "es"), "es")
        assert int(spark.conf.get(key)) == 8000
        spark.conf.set(key, "4000")         # a lower limit stays
        B.raw_report(spark, SF_SMALL, "us")
        assert spark.conf.get(key) == "4000"
    finally:
        spark.conf.unset(key)


def test_money_texts_of_all_sizes(spark):
    cents = [0, 5, 99, 100, -1, 99999, 100000, -123456, 99999999, 100000000, -123456789012, 10**17]
    df = spark.createDataFrame([(c,) for c in cents], "c long")
    rows = df.select("c", B._money_eu("c").alias("eu"), B._money_us("c").alias("us")).collect()
    for r in rows:
        whole, rest = divmod(abs(r["c"]), 100)
        sign = "-" if r["c"] < 0 else ""
        assert r["us"] == f"{sign}{whole}.{rest:02d}"
        assert r["eu"] == f"{sign}{whole:,}".replace(",", ".") + f",{rest:02d}"
    # the places of up to six digits are cut by arithmetic: no padding to 18 digits for each of them
    assert "< 1000000" in _plan(df.select(B._money_eu("c")))


def test_date_steps_carry_numbers_not_their_text(spark):
    """The numbers of a report are parsed below the steps of the date, straight from the cells and untrimmed."""
    from tillroll.operators.clean import clean
    raw = spark.createDataFrame([("1 gen 1998 10:00:00 UTC", "1", " 1.234,56 ", "-2,5")],
                                ["Data/Ora:", "quantità", "vendite", "totale"])
    df = clean(raw, "it")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("gettimestamp") < plan.index("try_cast")
    assert "trim(vendite" not in plan and "trim(product_sales" not in plan
    row = df.select("quantity", "product_sales", "total", "time").first()
    assert [str(x) for x in row] == ["1.0000", "1234.5600", "-2.5000", "10:00:00"]


def test_cents_take_no_padding(spark):
    """Two digits of cents come from a constant array."""
    from tillroll.plans.bindings import money_text
    df = spark.createDataFrame([(v,) for v in (-5, 0, 7, 123456, -99999999, None)], "v long")
    got = df.select(money_text("v", ".", ",").alias("t"))
    assert [r.t for r in got.collect()] == ["-0,05", "0,00", "0,07", "1.234,56", "-999.999,99", None]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "% 100" in plan and ", 2, 0)" not in plan


def test_month_at_its_place_takes_no_pattern(spark):
    """a report's month name is found by splitting its date text; other texts read as before."""
    from tillroll.functions import scalars as X
    from tillroll.functions.locales import PROFILES
    for p in ("it", "es", "fr"):
        plan = _plan(clean(B.raw_report(spark, SF_SMALL, p), p))
        assert "split(" in plan and "AS _month#" not in plan, p
        months = PROFILES[p].months
        a, b = list(months)[:2]
        texts = [None, "", " ", a, f"1 {a}", f"1 {a} ", f"x {a} 2025", f"1 {a} 2025 10:00:00 UTC", f"1 {a} 2 {b} 3", f"1 {a} {b} 2",
                 f" 1 {a} 2025", f"1  {a} 2025", f"1 {a}  2025  x y z", f"1 {a} 2025 1 {b} x", f"1 x 2 {b} y z", f"٣ {a} 2025",
                 f"1 {a}x 2025", f"a b c 4 {a} d e f 5 {b} g", "1 2 3", "1 Jan 2025 "]
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        got = [r.x for r in X.with_month_token(df, "x", months).select("x").collect()]
        assert got == [r.t for r in df.select(X.translate_month_token("x", months, plain=True).alias("t")).collect()], p
        assert got[7] == "1 Jan 2025 10:00:00 UTC" and got[0] is None
