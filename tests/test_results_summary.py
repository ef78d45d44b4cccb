"""Results table and summary: upserts, group replacement, JSON, roll-up."""

import datetime as dt

import pytest

from tillroll.operators import results as R
from tillroll.operators import summary as S

D1, D2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)


def _res(spark, rows):
    return spark.createDataFrame([(d, m, float(a), float(e), float(a + e)) for d, m, a, e in rows],
                                 R.RESULTS_SCHEMA)


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_same_market_g12(spark):
    old = _res(spark, [(D1, "A", 1, 1), (D1, "B", 2, 2), (D2, "A", 3, 3)])
    new = _res(spark, [(D1, "A", 9, 0)])
    out = _set(R.upsert_market(old, new))
    assert out == _set(_res(spark, [(D1, "A", 9, 0), (D1, "B", 2, 2), (D2, "A", 3, 3)]))
    assert _set(R.upsert_market(R.upsert_market(old, new), new)) == out     # idempotent


def test_replace_group_drops_missing_countries_g13(spark):
    old = _res(spark, [(D1, "EU - 1", 1, 1), (D1, "EU - 2", 2, 2), (D1, "US", 5, 5), (D2, "EU - 2", 7, 7)])
    new = _res(spark, [(D1, "EU - 1", 8, 8)])
    out = _set(R.replace_group(old, new, "EU"))
    assert out == _set(_res(spark, [(D1, "US", 5, 5), (D1, "EU - 1", 8, 8), (D2, "EU - 2", 7, 7)]))
    empty = new.limit(0)
    out2 = _set(R.replace_group(old, empty, "EU", report_date=D1))
    assert out2 == _set(_res(spark, [(D1, "US", 5, 5), (D2, "EU - 2", 7, 7)]))


def test_json_round_trip_and_legacy_document(spark):
    old = _res(spark, [(D1, "A", 1.5, 1), (D2, "B", 2, 2.25)])
    assert _set(R.from_json_text(R.to_json_lines(old))) == _set(old)
    doc = ('{"2025-03-01": [{"market": "A", "actual_sales": 1.5, "estimated_sales": 1.0, '
           '"total_estimation": 2.5}], "2025-03-02": []}')
    got = R.from_json_text(spark.createDataFrame([(doc,), ("",)], "json string")).collect()
    assert [(r["report_date"], r["market"], r["total_estimation"]) for r in got] == [(D1, "A", 2.5)]


def test_results_for_date_requires_rows(spark):
    old = _res(spark, [(D1, "A", 1, 1)])
    assert R.results_for_date(old, D1).count() == 1
    with pytest.raises(ValueError):
        R.results_for_date(old, D2)


def test_summary_order_totals_and_empty_group_g15(spark):
    res = _res(spark, [(D1, "EU - DE", 10, 1), (D1, "EU - FR", 20, 2), (D1, "US", 100, 10), (D2, "US", 1, 0)])
    rows = S.summary(res, group="EU").orderBy("report_date", "ord", "market").collect()
    got = [(r["report_date"], r["ord"], r["market"], r["currency"], r["total_estimation"]) for r in rows]
    assert got == [
        (D1, 1, "EU - DE", "€", 11.0), (D1, 1, "EU - FR", "€", 22.0), (D1, 2, "Total EU", "€", 33.0),
        (D1, 3, "US", "$", 110.0), (D1, 4, "Grand Total", "$", 143.0),
        (D2, 2, "Total EU", "€", 0.0), (D2, 3, "US", "$", 1.0), (D2, 4, "Grand Total", "$", 1.0)]
    html = S.html_rows(S.summary(res, group="EU")).filter("ord = 4").orderBy("report_date").collect()
    assert "$143.00" in html[0]["html"] and "font-weight: bold" in html[0]["html"]


def test_report_html_document(spark, tmp):
    from tillroll.sources.sinks import write_report_html
    import glob
    res = _res(spark, [(D1, "EU - DE", 10, 1), (D1, "US", 100, 10)])
    write_report_html(S.html_rows(S.summary(res, group="EU")), tmp + "/html")
    files = sorted(glob.glob(tmp + "/html/report_date=2025-03-01/*.txt"))
    text = "".join(open(f).read() for f in files)
    assert text.startswith("<html>") and text.rstrip().endswith("</html>")
    assert text.index("EU - DE") < text.index("Total EU") < text.index(">US<") < text.index("Grand Total")
