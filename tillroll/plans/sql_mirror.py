"""DuckDB SQL mirrors of the estimate family, written from the definitions.

The oracle takes the cascading points literally (p1..p4 from the ranked
days), not the closed-form weights the Spark plan uses, so a match checks
the weight table too. Money is exact (cents with two more places); figures
round half to even, once.
"""

from __future__ import annotations

from tillroll.operators.calendar import bounds


def _lit(d) -> str:
    return f"DATE '{d.isoformat()}'"


def ranked_sql(src_sql: str, cutoff) -> str:
    b = bounds(cutoff)
    return f"""
day AS (SELECT market, d, sum(cents) AS cents FROM ({src_sql}) s
        WHERE d IS NOT NULL GROUP BY market, d),
ranked AS (SELECT market, d, cents, dayname(d) AS weekday,
                  row_number() OVER (PARTITION BY market, dayname(d) ORDER BY d DESC) AS rn
           FROM day WHERE d < {_lit(b['cutoff'])}),
recent AS (SELECT * FROM ranked WHERE rn <= 7)"""


def points_sql() -> str:
    rs = ",\n".join(f"max(CASE WHEN rn = {i + 1} THEN cents END) AS r{i}" for i in range(7))
    return f"""
piv AS (SELECT market, weekday, count(*) AS n, {rs} FROM recent GROUP BY market, weekday),
pts AS (SELECT market, weekday, n,
          CASE WHEN n >= 4 THEN r0 + r1 + r2 + r3 END AS q1,
          CASE WHEN n >= 5 THEN r1 + r2 + r3 + r4 END AS q2,
          CASE WHEN n >= 6 THEN r2 + r3 + r4 + r5 END AS q3,
          CASE WHEN n >= 7 THEN r3 + r4 + r5 + r6 + r0 END AS q4
        FROM piv),
prof AS (SELECT market, weekday, n,
           CASE WHEN n < 4 THEN 0 ELSE CAST(round_even(
             CAST(coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) + coalesce(q4, 0) AS DOUBLE)
             / (4 * (least(n, 7) - 3)), 0) AS BIGINT) END AS avg_cents
         FROM pts)"""


def calendar_sql(cutoff) -> str:
    b = bounds(cutoff)
    return f"""
cal AS (SELECT dayname(x) AS weekday, count(*) AS k
        FROM (SELECT CAST(unnest(generate_series({_lit(b['month_start'])}, {_lit(b['month_end'])},
                                                  INTERVAL 1 DAY)) AS DATE) AS x)
        WHERE x >= {_lit(b['cutoff'])} GROUP BY 1)"""


def estimate_sql(src_sql: str, cutoff) -> str:
    b = bounds(cutoff)
    return f"""
WITH {ranked_sql(src_sql, cutoff)},
{points_sql()},
{calendar_sql(cutoff)},
est AS (SELECT market, CAST(sum(avg_cents * k) AS BIGINT) AS e FROM prof JOIN cal USING (weekday) GROUP BY market),
act AS (SELECT market, sum(cents) AS a FROM day
        WHERE d BETWEEN {_lit(b['month_start'])} AND {_lit(b['report_date'])} GROUP BY market),
mk AS (SELECT DISTINCT market FROM ({src_sql}) s2)
SELECT {_lit(b['report_date'])} AS report_date, mk.market,
       round_even(CAST(coalesce(a, 0) AS DOUBLE), 0) / 100 AS actual_sales,
       CAST(coalesce(e, 0) AS DOUBLE) / 100 AS estimated_sales,
       round_even(CAST(coalesce(a, 0) + coalesce(e, 0) AS DOUBLE), 0) / 100 AS total_estimation
FROM mk LEFT JOIN act USING (market) LEFT JOIN est USING (market)"""
