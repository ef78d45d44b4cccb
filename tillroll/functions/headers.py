"""Header (column name) handling. Names only: no data goes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.locales import LocaleProfile
from tillroll.session import compiled_rows


def _apostrophes(s: str) -> str:
    return s.replace("’", "'")


def normalize_header(name: str, profile: LocaleProfile | None = None) -> str:
    """Space and ``/`` -> ``_``; per profile also drop ``:`` and lower-case."""
    s = name.replace(" ", "_").replace("/", "_")
    if profile is not None and profile.strip_colon:
        s = s.replace(":", "")
    if profile is not None and profile.lower_headers:
        s = s.lower()
    return s


def normalize_headers(df: DataFrame, profile: LocaleProfile | None = None) -> DataFrame:
    """Normalize every name; when two collide the first column wins.

    Columns are picked by position, so duplicate source names are no problem.
    """
    compiled_rows(df.sparkSession)
    names = [normalize_header(c, profile) for c in df.columns]
    first = {}
    for i, n in enumerate(names):
        first.setdefault(n, i)
    tmp = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return tmp.select(*[F.col(f"_c{i}").alias(n) for n, i in first.items()])


def locale_rename(df: DataFrame, profile: LocaleProfile) -> DataFrame:
    """P5: localized header -> canonical name; unknown names pass through.

    Keys are matched after making both apostrophe forms the same.
    """
    if not profile.headers:
        return df
    lookup = {_apostrophes(k): v for k, v in profile.headers.items()}
    mapping = {c: lookup[_apostrophes(c)] for c in df.columns if _apostrophes(c) in lookup}
    mapping = {k: v for k, v in mapping.items() if k != v}
    return df.withColumnsRenamed(mapping) if mapping else df


def canonical_header_names(names: F.Column, profile: LocaleProfile) -> F.Column:
    """P1-P3, P5 for an array of header names: each name as ``normalize_header`` and ``locale_rename`` leave it."""
    lookup = {_apostrophes(k): v for k, v in profile.headers.items()}
    pairs = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv]) if lookup else None

    def canonical(n):
        n = F.translate(n, " /", "__")
        if profile.strip_colon:
            n = F.replace(n, F.lit(":"), F.lit(""))
        if profile.lower_headers:
            n = F.lower(n)
        return n if pairs is None else F.coalesce(F.element_at(pairs, F.replace(n, F.lit("’"), F.lit("'"))), n)

    return F.transform(names, canonical)


def canonical_select(df: DataFrame, columns, extras=("market", "report_date", "source_file"),
                     fill_missing: bool = False, types: dict | None = None) -> DataFrame:
    """Canonical order; only columns that exist (or typed nulls if ``fill_missing``)."""
    cols = []
    for c in columns:
        if c in df.columns:
            cols.append(F.col(c))
        elif fill_missing:
            cols.append(F.lit(None).cast((types or {}).get(c, "string")).alias(c))
    cols += [F.col(e) for e in extras if e in df.columns and e not in columns]
    return df.select(*cols)
