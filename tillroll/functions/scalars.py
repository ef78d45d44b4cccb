"""Scalar column functions (all built-in Spark expressions, no UDFs)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text clean-up ---------------------------------------------------------

def strip_zone(c, zones: Iterable[str] = (" PST", " PDT")) -> Column:
    """Remove literal zone suffixes (anywhere in the text); the wall clock is kept."""
    out = _col(c)
    for z in zones:
        out = F.replace(out, F.lit(z), F.lit(""))
    return out


def normalize_spaces(c) -> Column:
    """Every run of white space (no-break spaces included) becomes one plain space."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def translate_months(c, months: dict) -> Column:
    """Localized month name -> English, only between a digit+space and a space.

    ``(?U)`` makes ``\\s`` match a no-break space too, as the source rule does.
    """
    out = _col(c)
    for name, eng in months.items():
        out = F.regexp_replace(out, r"(?U)(?<=\d\s)\Q" + name + r"\E(?=\s)", eng)
    return out


# Characters Python's ``\s`` matches in text (Unicode white space).
UNICODE_SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def plain_spaces(c) -> Column:
    """Every white-space character becomes one plain space (one for one, no regex)."""
    return F.translate(_col(c), UNICODE_SPACES, " " * len(UNICODE_SPACES))


def _month_alternation(months: dict, unicode: bool = True, twice: bool = False) -> str:
    names = sorted(months, key=len, reverse=True)
    alt = "(" + "|".join(r"\Q" + n + r"\E" for n in names) + ")"
    one = (r"(?<=\d\s)" + alt + r"(?=\s)") if unicode else (r"(?<=\d )" + alt + r"(?= )")
    body = one + ".*" + one if twice else one
    return ("(?sU)" if unicode else "(?s)") + body if twice else (("(?U)" if unicode else "") + body)


def translate_month_token(c, months: dict, plain: bool = False) -> Column:
    """Same result as ``translate_months`` with three cheap passes instead of twelve
    replacements.

    The month name in context is found (``regexp_extract``) with its position
    (``regexp_instr``) and its English name is spliced in (``overlay``). A
    text holding a second month name in context (never a date-time) takes
    the exact chained path. With ``plain`` the text must already have plain
    spaces only (see ``plain_spaces``), which allows ASCII patterns.
    """
    text = _col(c)
    pat = _month_alternation(months, unicode=not plain)
    tok = F.regexp_extract(text, pat, 1)
    lookup = F.create_map(*[F.lit(x) for kv in months.items() for x in kv])
    pos = F.regexp_instr(text, F.lit(pat))
    fast = F.overlay(text, F.element_at(lookup, tok), pos, F.length(tok))
    twice = text.rlike(_month_alternation(months, unicode=not plain, twice=True))
    return (F.when(tok == "", text).when(~twice, fast)
            .otherwise(translate_months(text, months)))


def with_month_token(df, text: str, months: dict):
    """``translate_months`` on column ``text`` (plain spaces only), word by word.

    Between plain spaces a month name in context is a whole word behind a word that ends with a digit, and not the last.
    In texts of up to five words, the month at most the second of them, it is put
    in its place without a pattern. All others (never a date-time) take ``translate_month_token``.
    """
    lookup = F.create_map(*[F.lit(x) for kv in months.items() for x in kv])
    df = df.withColumn("_words", F.split(text, " "))
    word = [F.get("_words", F.lit(k)) for k in range(5)]
    later = F.coalesce(word[2].isin(*months), F.lit(False)) | F.coalesce(word[3].isin(*months), F.lit(False))
    behind_digit = F.substring(word[0], -1, 1).between("0", "9")
    # the last of the words has no space behind it
    month = F.when(behind_digit & (F.size("_words") > 2), F.element_at(lookup, word[1]))
    short = F.concat_ws(" ", word[0], F.coalesce(month, word[1]), *word[2:])
    done = (F.when((F.size("_words") <= 5) & ~later, short)
            .otherwise(translate_month_token(F.array_join("_words", " "), months, plain=True)))
    return df.withColumn(text, F.when(F.col("_words").isNotNull(), done)).drop("_words")


def collapse_spaces(c) -> Column:
    """Runs of plain spaces -> one space, trimmed (text with plain spaces only)."""
    text = _col(c)
    return F.trim(F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text))


# -- date and time ---------------------------------------------------------

def parse_datetime(c, patterns: Iterable[str]) -> Column:
    """First pattern that parses wins; text that fits none gives null."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(p)) for p in patterns])


def date_part(ts) -> Column:
    return F.to_date(_col(ts))


def time_part(ts) -> Column:
    return F.date_format(_col(ts), "HH:mm:ss")


def weekday_name(d) -> Column:
    """Full English weekday name (``Monday``)."""
    return F.date_format(_col(d), "EEEE")


# -- numbers ---------------------------------------------------------------

def to_number_us(c, dtype: str = MONEY) -> Column:
    """Dot-decimal text -> number, else null (``1,234.56`` is null, as in the source); the cast trims."""
    return _col(c).try_cast(dtype)


def to_number_eu(c, dtype: str = MONEY) -> Column:
    """Decimal-comma text -> number: drop every ``.``, then ``,`` -> ``.``; else null."""
    text = F.replace(F.replace(_col(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return text.try_cast(dtype)


def to_cents(c) -> Column:
    """Money -> exact integer cents (amounts are rounded to cents first)."""
    return F.round(_col(c).cast("double") * 100).cast("bigint")


def to_units(c) -> Column:
    """Money -> exact integer ten-thousandths, the scale of ``MONEY``."""
    return F.round(_col(c).cast("double") * 10000).cast("bigint")


def units_to_cents(units) -> Column:
    """Ten-thousandths -> exact cents with two more places (``decimal(22,2)``)."""
    return (_col(units).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(22,2)")


def whole_cents(c) -> Column:
    """Exact cents -> integer cents, half to even: the one rounding of a figure."""
    return F.bround(_col(c), 0).cast("bigint")


def cents_to_amount(c) -> Column:
    return (_col(c) / F.lit(100.0)).cast("double")


def round_half_even(c, scale: int = 2) -> Column:
    return F.bround(_col(c), scale)


def div_round_half_even(num, den) -> Column:
    """Integer ``num / den`` rounded half to even (exact for the divisors used here)."""
    return F.rint(_col(num).cast("double") / _col(den).cast("double")).cast("bigint")


def money_format(x, symbol) -> Column:
    """``€1,234.50`` / ``$-12.00``: symbol, thousands separators, two decimals."""
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    return F.concat(sym, F.format_number(_col(x).cast("double"), 2))


# -- calendar --------------------------------------------------------------

def as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def report_date_of(cutoff) -> Column:
    """The report covers the day before the cutoff."""
    return F.date_sub(_col(cutoff), 1)


def month_start_of(d) -> Column:
    return F.trunc(_col(d), "MM")


def month_end_of(d) -> Column:
    return F.last_day(_col(d))


def cutoff_in_month(year, month, day) -> Column:
    """Day ``day`` of a month; an impossible day raises (ANSI mode)."""
    return F.make_date(_col(year), _col(month), _col(day))


def date_labels(d) -> dict:
    """Text forms of a date used by the results key and the summary."""
    d = _col(d)
    return {
        "iso": F.date_format(d, "yyyy-MM-dd"),
        "month_day": F.date_format(d, "MMMM dd"),
        "long": F.date_format(d, "MMMM d, yyyy"),
        "us": F.date_format(d, "MM/dd/yyyy"),
    }


def range_label(start, end) -> Column:
    """``for March 1, 2025`` when one day, else ``from A to B``."""
    a = F.date_format(_col(start), "MMMM d, yyyy")
    b = F.date_format(_col(end), "MMMM d, yyyy")
    return F.when(a == b, F.concat(F.lit("for "), b)).otherwise(
        F.concat(F.lit("from "), a, F.lit(" to "), b))
