"""Types of a text table's columns, inferred as an aggregate.

Each value fits a set of types; a column's set is what fits all its values, an intersection, which merges
partially in any order (``bit_and``). The most special type left is the column's. Empty and null values
fit every type. One pass over the table, one row back, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Types from special to general, each a bit; the last always fits.
TYPES = ["bigint", "double", "boolean", "date", "timestamp", "string"]
_BIT = {t: 1 << k for k, t in enumerate(TYPES)}
_ALL = (1 << len(TYPES)) - 1


def fitting(value) -> F.Column:
    """The set of types that a text fits, as bits.

    Whole numbers of up to 18 digits and without leading zeros (``00123`` is a name) are also doubles;
    dates are ISO dates, and also timestamps.
    """
    v = F.trim(F.col(value) if isinstance(value, str) else value)
    bits = lambda *names: F.lit(sum(_BIT[n] for n in (*names, "string")))
    is_date = F.rlike(v, F.lit(r"^\d{4}-\d{2}-\d{2}$")) & F.try_to_date(v, "yyyy-MM-dd").isNotNull()
    is_time = (F.rlike(v, F.lit(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"))
               & v.try_cast("timestamp_ntz").isNotNull())
    return (F.when(v.isNull() | (v == ""), F.lit(_ALL))
            .when(F.rlike(v, F.lit(r"^-?(0|[1-9]\d{0,17})$")), bits("bigint", "double"))
            .when(F.rlike(v, F.lit(r"^-?(0|[1-9]\d*)?\.\d+$|^-?(0|[1-9]\d*)(\.\d*)?([eE][+-]?\d+)?$")), bits("double"))
            .when(F.rlike(v, F.lit(r"^(?i:true|false)$")), bits("boolean"))
            .when(is_date, bits("date", "timestamp")).when(is_time, bits("timestamp")).otherwise(bits()))


def infer_types(table: DataFrame) -> DataFrame:
    """``(column_name, type)``, one row per column of a text table, in its order. A column without values is text."""
    names = table.columns
    sets = table.toDF(*[f"c{k}" for k in range(len(names))]).agg(
        *[F.bit_and(fitting(f"c{k}")).alias(f"c{k}") for k in range(len(names))])

    def name(bits):
        out = F.when(bits.isNull() | (bits == _ALL), "string")
        for t in TYPES:
            out = out.when(bits.bitwiseAND(F.lit(_BIT[t])) > 0, t)
        return out

    rows = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("column_name"), name(F.col(f"c{k}")).alias("type"))
                     for k, n in enumerate(names)])
    return sets.select(F.inline(rows)).orderBy("place").select("column_name", "type")


def typed(table: DataFrame) -> DataFrame:
    """The text table with its inferred types; empty texts of typed columns are null. Only the types are on the driver."""
    types = [r["type"] for r in infer_types(table).collect()]
    names = table.columns
    plain = table.toDF(*[f"c{k}" for k in range(len(names))])
    as_time = {"timestamp": "timestamp_ntz"}
    cols = [F.col(f"c{k}") if t == "string" else F.when(F.trim(f"c{k}") != "", F.trim(f"c{k}")).try_cast(as_time.get(t, t))
            for k, t in enumerate(types)]
    return plain.select(*[c.alias(n) for c, n in zip(cols, names)])
