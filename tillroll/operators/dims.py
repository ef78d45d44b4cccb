"""Dimension handling: lookup joins and the SKU -> ASIN lookup.

No join is hinted: Catalyst broadcasts a side below its byte threshold, and AQE
does so at run time from the measured size; beyond it both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def sku_dimension(sheet: DataFrame, sku_col: str = "seller-sku", asin_col: str = "ASIN") -> DataFrame:
    """Project the material-master sheet to ``(sku, ASIN)``, both as text."""
    return sheet.select(F.col(f"`{sku_col}`").cast("string").alias("sku"),
                        F.col(f"`{asin_col}`").cast("string").alias("ASIN"))


def sku_first(sheet: DataFrame, order_col: str = "row_no", sku_col: str = "seller-sku",
              asin_col: str = "ASIN") -> DataFrame:
    """Unique by sku, the first row in sheet order wins.

    ``min_by`` is an aggregate with a map-side partial step, so a sku that
    repeats many times is combined before the shuffle (no window sort).
    """
    return (sheet.select(F.col(f"`{sku_col}`").cast("string").alias("sku"),
                         F.col(f"`{asin_col}`").cast("string").alias("ASIN"),
                         F.col(order_col).alias("_ord"))
            .groupBy("sku").agg(F.min_by("ASIN", "_ord").alias("ASIN")))


def with_asin(tx: DataFrame, dim: DataFrame, sku_col: str = "sku") -> DataFrame:
    """Left lookup of ASIN by sku; no match -> null; row count unchanged.

    ``dim`` must be unique by sku (see ``sku_first``).
    """
    d = dim.select(F.col("sku").alias("_dim_sku"), F.col("ASIN").alias("_dim_asin"))
    tx = tx.drop("ASIN") if "ASIN" in tx.columns else tx
    out = tx.join(d, F.col(sku_col).cast("string") == F.col("_dim_sku"), "left")
    return out.withColumnRenamed("_dim_asin", "ASIN").drop("_dim_sku")


def sku_map_json(dim: DataFrame) -> DataFrame:
    """K4: the SKU -> ASIN map as JSON, one ``{"sku":"ASIN"}`` object per entry.

    The map is written as JSON Lines (one entry per line) rather than one
    document, so no task ever holds the whole dimension.
    """
    return dim.select("sku", F.to_json(F.create_map(F.col("sku"), F.col("ASIN"))).alias("json"))
