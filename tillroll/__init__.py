"""tillroll: settlement-report cleaning and month-end sales estimation on Spark.

Every operation is a DataFrame transformation with the market as a column, so
one plan serves a handful of markets or millions of (market, SKU) series.
"""

from tillroll.session import checkpoint_dir, get_spark, load_table

__all__ = ["checkpoint_dir", "get_spark", "load_table"]
