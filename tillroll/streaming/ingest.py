"""Daily pick-up of new report files as a Structured Streaming job.

The stream is the folder's listing: its checkpoint remembers which files were
listed, so a rerun (``trigger(availableNow=True)``) sees only files that arrived
since. Each micro-batch hands its part of the listing to the same job as the batch form
(``plans.daily.take_files``): every file is read under its own header, rows count once the
run's commit is there, and a replayed batch, after a failure between commit and the
stream's own checkpoint, finds nothing new. A file that is no report is recorded as refused and
blocks nothing. State is the tables themselves: late files
simply land there and the next estimate reads them, so no watermark is needed.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans.daily import MarketSource, take_files
from tillroll.session import checkpoint_dir
from tillroll.sources.files import listing_columns

LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str | None,
                 profile: str, market: str, available_now: bool = True,
                 sku_dim: DataFrame | None = None, day_table: str | None = None, max_files: int = 1000):
    """Start the pick-up stream; returns the ``StreamingQuery``.

    With ``day_table`` each batch also brings the day totals up to date.
    ``checkpoint`` defaults to a folder under the cluster's shared
    ``spark.checkpoint.dir``. A micro-batch takes at most ``max_files`` files. A file
    without exactly one header goes to the table of file states as refused, with the reason, and
    is met again when it changes.
    """
    if checkpoint is None:
        safe = "".join(ch if ch.isalnum() else "_" for ch in market)
        checkpoint = os.path.join(checkpoint_dir(spark), "ingest", safe)
    listing = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
               .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files)
               .option("recursiveFileLookup", "true").load(source_dir).select(*listing_columns()))
    source = MarketSource(market, profile, source_dir)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        take_files(batch.sparkSession, batch, source, table_path, sku_dim, day_table, whole=False)

    w = listing.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str | None,
               profile: str, market: str, **kw) -> None:
    """Take every file not yet taken, then stop (the daily run)."""
    q = start_ingest(spark, source_dir, table_path, checkpoint, profile, market, **kw)
    q.awaitTermination()
