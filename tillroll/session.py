"""Session and table helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (dates are never shifted),
# AQE for runtime re-planning (partition coalescing, skew join splitting).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Bytes of bytecode beyond which HotSpot leaves a method to its interpreter.
METHOD_BYTES = 8000


def compiled_rows(spark: SparkSession) -> None:
    """Let plans over the 30 columns of a report run compiled.

    Whole-stage code puts all columns of a projection into one method. Beyond ``METHOD_BYTES`` the JVM interprets
    such a method, ten times slower, yet Spark keeps it up to 65,535 bytes. With this limit Spark runs a
    stage with such a method operator by operator, in short methods; other stages stay as they are.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key, "65535")) > METHOD_BYTES:
        spark.conf.set(key, str(METHOD_BYTES))


_LOCAL_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local master may go without
    (tests): then a scratch folder of the application is used; anywhere else it raises, as a
    machine's own folder would be lost to the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        d = _LOCAL_DIRS.get(app) or _LOCAL_DIRS.setdefault(app, tempfile.mkdtemp(prefix="tillroll-ckpt-"))
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; all of an application's lie below one folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tillroll-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """Written to the shared folder and read back: what follows neither plans nor runs the steps before again.

    ``within`` names a folder of the caller's (``scratch_path``), who removes it when its job is done.
    """
    path = scratch_path(df.sparkSession, name) if within is None else f"{within}/{name}"
    df.write.option("compression", "zstd" if within else df.sparkSession.conf.get(
        "spark.sql.parquet.compression.codec")).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, with all that is in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """The shuffle files of what is written in here go when it is written, not when the driver collects garbage.

    Only for plans that run once: a frame that has run in here can't be read again from its shuffles.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
