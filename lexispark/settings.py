"""Session helpers: the shared work folder and the size check behind every broadcast."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# A table may be broadcast while it stays below both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Literals of one column filter that Parquet is asked for one by one; above this Spark passes on their range only.
PUSHED_LITERALS = 256
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; where none is set, one in the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()  # ends with a folder of the application
    if current:
        return current.rstrip("/").rpartition("/")[0]
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lexispark-work"


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables, private to this application."""
    return f"{_shared_folder(spark)}/lexispark-{spark.sparkContext.applicationId}"


def small_enough(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than that."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a checked size; otherwise the plain table (shuffle join)."""
    return F.broadcast(df) if small_enough(df, max_rows) else df


def materialize(df: DataFrame) -> DataFrame:
    """Write a table that several plans read to the shared checkpoint folder, once."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_folder(spark))
    return df.checkpoint()


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Plans made and run inside give back the files of their exchanges as soon as they are done.

    Otherwise these stay until the driver happens to collect its garbage. A table that is used after the block has to be written
    in it, or read anew: a plan made inside would run its exchanges again each time.
    """
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def push_literals(spark: SparkSession) -> None:
    """Let filters with up to PUSHED_LITERALS values reach the pages of Parquet files as they are."""
    key = "spark.sql.parquet.pushdown.inFilterThreshold"
    if int(spark.conf.get(key)) < PUSHED_LITERALS:
        spark.conf.set(key, str(PUSHED_LITERALS))
