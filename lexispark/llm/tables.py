"""Spark helpers of the package: stored intermediate tables and row keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lexispark.settings import work_dir

#: Words of the contracts of this package.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared work folder and read it back.

    Cuts the lineage, and several plans read the table without running its plan again; the
    files outlive any executor.
    """
    path = f"{work_dir(df.sparkSession)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _steps:
        _steps[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Paths that the steps under way have stored, the innermost step last.
_steps: list[list[str]] = []


def finished(step: Callable[[], DataFrame]) -> DataFrame:
    """Store the result of ``step``, and remove what it stored on the way: nothing reads that any more."""
    own: list[str] = []
    _steps.append(own)
    try:
        result = step()
    finally:
        _steps.pop()
    kept = stored(result)
    spark = kept.sparkSession
    for path in own:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return kept


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row from its id and whole text; repeated rows share their key."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def keyed(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text) of every document; a null text counts as empty."""
    return docs.select(row_key().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def tasks_for(rows: int, per_task: int) -> int:
    """Number of partitions so that one holds about ``per_task`` rows."""
    return max(1, -(-rows // per_task))
