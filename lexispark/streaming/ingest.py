"""Documents arriving as a stream.

The stream only tokenises, row by row, and appends to a Parquet sink whose log makes a restart
exactly-once. Term frequencies and statistics come from publishing what has arrived as the
next generation of an index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexispark import schemas
from lexispark.plans.build import not_indexed, one_per_id, publish_tokens, tokenize_documents
from lexispark.sources.index_store import InvertedIndex, read_index

_INBOX = schemas.INBOX


def stream_documents(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Unbounded ``(doc_id, text)`` from Parquet files appearing below ``path``."""
    return spark.readStream.schema(schemas.DOCUMENTS).options(**options).parquet(path)


def ingest_tokens(docs: DataFrame, inbox: str, checkpoint: str, stemming: bool = False) -> StreamingQuery:
    """Process everything that is available, then stop; call again for what comes later."""
    return (tokenize_documents(docs, stemming).writeStream.format("parquet").outputMode("append")
            .option("path", inbox).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def publish_inbox(spark: SparkSession, inbox: str, root: str, first: bool = False, refresh: bool | None = None,
                  **settings) -> InvertedIndex:
    """Index the documents that arrived since the last call; ``first`` starts a new index.

    The index logs the files of the inbox that its generations were made of, so only new ones are opened. A
    file is logged with the commit of its documents: a call that dies is repeated as a whole.
    """
    previous = None if first else read_index(spark, root)
    name = lambda file: file.rstrip("/").rpartition("/")[2]
    files = spark.read.schema(_INBOX).parquet(inbox).inputFiles()
    done = {r.file for r in previous.table("inbox_log").collect()} if previous else set()
    new = sorted(f for f in files if name(f) not in done)
    if previous and not new:
        return previous
    tokens = spark.read.schema(_INBOX).parquet(*new) if new else spark.createDataFrame([], _INBOX)
    if previous:
        tokens = not_indexed(tokens, previous)
    return publish_tokens(spark, root, one_per_id(tokens), previous, refresh=refresh,
                          inbox_files=[name(f) for f in new], **settings)
