"""Which windows of a corpus can occur twice: anchored segments, shared by the two span removals.

Every document is cut into segments whose windows have one anchor (see ``hashing``). Equal
windows have equal anchors, so only anchors that occur more than once need a closer look, and only
segments of one anchor with each other. Equal segments are merged to one variant first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .hashing import anchored_segments, joined
from .tables import keyed, row_key

#: A task holds at most about this many variants of one anchor; an anchor with more is dealt out.
ANCHOR_VARIANTS = 4096
#: Texts that a task hashes at once hold about this many bytes.
BATCH_BYTES = 256 * 1024


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch with a ``text`` column into pieces of about BATCH_BYTES of text, one row at least."""
    sizes = pc.binary_length(batch.column(batch.schema.names.index("text"))).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // BATCH_BYTES
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def text_of(piece: pa.RecordBatch) -> pa.Array:
    return piece.column(piece.schema.names.index("text"))


def segments(docs: DataFrame, values: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
             window: int, gram: int) -> DataFrame:
    """One row per segment: (rid, doc_id, anchor, content, start, windows), ``start`` in values."""
    schema = "rid bigint, doc_id bigint, anchor bigint, content bigint, start int, windows int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                row, anchor, content, start, windows = anchored_segments(*values(*joined(text_of(piece))), window, gram)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(row), piece.column(1).take(row), pa.array(anchor.view(np.int64)),
                     pa.array(content.view(np.int64)), pa.array(start.astype(np.int32)),
                     pa.array(windows.astype(np.int32))],
                    names=["rid", "doc_id", "anchor", "content", "start", "windows"])

    return keyed(docs).mapInArrow(cut, schema)


def repeated_segments(found: DataFrame) -> DataFrame:
    """Segments whose anchor occurs more than once, with ``variants`` true where it has several.

    Counts are combined before the shuffle, and the join by anchor is one that Spark can split.
    """
    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"),
                                          F.max("content").alias("hi")).where("n > 1")
    return found.join(anchors, "anchor").select(*found.columns, (F.col("lo") != F.col("hi")).alias("variants"))


def variant_texts(docs: DataFrame, variants: DataFrame,
                  cut: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]) -> DataFrame:
    """The content of each variant (anchor, content, shard, copies, first_doc, rep) of a segment.

    ``rep`` (rid, start, windows) is where the variant occurs; ``cut`` gives the bytes of
    slices of a document. The documents move once, each with the list of its own slices.
    """
    names = ["anchor", "content", "shard", "hot", "copies", "first_doc"]
    wanted = variants.groupBy(F.col("rep.rid").alias("rid")).agg(F.collect_list(F.struct(
        *names, F.col("rep.start").alias("start"), F.col("rep.windows").alias("windows"))).alias("wanted"))
    schema = ("anchor bigint, content bigint, shard bigint, hot boolean, copies bigint, first_doc bigint, "
              "windows int, data binary")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                texts = text_of(piece).cast(pa.binary()).to_pylist()
                lists = piece.column(piece.schema.names.index("wanted"))
                parts = []
                for text, rows in zip(texts, lists):
                    rows = rows.values
                    start, windows = (rows.field(c).to_numpy() for c in ("start", "windows"))
                    parts.append((rows, cut(text, start, windows)))
                rows = pa.concat_arrays([r for r, _ in parts])
                yield pa.RecordBatch.from_arrays(
                    [*(rows.field(c) for c in (*names, "windows")),
                     pa.array([s for _, slices in parts for s in slices], pa.binary())],
                    names=[*names, "windows", "data"])

    return keyed(docs).select("rid", "text").join(wanted, "rid").mapInArrow(take, schema)


def dealt(variants: DataFrame, size: Column, per_shard: int) -> DataFrame:
    """Deal variants (anchor, content, …) to shards of about ``per_shard`` of ``size`` in all.

    All variants of an anchor share a shard, unless there are more than ANCHOR_VARIANTS; then they are
    dealt out by their content and ``hot`` is true.
    """
    total = variants.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n_shards = max(1, -(-int(total) // per_shard))
    hot = variants.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > ANCHOR_VARIANTS).select(
        "anchor", F.ceil(F.col("m") / ANCHOR_VARIANTS).alias("slices"))
    salt = F.coalesce(F.pmod(F.col("content"), F.col("slices")), F.lit(0))
    shard = F.pmod(F.xxhash64("anchor", salt), F.lit(n_shards))
    return variants.join(hot, "anchor", "left").select(
        *variants.columns, shard.alias("shard"), F.col("slices").isNotNull().alias("hot"))


def runs(flags: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of equal non-negative ``flags``; ``first`` always starts one."""
    change = np.concatenate([[True], flags[1:] != flags[:-1]]) | first
    start = np.flatnonzero(change)
    last = np.append(start[1:], len(flags)) - 1
    keep = flags[start] >= 0
    return start[keep], last[keep]


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, ascending and apart; touching intervals become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def row_spans(marks: DataFrame, window: int) -> DataFrame:
    """(__rid, __spans) of the documents that ``marks`` (rid, lo, hi), ranges of window starts, lie in.

    ``__spans`` is the union of the marked windows, array<struct<lo,hi>> of values, ascending and apart. Store it before
    ``with_spans``: a stage that also cuts the texts would hold two Python workers for each of its tasks.
    """
    @F.pandas_udf("array<struct<lo:int,hi:int>>")
    def union(lists: pd.Series) -> pd.Series:
        return pd.Series([[{"lo": a, "hi": b} for a, b in zip(*(e.tolist() for e in merged(
            marks >> 32, (marks & 0xFFFFFFFF) + window - 1)))] for marks in lists])

    packed = F.col("lo").cast("bigint") * F.lit(1 << 32) + F.col("hi")
    return marks.groupBy(F.col("rid").alias("__rid")).agg(F.collect_set(packed).alias("marks")).select(
        "__rid", union("marks").alias("__spans"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every document with all its columns, and ``__spans`` of the result of ``row_spans``, empty where nothing is marked."""
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    return docs.withColumn("__rid", row_key()).join(spans, "__rid", "left").withColumn(
        "__spans", F.coalesce("__spans", none)).drop("__rid")
