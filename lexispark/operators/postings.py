"""Term counting and posting lists."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lexispark.functions.stemming import stem_values
from lexispark.functions.text import regex_tokens
from lexispark.operators.splitters import block_of

N_BUCKETS = 124          # fixed value: number of hash buckets of an index
# Doc-id width of one posting-list block; 32-bit ids give at most 65,536 blocks per term.
BLOCK_DOCS = 65_536
# Tokens that are counted at once, and rows of a batch that leaves the counter.
SLICE_TOKENS, SLICE_ROWS = 500_000, 65_536


def term_bucket(term: Column | str, n_buckets: int = N_BUCKETS) -> Column:
    """Stable bucket of a term: five-byte md5 prefix modulo ``n_buckets``."""
    prefix = F.conv(F.substring(F.md5(term), 1, 10), 16, 10).cast("bigint")
    return F.pmod(prefix, F.lit(n_buckets)).cast("int")


def count_tokens(docs: DataFrame, tokens: str = "tokens", stemming: bool = False, n_buckets: int | None = None) -> DataFrame:
    """(all other columns, term, tf) of a token column, counted inside each row; ``stemming`` counts stems.

    Tokens are an array, or one string with blanks between them. With ``n_buckets`` the rows have their ``bucket`` too (that of
    ``term_bucket``, taken once for each distinct word of a slice), and those of a slice come sorted by bucket and term: a
    sort of the postings merges these runs instead of comparing all rows.

    Nothing is shuffled, as a document is one row already. Within slices of an Arrow batch of at most
    SLICE_TOKENS tokens (or one document) the tokens are dictionary encoded, and a frequency is the length of a run of
    equal (row, code) pairs; what a task holds does not grow with its share of the documents.
    """
    rest = [c for c in docs.columns if c != tokens]
    added = [T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]
    if n_buckets:
        added.append(T.StructField("bucket", T.IntegerType()))
    schema = T.StructType([*docs.select(*rest).schema.fields, *added])
    return docs.select(*rest, tokens).mapInArrow(_counter(stemming, n_buckets), schema)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, number) of consecutive rows that hold at most SLICE_TOKENS tokens together, or a single row."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        done = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, done + SLICE_TOKENS, side="right")), first + 1)
        yield first, last - first
        first = last


def _sizes(tokens: pa.Array) -> np.ndarray:
    """Tokens of each row; none where it is null or an empty string."""
    if pa.types.is_string(tokens.type):
        sizes = pc.if_else(pc.equal(tokens, ""), 0, pc.add(pc.count_substring(tokens, " "), 1))
    else:
        sizes = pc.list_value_length(tokens)
    return pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)


def _buckets(words: pa.Array, n_buckets: int) -> np.ndarray:
    """``term_bucket`` of each word."""
    return np.array([int.from_bytes(md5(word.encode()).digest()[:5]) % n_buckets for word in words.to_pylist()], np.int32)


def _count_slice(rows: pa.RecordBatch, sizes: np.ndarray, memo: dict[str, str] | None, n_buckets: int | None = None) -> pa.RecordBatch:
    *rest, lists = rows.columns
    if pa.types.is_string(lists.type):
        lists = pc.split_pattern(lists.filter(pa.array(sizes > 0)), " ")
    encoded = lists.flatten().dictionary_encode()
    words, codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if memo is not None:
        stems = stem_values(words, memo).dictionary_encode()
        words, codes = stems.dictionary, stems.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    owner, names, last = np.repeat(np.arange(len(sizes)), sizes), [*rows.schema.names[:-1], "term", "tf"], []
    if n_buckets:
        buckets = _buckets(words, n_buckets)
        order = pc.sort_indices(pa.table({"bucket": buckets, "word": words}), [("bucket", "ascending"), ("word", "ascending")])
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        pairs, tf = np.unique(place[codes] * max(len(sizes), 1) + owner, return_counts=True)
        at, row = np.divmod(pairs, max(len(sizes), 1))
        code = order.to_numpy()[at]
        names, last = [*names, "bucket"], [pa.array(buckets[code])]
    else:
        pairs, tf = np.unique(owner * max(len(words), 1) + codes, return_counts=True)
        row, code = np.divmod(pairs, max(len(words), 1))
    row, code = pa.array(row), pa.array(code)
    return pa.RecordBatch.from_arrays(
        [*[column.take(row) for column in rest], words.take(code), pa.array(tf.astype(np.int64)), *last], names=names)


def _counter(stemming: bool, n_buckets: int | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = {} if stemming else None
        for batch in batches:
            sizes = _sizes(batch.column(batch.num_columns - 1))
            for first, n in _slices(sizes):
                counted = _count_slice(batch.slice(first, n), sizes[first:first + n], memo, n_buckets)
                for at in range(0, counted.num_rows, SLICE_ROWS):
                    yield counted.slice(at, SLICE_ROWS)
    return count


def count_words(docs: DataFrame, text: str = "text", stemming: bool = False) -> DataFrame:
    """Term frequency per row: all columns but the text (usually ``doc_id``), term and tf."""
    rest = [c for c in docs.columns if c != text]
    return count_tokens(docs.select(*rest, regex_tokens(text).alias("tokens")), stemming=stemming)


def explode_anchors(corpus: DataFrame, column: str = "anchor_text", source: str = "doc_id") -> DataFrame:
    """Flatten nested links to (source_id, pos, doc_id = link target, text = link text)."""
    links = corpus.select(F.col(source).alias("source_id"), F.posexplode(column).alias("pos", "link"))
    return links.select("source_id", "pos", F.col("link.id").alias("doc_id"), F.col("link.text").alias("text"))


def anchor_postings(anchors: DataFrame, stemming: bool = False) -> DataFrame:
    """Counts per link occurrence, then the set of (term, doc_id, tf).

    One document may keep several rows for a term when the frequencies differ.
    """
    return count_words(anchors.select("doc_id", "text"), stemming=stemming).select("term", "doc_id", "tf").distinct()


def posting_lists(postings: DataFrame, block_docs: int = BLOCK_DOCS,
                  splitters: Sequence[int] | None = None) -> DataFrame:
    """Posting lists sorted by (doc_id, tf), cut into doc-id blocks.

    A block holds the documents of one ``block_docs`` wide id range, or with ``splitters`` those from one
    splitter to the next, so no array and no task grows with the frequency of a term. Splitters measured on
    the documents keep blocks even, and their number bounded, where ids are sparse. Blocks in ascending
    order are the full list.
    """
    doc_id = F.col("doc_id")
    block = F.floor(doc_id / block_docs) if splitters is None else block_of(doc_id, splitters)
    blocked = postings.withColumn("block", block.cast("bigint"))
    return blocked.groupBy("term", "block").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))


def merge_posting_lists(shards: Sequence[DataFrame]) -> DataFrame:
    """Concatenate the lists of several shards (same block width) per term and block."""
    union = reduce(DataFrame.unionByName, shards)
    return union.groupBy("term", "block").agg(
        F.sort_array(F.flatten(F.collect_list("postings"))).alias("postings"))


def unnest_posting_lists(lists: DataFrame) -> DataFrame:
    """Back to one row per posting."""
    return lists.select("term", F.inline("postings"))


# Ship the functions of this module inside the counter, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
