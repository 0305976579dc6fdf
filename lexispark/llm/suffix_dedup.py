"""Removal of repeated byte strings by suffix arrays of shards (operator 3)."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from .hashing import byte_values, joined, running, slices
from .segments import dealt, repeated_segments, row_spans, runs, segments, variant_texts, with_spans
from .suffix_arrays import window_classes
from .tables import finished, stored, tasks_for

#: Bytes of one suffix array: a task that sorts it takes about a hundred times as much.
SHARD_BYTES = 512 * 1024
#: Rows of one merge task.
MERGE_ROWS = 200_000
_FOUND = "anchor bigint, content bigint, lo int, hi int, print bigint, shard bigint"


def _cut_bytes(text: bytes, start: np.ndarray, windows: np.ndarray, window: int) -> list[bytes]:
    return [text[a:a + n + window - 1] for a, n in zip(start.tolist(), windows.tolist())]


def _shard(window: int):
    """Sort one shard; report its repeated windows, and all windows of anchors dealt out."""
    def sort(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["anchor", "content"])
        strings = group["data"].tolist()
        number, offset, classes = window_classes(strings, window)
        anchor, content = group["anchor"].to_numpy(), group["content"].to_numpy()
        copies = group["copies"].to_numpy()[number]
        # equal windows have equal anchors: a class never mixes anchors at their own windows
        size = np.bincount(classes, copies)
        twice = size[classes] > 1
        a, b = runs(np.where(twice, 0, -1), offset == 0)
        found = pd.DataFrame({"anchor": anchor[number[a]], "content": content[number[a]],
                              "lo": offset[a], "hi": offset[b] + 1, "print": None})
        split = group["hot"].to_numpy()[number]
        if split.any():
            # one row per class is enough for the other shards; single windows also want an answer
            first = np.unique(classes, return_index=True)[1]
            pick = first[split[first]]
            data, bounds = joined(pa.array(strings, pa.binary()))
            at = bounds[number] + offset
            prints = slices(running(byte_values(data, bounds)[0]), at, at + window)
            found = pd.concat([found, pd.DataFrame({
                "anchor": anchor[number[pick]], "content": content[number[pick]], "lo": offset[pick],
                "hi": np.where(twice[pick], 0, offset[pick] + 1), "print": prints.view(np.int64)[pick]})])
        return found.assign(shard=key[0])[["anchor", "content", "lo", "hi", "print", "shard"]]
    return sort


def _merge(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Merge the sorted windows of several shards: binary search of each shard in all the others."""
    prints = group["print"].to_numpy()
    order = np.argsort(prints, kind="stable")
    every = prints[order]
    found = np.zeros(len(prints), bool)
    for _, run in group.reset_index(drop=True).groupby("shard", sort=False):
        at = run.index.to_numpy()
        own = np.sort(prints[at])
        wanted = prints[at]
        here = np.searchsorted(own, wanted, "right") - np.searchsorted(own, wanted, "left")
        all_ = np.searchsorted(every, wanted, "right") - np.searchsorted(every, wanted, "left")
        found[at] = all_ > here
    hit = group[found & (group["hi"].to_numpy() > 0)]
    return hit[["anchor", "content", "lo", "hi"]]


def repeated_spans(docs: DataFrame, window: int = 200, gram: int = 32) -> DataFrame:
    """every document with ``__spans``, its bytes covered by repeated byte strings.

    A string of ``window`` UTF-8 bytes is repeated if it starts at two places of the corpus, in one
    document or in two; all its occurrences are marked, overlapping ones too. ``__spans`` holds the
    maximal marked runs as array<struct<lo,hi>> of byte offsets.

    Windows that can be repeated are found by shared anchors. The variants of shared anchors are dealt
    to shards of bounded size; each shard is sorted by a suffix array and its common prefixes tell
    equal windows. Anchors with very many variants lie in several shards, whose
    windows are merged by binary search of their fingerprints.

    Defined cases: a null text counts as empty, an empty or short text has no spans; a
    repeated row is a second occurrence of all its strings; null ids are ordinary documents;
    other columns are kept; an empty table gives no rows.
    """
    return with_spans(docs, finished(lambda: row_spans(_marks(docs, window, gram), window)))


def _marks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(rid, lo, hi): ranges of window starts that are repeated."""
    found = stored(segments(docs, byte_values, window, gram).drop("doc_id"))
    near = stored(repeated_segments(found))
    plain = near.where(~F.col("variants")).select("rid", F.col("start").alias("lo"), (F.col("start") + F.col("windows")).alias("hi"))
    mixed = near.where("variants")
    variants = mixed.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "start", "windows")).alias("rep"))
    variants = stored(variants)
    shared = dealt(variants, F.col("rep.windows") + F.lit(window - 1), SHARD_BYTES).withColumn(
        "first_doc", F.lit(None).cast("bigint"))
    texts = variant_texts(docs, shared, lambda t, a, n: _cut_bytes(t, a, n, window))
    sorted_ = stored(texts.groupBy("shard").applyInPandas(_shard(window), _FOUND))
    across = sorted_.where(F.col("print").isNotNull())
    buckets = tasks_for(across.count(), MERGE_ROWS)
    merged = across.groupBy(F.pmod(F.xxhash64("print"), F.lit(buckets)).alias("bucket")).applyInPandas(
        _merge, "anchor bigint, content bigint, lo int, hi int")
    ranges = sorted_.where(F.col("print").isNull()).select("anchor", "content", "lo", "hi").unionByName(merged)
    marks = mixed.join(ranges, ["anchor", "content"]).select(
        "rid", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    return plain.unionByName(marks)


def kept_bytes(data: bytes, spans) -> bytes:
    at, parts = 0, []
    for span in spans:
        parts.append(data[at:span["lo"]])
        at = span["hi"]
    return b"".join([*parts, data[at:]])


@F.pandas_udf(StringType())
def _kept_digest(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else hashlib.sha256(kept_bytes(t.encode(), s)).hexdigest()
                      for t, s in zip(text, spans)])


@F.pandas_udf(StringType())
def kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text without its spans; a character that lost some of its bytes is left out."""
    return pd.Series([None if t is None else kept_bytes(t.encode(), s).decode("utf-8", "ignore")
                      for t, s in zip(text, spans)])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the result of ``repeated_spans``."""
    text = F.coalesce("text", F.lit(""))
    removed = F.aggregate("__spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["hi"] - s["lo"]))
    return docs.select(
        "doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), removed.alias("n_removed"),
        F.size("__spans").cast("bigint").alias("n_spans"),
        F.coalesce(_kept_digest(F.when(F.size("__spans") > 0, text), "__spans"), F.sha2(text, 256)).alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = 200) -> DataFrame:
    """The documents, all columns kept, without their repeated bytes; ``n_chars`` follows the text."""
    some = F.size("__spans") > 0
    cut = repeated_spans(docs, window).withColumn("text", F.when(some, kept_text(F.when(some, F.col("text")), "__spans")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(some, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)
