"""Removal of word passages that an earlier document has, by suffix automata (operator 4)."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from .automata import SuffixAutomaton
from .hashing import joined, running, slices, word_bounds, word_hashes
from .segments import dealt, repeated_segments, row_spans, runs, segments, variant_texts, with_spans
from .tables import finished, stored

#: Words of one automaton.
SHARD_WORDS = 100_000
_FOUND = "anchor bigint, content bigint, lo int, hi int, first_doc bigint, print bigint"


def _cut_words(text: bytes, start: np.ndarray, windows: np.ndarray, window: int) -> list[bytes]:
    begin, end, _ = word_bounds(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    return [text[begin[a]:end[a + n + window - 2]] for a, n in zip(start.tolist(), windows.tolist())]


def _shard(window: int):
    """Build the automaton of one shard and stream its variants through it."""
    def match(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["anchor", "content"]).sort_values("first_doc", kind="stable")
        ids: dict[bytes, int] = {}
        words = [[ids.setdefault(w, len(ids)) for w in data.split()] for data in group["data"]]
        automaton = SuffixAutomaton()
        for sequence, document in zip(words, group["first_doc"].tolist()):
            automaton.add(sequence, document)
        firsts = [automaton.firsts(sequence, window) for sequence in words]
        count = np.array([len(f) for f in firsts])
        number = np.repeat(np.arange(len(firsts)), count)
        offset = np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count)
        first = np.concatenate([np.array(f, np.int64) for f in firsts])
        anchor, content, hot = (group[c].to_numpy() for c in ("anchor", "content", "hot"))
        change = (offset == 0) | hot[number]
        a, b = runs(first - first.min(), change)
        prints = np.full(len(number), None, object)
        if hot.any():
            values, bounds = word_hashes(*joined(pa.array(group["data"].tolist(), pa.binary())))
            at = bounds[number] + offset
            every = slices(running(values), at, at + window).view(np.int64)
            prints[hot[number]] = every[hot[number]]
        return pd.DataFrame({"anchor": anchor[number[a]], "content": content[number[a]], "lo": offset[a],
                             "hi": offset[b] + 1, "first_doc": first[a], "print": prints[a]})
    return match


def earlier_spans(docs: DataFrame, window: int = 50, gram: int = 16) -> DataFrame:
    """every document with ``__spans``, its words that repeat an earlier document.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word is marked if a window of ``window`` consecutive words
    covers it whose word sequence also starts in a document with a smaller ``doc_id``.
    ``__spans`` holds the maximal marked runs as array<struct<lo,hi>> of word numbers.

    The reference of a document is all of the corpus, in shards: the variants of anchors that occur
    more than once (see ``segments``). A shard of bounded size is one suffix automaton whose
    states know their smallest document. It is sent only to where its anchors occur: all
    variants that share an anchor are streamed through the automaton that holds it, and their
    matching statistics tell the windows of at least the threshold. Anchors
    with very many variants have several automata; the smallest document of a window is then the
    least of all of them.

    Defined cases: a null text has no words; texts under ``window`` words have no spans; a null id
    is neither earlier nor later than others, such a document keeps all words and is no reference;
    repeated rows share their id, so none is earlier than the other; other columns are
    kept; an empty table gives no rows.
    """
    return with_spans(docs, finished(lambda: row_spans(_marks(docs, window, gram), window)))


def _marks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(rid, lo, hi): ranges of window starts that repeat an earlier document."""
    found = stored(segments(docs.where(F.col("doc_id").isNotNull()), word_hashes, window, gram))
    near = stored(repeated_segments(found))
    variants = stored(near.groupBy("anchor", "content", "variants").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc"),
        F.min(F.struct("rid", "start", "windows")).alias("rep")))
    shared = dealt(variants.where("variants").drop("variants"), F.col("rep.windows") + F.lit(window - 1), SHARD_WORDS)
    texts = variant_texts(docs, shared, lambda t, a, n: _cut_words(t, a, n, window))
    matched = stored(texts.groupBy("shard").applyInPandas(_shard(window), _FOUND))
    dealt_out = matched.where(F.col("print").isNotNull())
    least = dealt_out.groupBy("anchor", "print").agg(F.min("first_doc").alias("least"))
    ranges = ["anchor", "content", "lo", "hi", "first_doc"]
    ranges = (matched.where(F.col("print").isNull()).select(ranges)
              .unionByName(dealt_out.join(least, ["anchor", "print"]).withColumn("first_doc", F.col("least")).select(ranges))
              .unionByName(variants.where(~F.col("variants")).select(
                  "anchor", "content", F.lit(0).alias("lo"), F.col("rep.windows").alias("hi"), "first_doc")))
    return near.join(ranges, ["anchor", "content"]).where(F.col("first_doc") < F.col("doc_id")).select(
        "rid", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))


def kept_words(text: str, spans) -> list[bytes]:
    words = text.encode().split()
    at, kept = 0, []
    for span in spans:
        kept.extend(words[at:span["lo"]])
        at = span["hi"]
    return kept + words[at:]


@F.pandas_udf(StructType().add("n_words", "long").add("kept_sha256", "string"))
def _digest(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(len(t.encode().split()), hashlib.sha256(b" ".join(kept_words(t, s))).hexdigest())
                         for t, s in zip(text, spans)], columns=["n_words", "kept_sha256"])


@F.pandas_udf(StringType())
def kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text without the words of its spans, words joined by one space."""
    return pd.Series([b" ".join(kept_words(t, s)).decode() for t, s in zip(text, spans)])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the result of ``earlier_spans``."""
    removed = F.aggregate("__spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["hi"] - s["lo"]))
    return docs.select("doc_id", removed.alias("n_removed"), _digest(F.coalesce("text", F.lit("")), "__spans").alias("d")).select(
        "doc_id", "d.n_words", "n_removed", "d.kept_sha256")
