"""Joins and rankings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# At most this many terms can each own more than 1/FREQUENT_TERMS of all postings; their
# statistics may be broadcast whatever the size of the corpus.
FREQUENT_TERMS = 500_000
# A larger share makes a term hot: it is cut into slices in joins with many rows per term.
HOT_SHARE = 10_000
# Below this number of postings a plain join is enough.
PLAIN_JOIN_POSTINGS = 10_000_000


def join_term_stats(postings: DataFrame, stats: DataFrame, n_postings: int | None = None) -> DataFrame:
    """Postings with the statistics ``stats(term, df, …)`` of their term, one row per term.

    Word frequencies are very uneven: the frequent terms, a list of proven size, own most of
    the postings. Those are joined in place by broadcast; only the postings of rare terms are
    shuffled, and none of these terms can fill a task.
    """
    if n_postings is None or n_postings <= PLAIN_JOIN_POSTINGS:
        return postings.join(stats, "term")
    frequent = F.col("df") > n_postings / FREQUENT_TERMS
    common, rare = stats.where(frequent), stats.where(~frequent)
    in_place = postings.join(F.broadcast(common), "term")
    others = postings.join(F.broadcast(common.select("term")), "term", "left_anti")
    return in_place.unionByName(others.join(rare, "term"))


def join_terms(postings: DataFrame, terms: DataFrame, n_postings: int, df: str = "df") -> DataFrame:
    """Inner join on ``term`` with ``terms`` that hold several rows per term.

    Column ``df`` of ``terms`` is the length of the term's list in ``postings``. The postings of a hot
    term are spread over ``df / threshold`` slices by doc id and its rows in ``terms`` are repeated
    per slice. The broadcast list of hot terms has at most HOT_SHARE rows.
    """
    if n_postings <= PLAIN_JOIN_POSTINGS:
        return postings.join(terms, "term")
    threshold = max(n_postings // HOT_SHARE, 1)
    slices = F.ceil(F.col(df) / threshold).cast("int")
    hot = terms.where(F.col(df) > threshold).select("term", slices.alias("slices")).distinct()
    sliced_postings = (
        postings.join(F.broadcast(hot), "term", "left")
        .withColumn("slice", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("slices")), F.lit(0)).cast("int"))
        .drop("slices"))
    sliced_terms = terms.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    return sliced_postings.join(sliced_terms, ["term", "slice"]).drop("slice")


def number_rows(df: DataFrame, keys: Sequence[str], block: Sequence[Column],
                order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Exact 1-based row number per key without a window over the whole key.

    ``block`` splits a key into bounded pieces whose order agrees with the final order;
    ``order`` sorts inside a piece. Row numbers inside the pieces are shifted by the
    running size of the pieces before, so only piece sizes meet per key.
    """
    pieces = [f"__piece{i}" for i in range(len(block))]
    cut = df.select("*", *[c.alias(p) for c, p in zip(block, pieces)])
    group = [*keys, *pieces]
    before = Window.partitionBy(*keys).orderBy(*pieces).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*group).agg(F.count("*").alias("__n")).select(
        *group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    numbered = cut.withColumn("__row", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.join(offsets, group).select(
        *df.columns, (F.col("__row") + F.col("__offset")).cast("bigint").alias(name))
