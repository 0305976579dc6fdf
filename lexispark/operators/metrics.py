"""Ranking evaluation: ``hits(query_id, rank, doc_id)`` against ``qrels(query_id, doc_id)``.

Labels are counted as given, a document listed twice in a ranking counts at each of its ranks
unless noted. Values are rounded to three places, half to even.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

K = 40                   # fixed value: default cut-off
PLACES = 3


def _places(value: Column) -> Column:
    return F.bround(value, PLACES)


def _mean_of_rounded(value: Column) -> Column:
    """Mean of an array of rounded values, rounded again (half to even); summed as whole thousandths, so that a tie is one."""
    total = F.aggregate(value, F.lit(0.0), lambda a, x: a + F.rint(x * 1000))
    return F.rint(total / F.size(value)) / 1000


def count_hits(hits: DataFrame, qrels: DataFrame, k: int = K, run: Sequence[str] = ()) -> DataFrame:
    """The counts behind all metrics, one row per labelled query (and ``run`` key).

    Rankings are first reduced per document, joined to the labels on (query, document) and then
    reduced per query, so no task sees a whole ranking; arrays hold at most ``k`` ranks. What is
    known of a query travels with its labels.
    """
    doc_key, query_key = [*run, "query_id", "doc_id"], [*run, "query_id"]
    labels = qrels.select("query_id", "doc_id")
    sizes = labels.groupBy("query_id").agg(F.count("*").alias("n_true"))
    truth = labels.distinct().join(sizes, "query_id").withColumn("hit", F.lit(True))

    rank = F.col("rank")
    docs = hits.groupBy(*doc_key).agg(
        F.min("rank").alias("first_rank"), F.collect_list(F.when(rank <= k, rank)).alias("ranks"))
    marked = docs.join(truth, ["query_id", "doc_id"], "left")
    hit, first = F.col("hit"), F.col("first_rank")
    counts = marked.groupBy(*query_key).agg(
        F.sum(F.size("ranks")).alias("n_predicted"),
        F.sum(F.when(hit, F.size("ranks"))).alias("n_hits"),
        F.count(F.when(hit & (first <= k), 1)).alias("n_distinct_hits"),
        F.count(F.when(hit & (first <= F.col("n_true")), 1)).alias("n_r_hits"),
        F.count(F.when(hit, 1)).alias("n_common"),
        F.min(F.when(hit & (first <= k), first)).alias("first_hit"),
        F.sort_array(F.flatten(F.collect_list(F.when(hit, F.col("ranks"))))).alias("hit_ranks"))
    names = ["n_predicted", "n_hits", "n_distinct_hits", "n_r_hits", "n_common"]
    # A run key exists only on the hits; without one every labelled query gets a row.
    joined = counts.join(sizes, "query_id") if run else sizes.join(counts, "query_id", "left")
    return joined.select(
        *query_key, "n_true", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in names],
        "first_hit", F.coalesce(F.col("hit_ranks"), F.array().cast("array<int>")).alias("hit_ranks"),
        F.col("n_predicted").isNotNull().alias("answered"))


def intersect(hits: DataFrame, qrels: DataFrame) -> DataFrame:
    """(query_id, doc_id): the labelled documents that a ranking holds, each once."""
    return hits.select("query_id", "doc_id").intersect(qrels.select("query_id", "doc_id"))


def recall() -> Column:
    return _places(F.col("n_hits") / F.col("n_true"))


def precision(k: int = K) -> Column:
    """Divides by ``k`` even when fewer documents were returned."""
    return _places(F.col("n_hits") / F.lit(k))


def r_precision() -> Column:
    return _places(F.col("n_r_hits") / F.col("n_true"))


def reciprocal_rank() -> Column:
    return F.coalesce(_places(1 / F.col("first_hit")), F.lit(0.0))


def fallout_rate(universe: int) -> Column:
    """Wrong documents in the top k per irrelevant document of a universe of that size."""
    wrong = F.col("n_predicted") - F.col("n_distinct_hits")
    return _places(F.try_divide(wrong.cast("double"), universe - F.col("n_true")))


def f_score(k: int = K) -> Column:
    """``2P / (P + R)`` on the rounded values: the measure as published, without the factor R."""
    p, r = precision(k), recall()
    return F.when(p == 0, F.lit(0.0)).otherwise(_places(2 * p / (p + r)))


def f1(k: int = K) -> Column:
    """The harmonic mean ``2PR / (P + R)``."""
    p, r = precision(k), recall()
    return F.when(p == 0, F.lit(0.0)).otherwise(_places(2 * p * r / (p + r)))


def map_at_k() -> Column:
    """Mean over the hits found of the *rounded* precision at each hit; 0 without hits."""
    ranks = F.col("hit_ranks")
    precisions = F.transform(ranks, lambda r, i: _places((i + 1) / r))
    return F.when(F.size(ranks) > 0, _mean_of_rounded(precisions)).otherwise(F.lit(0.0))


def average_precision() -> Column:
    """The same without the inner rounding."""
    ranks = F.col("hit_ranks")
    total = F.aggregate(F.transform(ranks, lambda r, i: (i + 1) / r), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(ranks) > 0, _places(total / F.size(ranks))).otherwise(F.lit(0.0))


def evaluate(hits: DataFrame, qrels: DataFrame, universe: int, k: int = K) -> DataFrame:
    """All metrics, one row per labelled query."""
    return count_hits(hits, qrels, k).select(
        "query_id", map_at_k().alias("map"), map_at_k().alias("average_precision_at_k"),
        recall().alias("recall"), precision(k).alias("precision"), r_precision().alias("r_precision"),
        reciprocal_rank().alias("reciprocal_rank"), fallout_rate(universe).alias("fallout_rate"),
        f_score(k).alias("f_score"), f1(k).alias("f1"))


def evaluate_run(hits: DataFrame, qrels: DataFrame, k: int = K) -> DataFrame:
    """Average precision per labelled query; null where the search returned nothing."""
    return count_hits(hits, qrels, k).select(
        "query_id", F.when(F.col("answered"), average_precision()).alias("ap"))


def summarize_run(per_query: DataFrame) -> DataFrame:
    """One row: labelled queries, unanswered ones and the mean over the answered ones."""
    return per_query.agg(
        F.count("*").alias("n_queries"), F.count(F.when(F.col("ap").isNull(), 1)).alias("n_failed"),
        F.round(F.avg("ap"), 6).alias("mean_ap"))
