"""Top-N lists, side-table lookups and weighted fusion of ranked lists.

Hits are ``(query_id, doc_id, score)``; ties are broken by ascending doc id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from lexispark.operators.skew import number_rows
from lexispark.operators.splitters import block_of
from lexispark.settings import BROADCAST_ROWS

DIGITS = 6
RANK_BLOCK_DOCS = 65_536


def top_n(hits: DataFrame, n: int = 100, run: Sequence[str] = ()) -> DataFrame:
    """Best ``n`` hits per query (and ``run`` key) with their rank; each task forwards at most ``n`` of each."""
    order = Window.partitionBy(*run, "query_id").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def rank_all(hits: DataFrame, block_docs: int = RANK_BLOCK_DOCS, splitters: Sequence[int] | None = None,
             ties: Sequence[str] = ()) -> DataFrame:
    """Rank of every hit of lists with whole-number scores, however long the list is.

    A list is cut by score and by blocks of ids: at ``splitters`` measured on the documents of the index
    (``InvertedIndex.splitters``), which bounds blocks and their number for any ids; without them at every
    ``block_docs``, which should cut the range of the ids into some ten thousand blocks. Rows of one document are in the order of
    ``ties``.
    """
    block = F.floor(F.col("doc_id") / block_docs) if splitters is None else block_of(F.col("doc_id"), splitters)
    return number_rows(hits, ["query_id"], [-F.col("score"), block], [F.col("doc_id"), *map(F.col, ties)])


def _provably_small(max_rows: int | None) -> bool:
    return max_rows is not None and max_rows <= BROADCAST_ROWS


def lookup_values(ids: DataFrame, values: DataFrame, value: str, max_ids: int | None = None) -> DataFrame:
    """``ids`` with ``value`` of each doc id, 0 where it is missing; order columns stay.

    With ``max_ids`` (a proven bound, queries × N) small enough, the side table is first cut
    to the wanted ids in place; otherwise both sides are shuffled by doc id.
    """
    if _provably_small(max_ids):
        wanted = F.broadcast(ids.select("doc_id").distinct())
        values = values.join(wanted, "doc_id", "left_semi")
    return ids.join(values, "doc_id", "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def page_rank_lookup(ids: DataFrame, page_rank: DataFrame, max_ids: int | None = None) -> DataFrame:
    return lookup_values(ids, page_rank, "page_rank", max_ids)


def page_views_lookup(ids: DataFrame, page_views: DataFrame, max_ids: int | None = None) -> DataFrame:
    return lookup_values(ids, page_views, "views", max_ids)


def _scaled(score, low, high):
    return F.coalesce(F.try_divide(score - low, high - low), F.lit(0.0))


def min_max_scale(hits: DataFrame, keys: Sequence[str] = ("query_id", "source")) -> DataFrame:
    """``score`` scaled to 0..1 per list, 0 when all scores are equal.

    For lists of any length: the two bounds per list are aggregated and joined back.
    """
    keys = list(keys)
    bounds = hits.groupBy(*keys).agg(F.min("score").alias("low"), F.max("score").alias("high"))
    scaled = _scaled(F.col("score"), F.col("low"), F.col("high"))
    return hits.join(bounds, keys).select(*keys, "doc_id", scaled.alias("score"))


def fuse(sources: dict[str, tuple[DataFrame, float]], n: int, require_all: bool) -> DataFrame:
    """Scale every top-N list, add up ``weight * score`` per document, keep the best ``n``.

    A list that lacks a document adds nothing. With ``require_all`` a query that has no
    hit in some source has no result at all. The lists are short, so one exchange by query
    serves the scaling, the sums and the final ranking.
    """
    lists = [hits.select("query_id", "doc_id", F.col("score").cast("double").alias("score"),
                         F.lit(name).alias("source"), F.lit(float(weight)).alias("weight"))
             for name, (hits, weight) in sources.items()]
    rows = reduce(DataFrame.unionByName, lists).repartition("query_id")
    if require_all:
        present = F.size(F.collect_set("source").over(Window.partitionBy("query_id")))
        rows = rows.withColumn("present", present).where(F.col("present") == len(sources))
    window = Window.partitionBy("query_id", "source")
    scaled = _scaled(F.col("score"), F.min("score").over(window), F.max("score").over(window))
    parts = rows.select("query_id", "doc_id", (F.col("weight") * scaled).alias("part"))
    merged = parts.groupBy("query_id", "doc_id").agg(F.round(F.sum("part"), DIGITS).alias("score"))
    return top_n(merged, n)


def merge_two(first: DataFrame, second: DataFrame, w1: float = 0.5, w2: float = 0.5, n: int = 20) -> DataFrame:
    return fuse({"first": (first, w1), "second": (second, w2)}, n, require_all=False)


def merge_title_rank_views(title: DataFrame, page_rank: DataFrame, page_views: DataFrame,
                           w_title: float = 0.5, w_page_rank: float = 0.25,
                           w_page_views: float = 0.25, n: int = 10) -> DataFrame:
    return fuse({"title": (title, w_title), "page_rank": (page_rank, w_page_rank),
                 "page_views": (page_views, w_page_views)}, n, require_all=True)


def merge_all(body: DataFrame, title: DataFrame, page_rank: DataFrame, page_views: DataFrame,
              w_body: float = 0.25, w_title: float = 0.25, w_page_rank: float = 0.25,
              w_page_views: float = 0.25, n: int = 10) -> DataFrame:
    return fuse({"body": (body, w_body), "title": (title, w_title),
                 "page_rank": (page_rank, w_page_rank), "page_views": (page_views, w_page_views)},
                n, require_all=True)


def number_titles(titles: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, copy, title) dealt by document into ``partitions``; the titles of one document are numbered from 1."""
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("title"))
    known = titles.select("doc_id", "title").where(F.col("doc_id").isNotNull())
    return known.repartition(partitions, "doc_id").select("doc_id", copy.alias("copy"), "title")


def attach_titles(hits: DataFrame, titles: DataFrame, max_hits: int | None = None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Hits with their title, found by ``keys``; hits without one are dropped.

    ``max_hits`` is the proven size of the hit list (queries × N); small enough, it is
    broadcast and the title table is read in place.
    """
    hits = F.broadcast(hits) if _provably_small(max_hits) else hits
    return titles.select(*keys, "title").join(hits, list(keys))


def union_candidates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct documents of two hit lists."""
    ids = first.select("query_id", "doc_id").union(second.select("query_id", "doc_id"))
    return ids.distinct()
