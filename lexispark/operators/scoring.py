"""Candidates and scores: TF-IDF cosine, BM25 and binary matching.

``matches`` are the rows of :func:`lexispark.operators.matching.match_terms` for distinct
query terms: query_id, term, doc_id, tf, dl, df, idf. Scores are rounded to DIGITS places so
that the order of summation cannot change a rank. Rows that are ``dealt`` by document already
are summed where they are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lexispark.operators.statistics import length_weight
from lexispark.settings import materialize, small_enough

DIGITS = 6
# Scores that are summed side by side in one row.
SCORE_COLUMNS = 32
# Rows of a partition in which several scores are summed.
PARTITION_CANDIDATES = 1_000_000


def candidate_documents(matches: DataFrame) -> DataFrame:
    """Distinct documents having any query term."""
    return matches.select("query_id", "doc_id").distinct()


def _by_document(matches: DataFrame) -> DataFrame:
    """``matches`` dealt by query and document before they are summed up.

    A scan of term-sorted postings meets a document again for few of a query's terms, so sums inside the scanning tasks would
    hold nearly all rows of a task and save next to nothing; behind the exchange they are as large as one of its partitions.
    """
    return matches.repartition("query_id", "doc_id")


def candidate_tfidf(matches: DataFrame, dealt: bool = False) -> DataFrame:
    """(query_id, doc_id, term, w_d): ``tf / dl * idf``; documents of length 0 have no weight."""
    weights = matches.select("query_id", "doc_id", "term", length_weight().alias("w"))
    weights = weights.where(F.col("w").isNotNull())
    return ((weights if dealt else _by_document(weights))
            .groupBy("query_id", "doc_id", "term").agg(F.sum("w").alias("w_d")))


def document_tfidf_matrix(weights: DataFrame) -> DataFrame:
    """One map term → weight per query and document (bounded by the terms of the query)."""
    entries = F.sort_array(F.collect_list(F.struct("term", "w_d")))
    return weights.groupBy("query_id", "doc_id").agg(F.map_from_entries(entries).alias("weights"))


def dense_tfidf_matrix(weights: DataFrame, terms: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """(query_id, doc_id, terms, weights): the dense form, one weight per candidate term of the query, 0.0 where a document lacks it.

    The columns of a query's matrix are its terms with any candidate, in order: as many as the query has
    words. ``terms(query_id, term)`` are these, if the caller has them for less than a pass over ``weights``. Documents are not
    gathered; the short column list meets each of their rows. The weights of a row come one after the other, and the rows of an
    Arrow batch are filled in at once.
    """
    columns = (weights if terms is None else terms).select("query_id", "term").distinct().groupBy("query_id").agg(
        F.sort_array(F.collect_list("term")).alias("terms"))
    # As many rows as query words: they are found once, and the rows of the documents stay where they are.
    listed = materialize(columns)
    numbered = listed.select("query_id", F.size("terms").alias("width"), F.posexplode("terms").alias("column", "term"))
    few = small_enough(numbered)
    cells = weights.join(F.broadcast(numbered) if few else numbered, ["query_id", "term"]).select(
        "query_id", "doc_id", "width", "column", F.col("w_d").cast("double").alias("w_d"))
    if dealt and few:
        cells = cells.sortWithinPartitions("query_id", "doc_id")
    else:
        # A number within the row of the matrix asks for its weights in one task, in order, wherever they are.
        cells = cells.withColumn("nth", F.row_number().over(Window.partitionBy("query_id", "doc_id").orderBy("column")))
    keys = cells.select("query_id", "doc_id").schema.fields
    filled = cells.mapInArrow(_dense_rows, T.StructType([*keys, T.StructField("weights", T.ArrayType(T.DoubleType()))]))
    return filled.join(F.broadcast(listed) if few else listed, "query_id").select("query_id", "doc_id", "terms", "weights")


def _dense_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, doc_id, weights) of cells (query_id, doc_id, width, column, w_d), those of a document one after the other."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        # The last row may go on in the next batch, and the first may have begun in the one before.
        cells = pa.Table.from_batches([*rest, batch]).combine_chunks()
        if cells.num_rows:
            first = _first_cells(cells)
            yield _filled(cells.slice(0, first[-1]), first[:-1])
            rest = cells.slice(first[-1]).to_batches()
    if rest:
        cells = pa.Table.from_batches(rest)
        yield _filled(cells, _first_cells(cells))


def _first_cells(cells: pa.Table) -> np.ndarray:
    """Where a query and document other than those of the cell before begin; null is a value."""
    new = np.zeros(cells.num_rows, bool)
    new[:1] = True
    for key in (0, 1):
        codes = cells.column(key).combine_chunks().dictionary_encode("encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _filled(cells: pa.Table, first: np.ndarray) -> pa.RecordBatch:
    width, column, weight = (cells.column(name).to_numpy() for name in ("width", "column", "w_d"))
    ends = np.cumsum(width[first], dtype=np.int64)
    values = np.zeros(ends[-1] if len(ends) else 0)
    values[np.repeat(ends - width[first], np.diff([*first, len(width)])) + column] = weight
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    keys = [cells.column(key).take(pa.array(first)).combine_chunks() for key in (0, 1)]
    return pa.RecordBatch.from_arrays([*keys, pa.ListArray.from_arrays(offsets, pa.array(values))], names=["query_id", "doc_id", "weights"])


def cosine_similarity(weighted: DataFrame, norms: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) from rows with ``w_d``, ``w_q`` and ``query_norm`` per term.

    Only the sums of the matching documents move; stored ``norms(doc_id, norm)`` are clustered by document.
    """
    dots = weighted.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("w_d") * F.col("w_q")).alias("dot"), F.max("query_norm").alias("query_norm"))
    cosine = F.try_divide(F.col("dot"), F.col("norm") * F.col("query_norm"))
    return (dots.join(norms, "doc_id")
            .select("query_id", "doc_id", F.round(cosine, DIGITS).alias("score"))
            .where(F.col("score").isNotNull()))


def binary_ranking(matches: DataFrame, distinct_terms: bool = False, dealt: bool = False) -> DataFrame:
    """Number of query tokens (column ``qtf`` counts duplicates) whose list has the document."""
    hits = F.lit(1) if distinct_terms else F.col("qtf")
    rows = matches.select("query_id", "doc_id", hits.alias("hits"))
    return (rows if dealt else _by_document(rows)).groupBy("query_id", "doc_id").agg(
        F.sum("hits").cast("bigint").alias("score"))


def bm25_idf(n_docs: Column | int, df: Column | str = "df") -> Column:
    """``ln(1 + (N - df + 0.5) / (df + 0.5))``."""
    n_docs = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    df = F.col(df) if isinstance(df, str) else df
    return F.ln(1 + (n_docs - df + 0.5) / (df + 0.5))


def term_candidates(matches: DataFrame, anchor_matches: DataFrame | None = None,
                    doc_stats: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """Documents with ``tf > 0`` per distinct query term.

    With ``anchor_matches`` the link texts add documents the term does not have in the
    index itself, with the (largest) link-text frequency and the length from ``doc_stats``; own
    postings have their length with them. Of ``dealt`` matches of both kinds, only ``doc_stats`` move to the documents.
    """
    own = matches.where(F.col("tf") > 0)
    if anchor_matches is None:
        return own
    keys = ["query_id", "term", "doc_id", "df"]
    none = F.lit(None).cast("bigint")
    both = own.select(*keys, F.col("tf").alias("own"), none.alias("linked"), "dl").unionByName(
        anchor_matches.select(*keys, none.alias("own"), F.col("tf").alias("linked"), none.alias("dl")))
    merged = (both if dealt else _by_document(both)).groupBy(*keys).agg(
        F.coalesce(F.max("own"), F.max("linked")).alias("tf"), F.max("dl").alias("dl"))
    if dealt:
        stats = doc_stats.select(F.col("doc_id").alias("__id"), F.col("dl").alias("__dl"), F.lit(True).alias("__found"))
        found = merged.join(stats.hint("shuffle_hash"), F.col("dl").isNull() & (F.col("doc_id") == F.col("__id")), "left")
        return found.where(F.col("dl").isNotNull() | F.col("__found")).select(
            *keys, "tf", F.coalesce("dl", "__dl").alias("dl"))
    linked = merged.where("dl is null").drop("dl").join(doc_stats.select("doc_id", "dl"), "doc_id")
    return merged.where("dl is not null").unionByName(linked)


def bm25_score(candidates: DataFrame, n_docs: Column | int, avgdl: Column | float,
               k1: float = 1.5, b: float = 0.75, dealt: bool = False) -> DataFrame:
    """(query_id, doc_id, score); how often a word occurs in the query does not count."""
    parts = candidates.select("query_id", "doc_id", _bm25_part(n_docs, avgdl, k1, b).alias("part"))
    return (parts if dealt else _by_document(parts)).groupBy("query_id", "doc_id").agg(F.round(F.sum("part"), DIGITS).alias("score"))


def _bm25_part(n_docs: Column | int, avgdl: Column | float, k1: float, b: float) -> Column:
    """What one term adds to the score of a document."""
    avgdl = avgdl if isinstance(avgdl, Column) else F.lit(avgdl)
    saturation = F.col("tf") + k1 * (1 - b + b * F.try_divide(F.col("dl"), avgdl))
    return bm25_idf(n_docs) * F.col("tf") * (k1 + 1) / saturation


def bm25_scores(candidates: DataFrame, n_docs: Column | int, avgdl: Column | float,
                variants: Sequence[tuple[float, float, int]], n_candidates: int | None = None, dealt: bool = False) -> DataFrame:
    """(variant, query_id, doc_id, score): the scores of all ``variants`` (k1, b, term set), numbered from 0.

    ``candidates`` name in ``term_sets`` the term sets that hold the term. A posting is not repeated per
    variant: up to SCORE_COLUMNS of them are summed side by side, and the exchange by query and document
    carries the frequencies that all of them are made of. With ``n_candidates`` a partition holds about
    PARTITION_CANDIDATES rows, whatever their size on disk.
    """
    groups = [range(i, min(i + SCORE_COLUMNS, len(variants))) for i in range(0, len(variants), SCORE_COLUMNS)]
    none = F.lit(None).cast("double")

    def part(v: int) -> Column:
        k1, b, terms = variants[v]
        return F.when(F.array_contains("term_sets", terms), _bm25_part(n_docs, avgdl, k1, b))

    width = range(min(SCORE_COLUMNS, len(variants)))
    parts = F.array(*[F.struct(F.lit(g).alias("group"), *[(part(group[i]) if i < len(group) else none).alias(f"part{i}")
                                                          for i in width]) for g, group in enumerate(groups)])
    found = candidates.select("query_id", "doc_id", "tf", "dl", "df", "term_sets")
    if n_candidates is not None:
        partitions = max(ceil(n_candidates / PARTITION_CANDIDATES), candidates.sparkSession.sparkContext.defaultParallelism)
        found = found.repartition(partitions, "query_id", "doc_id")
    elif not dealt:
        found = _by_document(found)
    rows = found.select("query_id", "doc_id", F.explode(parts).alias("p")).select("query_id", "doc_id", "p.*")
    sums = rows.groupBy("query_id", "doc_id", "group").agg(*[F.round(F.sum(f"part{i}"), DIGITS).alias(f"score{i}") for i in width])
    scores = F.array(*[F.struct((F.col("group") * SCORE_COLUMNS + i).alias("variant"), F.col(f"score{i}").alias("score"))
                       for i in width])
    return sums.select("query_id", "doc_id", F.explode(scores).alias("s")).where("s.score is not null").select(
        "s.variant", "query_id", "doc_id", "s.score")


# Ship the functions of this module inside the dense matrix, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
