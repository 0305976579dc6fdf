"""Exact nearest neighbours over (id, vec) tables."""

from __future__ import annotations

import sys
from math import ceil

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

# Rows of a block of queries and of vectors, and query rows whose scores are held at once.
QUERY_BLOCK = 8192
VECTOR_BLOCK = 16384
SMALL_BLOCK = 1024
SCORE_ROWS = 256
DIGITS = 6


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    rows = np.array(vectors.tolist(), dtype=np.float64)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1.0, norms)


def _best_of_rows(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rounded score) of the best ``n`` per row, ties by column; -inf is no candidate.

    What rounds to the n-th best of a row or above is within a unit of the last place of it: only these few are rounded and sorted.
    """
    floor = np.partition(scores, -n, axis=1)[:, -n] - 1.5 * 10.0 ** -DIGITS if scores.shape[1] > n else np.full(len(scores), -np.inf)
    row, column = np.nonzero(scores >= floor[:, None])
    found = np.round(scores[row, column], DIGITS)
    order = np.lexsort((column, -found, row))
    order = order[found[order] > -np.inf]
    row, column, found = row[order], column[order], found[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < n
    return row[kept], column[kept], found[kept]


def _block_top_n(n: int):
    def top_n(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(vectors):
            vectors = vectors.sort_values("id", ignore_index=True)
            ids, asked = vectors["id"].to_numpy(), queries["id"].to_numpy()
            units, wanted = _unit_rows(vectors["vec"]).T, _unit_rows(queries["vec"])
            finite = np.isfinite(units).all() and np.isfinite(wanted).all()
            same = pd.DataFrame({"id": asked, "row": np.arange(len(asked))}).dropna().merge(
                pd.DataFrame({"id": ids, "column": np.arange(len(ids))}).dropna(), on="id").sort_values("row")
            own_row, own_column = same["row"].to_numpy(), same["column"].to_numpy()
            for at in range(0, len(asked), SCORE_ROWS):
                scores = wanted[at:at + SCORE_ROWS] @ units
                if not finite:
                    scores[np.isnan(scores)] = -np.inf
                first, last = np.searchsorted(own_row, [at, at + SCORE_ROWS])
                scores[own_row[first:last] - at, own_column[first:last]] = -np.inf
                row, column, score = _best_of_rows(scores, n)
                found.append(pd.DataFrame({"query": asked[at + row], "id": ids[column], "similarity": score}))
        if not found:
            return pd.DataFrame({"query": [], "id": [], "similarity": []})
        return pd.concat(found, ignore_index=True)
    return top_n


def _blocks(n_rows: int, size: int) -> int:
    return max(1, ceil(n_rows / size))


def most_similar(queries: DataFrame, vectors: DataFrame, n: int) -> DataFrame:
    """Top ``n`` ids by cosine for each query vector, the query id itself left out.

    Both tables are ``(id, vec)``. They are cut into blocks of bounded size by a hash of
    the id; each pair of blocks is one matrix product in one task and emits only its
    best ``n`` per query. (query, id, similarity, rank), ties by id.
    """
    n_queries, cores = queries.count(), queries.sparkSession.sparkContext.defaultParallelism
    v_blocks = _blocks(vectors.count(), VECTOR_BLOCK)
    # A row of one table travels once for each block of the other, so blocks are large; few queries are cut for all cores.
    q_blocks = max(_blocks(n_queries, QUERY_BLOCK), min(_blocks(n_queries, SMALL_BLOCK), _blocks(2 * cores, v_blocks)))

    def every(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def block_of(blocks: int):
        return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    left = queries.select(F.col("id").alias("id"), F.col("vec").alias("vec"),
                          block_of(q_blocks).alias("qb"), every(v_blocks).alias("vb"))
    right = vectors.select("id", "vec", block_of(v_blocks).alias("vb"), every(q_blocks).alias("qb"))
    id_type = vectors.schema["id"].dataType
    schema = T.StructType([
        T.StructField("query", id_type), T.StructField("id", id_type),
        T.StructField("similarity", T.DoubleType())])
    best = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(_block_top_n(n), schema)
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
