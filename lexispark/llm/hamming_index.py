"""Approximate nearest neighbours by multi-index hashing of learned binary codes (operator 7)."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import stored, tasks_for

#: Vectors that the rotation is learned from, chosen by a hash of their id.
SAMPLE = 4096
#: Bits of a code, and the substrings that it is split into.
BITS, PARTS = 64, 4
#: The radius is the one that held this share of the true neighbours of so many sampled queries.
WANTED, TRIALS = 0.97, 128
#: Vectors of one index shard, and queries of one block.
SHARD_ROWS, BLOCK_ROWS = 8192, 1024
_ITERATIONS = 30


def usable(vector: Column, dimension: int | None = None) -> Column:
    """True for vectors without null or non-finite components, not zero, of the given length."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = good & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good if dimension is None else good & (F.size(vector) == dimension), F.lit(False))


@dataclass
class Codes:
    """Centre, and rotation to one sign bit per column."""

    centre: np.ndarray
    rotation: np.ndarray

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.centre) @ self.rotation > 0

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of unit vectors, one row of PARTS substrings each."""
        width = BITS // PARTS
        return (self.bits(vectors).reshape(len(vectors), PARTS, width) @ (1 << np.arange(width))).astype(np.int64)


def learn(vectors: np.ndarray) -> Codes:
    """Iterative quantisation: principal directions, then the rotation closest to its own signs."""
    centre = vectors.mean(0)
    values, axes = np.linalg.eigh((vectors - centre).T @ (vectors - centre))
    axes = axes[:, np.argsort(-values)[:BITS]]
    if axes.shape[1] < BITS:  # few dimensions: the rest are random directions
        extra = np.random.default_rng(7).normal(size=(axes.shape[0], BITS - axes.shape[1]))
        return Codes(centre, np.hstack([axes, extra]))
    projected = (vectors - centre) @ axes
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(BITS, BITS)))[0]
    for _ in range(_ITERATIONS):
        u, _, v = np.linalg.svd(projected.T @ np.where(projected @ turn > 0, 1.0, -1.0))
        turn = u @ v
    return Codes(centre, axes @ turn)


def unit(vectors: list) -> np.ndarray:
    """Vectors as rows of length 1, computed row by row so that equal vectors stay equal."""
    rows = np.array([np.asarray(v, np.float64) for v in vectors])
    scale = np.abs(rows).max(1, keepdims=True)
    rows = rows / scale
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def probes(radius: int, width: int) -> np.ndarray:
    """All substrings with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.int64)


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All integers of the half-open ranges, one range after the other."""
    size = end - start
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def best_of(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties to the smaller id."""
    kept = np.arange(len(score))
    if len(score) > n:
        kept = np.flatnonzero(score >= np.partition(score, len(score) - n)[len(score) - n])
    return kept[np.lexsort((ids[kept], -score[kept]))[:n]]


def _search(codes: Codes, n: int, radius: int):
    """Search one shard for one block of queries: probe each substring, check codes, rerank by cosine."""
    width = BITS // PARTS
    flips = probes(radius // PARTS, width)  # pigeonhole: some substring is this close
    weight = np.array([bin(x).count("1") for x in range(1 << width)], np.int8)

    def search(_: tuple, shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_row": np.empty(0, np.int64), "query_id": np.empty(0, np.int64),
                             "vec_id": np.empty(0, np.int64), "score": np.empty(0)})]
        if len(shard) and len(block):
            vectors, queries = unit(shard["embedding"].tolist()), unit(block["embedding"].tolist())
            code, asked = codes.encode(vectors), codes.encode(queries)
            order = [np.argsort(code[:, p], kind="stable") for p in range(PARTS)]
            bucket = [np.searchsorted(code[o, p], np.arange((1 << width) + 1)) for p, o in enumerate(order)]
            ids, rows = shard["vec_id"].to_numpy(), shard["row"].to_numpy()
            for query, own, name, row in zip(queries, asked, block["vec_id"].tolist(), block["row"].tolist()):
                near = np.zeros(len(ids), bool)
                for p in range(PARTS):
                    value = own[p] ^ flips
                    near[order[p][ranges(bucket[p][value], bucket[p][value + 1])]] = True
                found = np.flatnonzero(near)
                far = weight[code[found] ^ own].sum(1)
                found = found[(far <= radius) & (rows[found] != row)]
                score = (vectors[found] * query).sum(1)
                best = best_of(score, ids[found], n)
                out.append(pd.DataFrame({"query_row": row, "query_id": name, "vec_id": ids[found[best]], "score": score[best]}))
        return pd.concat(out, ignore_index=True)
    return search


def _true_neighbours(codes: Codes, queries: list[tuple], n: int):
    """Exact neighbours of a bounded list of queries in the vectors of one task, with their Hamming distance."""
    def search(batches):
        rows = np.array([r for r, _ in queries])
        asked = unit([v for _, v in queries])
        own = codes.bits(asked)
        found = [pd.DataFrame({"query_row": np.empty(0, np.int64), "score": np.empty(0), "far": np.empty(0, np.int64)})]
        for batch in batches:
            vectors = unit(batch["embedding"].tolist())
            bits, key = codes.bits(vectors), batch["row"].to_numpy()
            for row, query, code in zip(rows, asked, own):
                score = np.where(key == row, -2.0, (vectors * query).sum(1))
                top = best_of(score, key, n)
                found.append(pd.DataFrame({"query_row": row, "score": score[top], "far": (bits[top] != code).sum(1)}))
            best = pd.concat(found, ignore_index=True)
            best = best[best["score"] > -2].sort_values("score", ascending=False)
            found = [best.groupby("query_row", sort=False).head(n)]
        yield found[0]
    return search


def fitted_radius(vectors: DataFrame, codes: Codes, n: int) -> int:
    """Hamming radius that holds WANTED of the true neighbours of TRIALS sampled queries.

    The trials are a bounded sample by a hash of their row; each is compared with all vectors.
    """
    order = Window.partitionBy("query_row").orderBy(F.desc("score"))
    trials = [(r["row"], r["embedding"]) for r in
              vectors.select("row", "embedding").orderBy(F.xxhash64("row"), "row").limit(TRIALS).collect()]
    found = (vectors.select("row", "embedding").mapInPandas(
        _true_neighbours(codes, trials, n), "query_row bigint, score double, far bigint")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("far").collect())
    return int(np.quantile([r["far"] for r in found] or [0], WANTED, method="higher"))


def nearest(embeddings: DataFrame, is_query: Column, n: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the n nearest rows found for every query, nearest first.

    ``embeddings`` (vec_id, embedding) holds queries and candidates; a query's own row is no candidate of
    it. Nearness is the cosine in double precision; ties go to the smaller vec_id.

    Codes are the signs of a rotation learned on a bounded sample. All rows are indexed, in shards of
    SHARD_ROWS, and queries come in blocks of BLOCK_ROWS; every block meets every shard in a task of
    its own. There each substring of a query's code is probed with all patterns of at most radius /
    PARTS flips, which finds every code within the radius (pigeonhole), and these are reranked by
    the vectors. The radius is fitted to the recall of a sample (``fitted_radius``). A query that
    finds fewer than n rows is compared with all rows, so its answer is never short.

    Defined cases: rows with a null id, or a vector that is null, zero, has null or non-finite
    components, or not the most frequent length, take no part; repeated rows are rows of their
    own; other columns are ignored; without usable rows there is no result.
    """
    good = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding"), is_query.alias("asked"))
    common = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = stored(good.where(F.size("embedding") == (common["d"] if common else 0)).withColumn(
        "row", F.monotonically_increasing_id()))
    total, asked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asked").cast("bigint")), F.lit(0))).first()
    result = "query_row bigint, query_id bigint, vec_id bigint, score double"
    if not total:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = rows.select("embedding").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()
    codes = learn(unit([r["embedding"] for r in sample]))
    radius = fitted_radius(rows, codes, n)
    shards, blocks = tasks_for(total, SHARD_ROWS), tasks_for(asked, BLOCK_ROWS)

    def met(part: DataFrame, queries: DataFrame, within: int, n_blocks: int) -> DataFrame:
        held = part.select("vec_id", "embedding", "row", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"),
                           F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
        sent = queries.select("vec_id", "embedding", "row", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int").alias("block"),
                              F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"))
        found = held.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInPandas(_search(codes, n, within), result)
        order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    queries = rows.where("asked")
    found = stored(met(rows, queries, radius, blocks))
    short = stored(queries.join(found.groupBy(F.col("query_row").alias("row")).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min(n, total - 1)), "row", "left_anti"))
    n_short = short.count()
    if n_short:
        again = met(rows, short, BITS, tasks_for(n_short, BLOCK_ROWS))
        found = found.join(short.select(F.col("row").alias("query_row")), "query_row", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")
