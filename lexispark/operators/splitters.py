"""Blocks of documents cut by measured ids, so that they are even however the ids are spread over 64 bits."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

# Documents of one block, and the largest number of blocks: beyond their product the blocks grow.
BLOCK_DOCS, MOST_BLOCKS = 65_536, 4_096
# Accuracy of the quantile sketch for each block: a block is off by at most a quarter of its size.
ACCURACY = 8


def id_splitters(ids: DataFrame, n_ids: int, block_docs: int = BLOCK_DOCS) -> list[int]:
    """Ascending first ids of all blocks but the first: quantiles of ``ids(doc_id)``, sketched in one pass.

    ``ids`` has ``n_ids`` rows; up to ``block_docs`` of them need no splitter and are not read.
    """
    blocks = min(ceil(n_ids / block_docs), MOST_BLOCKS)
    if blocks <= 1:
        return []
    shares = [i / blocks for i in range(1, blocks)]
    found = ids.agg(F.percentile_approx("doc_id", shares, ACCURACY * blocks).alias("at")).first().at
    return sorted(set(found or []))


def block_of(doc_id: Column, splitters: Sequence[int]) -> Column:
    """Number of ``splitters`` (ascending) that are not above ``doc_id``; found by halving, one short array for all rows."""
    if not splitters:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, splitters))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(splitters).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.try_element_at(bounds, at + step) <= doc_id, at + step).otherwise(at))
