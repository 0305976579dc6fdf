"""Integer vectors of a table of embeddings, shared by the operators that count exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tables import stored

#: Values of a matrix that a task holds at once.
SLICE_VALUES = 1 << 20


def finite(vector: Column) -> Column:
    """True for vectors that are there and hold only finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def integer_vectors(embeddings: DataFrame, vector: str, scale: int, shift: int, multiple: int, largest: int,
                    **others: Column) -> tuple[DataFrame, int]:
    """Stored (others…, x array<bigint>) of the finite vectors, x = floor(scale * component) + shift, and their length.

    Vectors shorter than the longest count as filled up with zeros, and so does the longest up to a
    multiple of ``multiple``: all rows take part. A component of which floor(scale * component) is
    ``largest`` or more in size would not leave room for exact sums; such a table is refused.
    """
    whole = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale))
    good = embeddings.where(finite(F.col(vector)))
    length, size = good.agg(
        F.coalesce(F.max(F.size(vector)), F.lit(0)),
        F.coalesce(F.max(F.array_max(F.transform(F.col(vector), lambda c: F.abs(c.cast("double"))))), F.lit(0.0))).first()
    if size * scale >= largest:
        raise ValueError(f"a component of size {size} is too large for exact integers of scale {scale}")
    width = -(-length // multiple) * multiple
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(vector)))
    return stored(good.select(*[c.alias(name) for name, c in others.items()],
                              F.transform(filled, lambda v: v + F.lit(shift)).alias("x"))), width


def slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with a list column ``x`` cut to bounded pieces, and x of each as a matrix."""
    step = max(1, SLICE_VALUES // max(width, 1))
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            piece = batch.slice(first, step)
            values = piece.column(piece.schema.names.index("x")).flatten().to_numpy(zero_copy_only=False)
            yield piece, values.reshape(piece.num_rows, width)
