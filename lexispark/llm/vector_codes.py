"""Vector code compression: product codes by slice-and-intersect search in bitmasks (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexispark.settings import small_enough

from .tables import stored
from .vectors import integer_vectors, slices

#: Parts of a vector, entries of a codebook, rounds of fitting, and steps of a component's unit.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers stay below this, so that squared distances of 2^9 components are exact in 64 bits.
_LARGEST = 1 << 26
#: Slices of a label where the sums by label are too many to be broadcast.
_SALTS = 64


@dataclass
class Slices:
    """One codebook, cut by coordinate: per dimension the sorted coordinates, and for each place the mask of all entries before it.

    Masks are words of 64 entries. The entries with a coordinate in a range are the mask at its
    end without the mask at its start; those inside a box are the AND over all dimensions.
    """

    entries: np.ndarray      # entry, dimension
    sorted: np.ndarray       # dimension, place
    order: np.ndarray        # dimension, place -> entry
    prefix: np.ndarray       # dimension, place, word

    @classmethod
    def of(cls, entries: np.ndarray) -> Slices:
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T.reshape(width, n)
        prefix = np.zeros((width, n + 1, -(-n // 64)), np.uint64)
        for d in range(width):
            for place, entry in enumerate(order[d].tolist()):
                prefix[d, place + 1] = prefix[d, place]
                prefix[d, place + 1, entry // 64] |= np.uint64(1 << (entry % 64))
        return cls(entries, np.sort(entries, axis=0).T.reshape(width, n), order, prefix)

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ from a point by at most its radius in every dimension."""
        n = len(self.entries)
        full = np.array([(1 << min(64, n - 64 * w)) - 1 for w in range(self.prefix.shape[2])], np.uint64)
        mask = np.repeat(full[None, :], len(points), axis=0)
        for d in range(self.entries.shape[1]):
            start = np.searchsorted(self.sorted[d], points[:, d] - radius, side="left")
            end = np.searchsorted(self.sorted[d], points[:, d] + radius, side="right")
            mask &= self.prefix[d, end] & ~self.prefix[d, start]
        return mask

    def first_guess(self, points: np.ndarray) -> np.ndarray:
        """An entry for each point: the nearest one along the dimension in which the codebook is widest."""
        n, width = self.entries.shape
        if not width:
            return np.zeros(len(points), np.int64)
        d = int(np.argmax(self.sorted[:, -1] - self.sorted[:, 0]))
        right = np.clip(np.searchsorted(self.sorted[d], points[:, d]), 0, n - 1)
        left = np.maximum(right - 1, 0)
        nearer = np.abs(points[:, d] - self.sorted[d, left]) <= np.abs(points[:, d] - self.sorted[d, right])
        return self.order[d, np.where(nearer, left, right)]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, ties to the lower one, and its squared distance.

        The distance to a guessed entry is the initial radius. Whatever is as near lies in the box
        of that radius, so the candidates hold the nearest entry and all its ties.
        """
        far = squared(points, self.entries[self.first_guess(points)])
        mask = self.candidates(points, whole_root(far))
        best, least = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        for entry in range(len(self.entries)):
            rows = np.flatnonzero(mask[:, entry // 64] & np.uint64(1 << (entry % 64)))
            distance = squared(points[rows], self.entries[entry])
            nearer = distance < least[rows]
            best[rows[nearer]], least[rows[nearer]] = entry, distance[nearer]
        return best, least


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(1)


def whole_root(values: np.ndarray) -> np.ndarray:
    """Largest integers whose squares do not exceed ``values``."""
    root = np.sqrt(values.astype(np.float64)).astype(np.int64)
    root -= root * root > values
    return root + ((root + 1) * (root + 1) <= values)


def _assigned(books: list[Slices], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each part of each vector, and the squared distances summed over parts."""
    width = x.shape[1] // len(books)
    found = [book.nearest(x[:, p * width:(p + 1) * width]) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)


def _sums(books: list[Slices], width: int):
    """Per task one row for each component of each entry that was met: how many parts it has, and their sum."""
    schema = ["part", "entry", "dim", "n", "total"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, n_entries, part_width = len(books), len(books[0].entries), width // len(books)
        count = np.zeros((n_parts, n_entries), np.int64)
        total = np.zeros((n_parts, n_entries, part_width), np.int64)
        for _, x in slices(batches, width):
            codes, _ = _assigned(books, x)
            for p in range(n_parts):
                count[p] += np.bincount(codes[:, p], minlength=n_entries)
                np.add.at(total[p], codes[:, p], x[:, p * part_width:(p + 1) * part_width])
        part, entry, dim = np.nonzero(np.broadcast_to(count[:, :, None] > 0, total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(dim.astype(np.int32)),
             pa.array(count[part, entry]), pa.array(total[part, entry, dim])], names=schema)
    return add


def fitted(rows: DataFrame, width: int, entries: int, rounds: int, parts: int) -> np.ndarray:
    """Codebooks (part, entry, component) of stored vectors ``rows(vec_id, x)``; the driver sees their sums alone."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = rows.select("x").mapInArrow(_sums([Slices.of(b) for b in books], width),
                                           "part int, entry int, dim int, n bigint, total bigint")
        for r in sums.groupBy("part", "entry", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r["part"], r["entry"], r["dim"]] = r["total"] // r["n"]
    return books


def digest(books: np.ndarray) -> str:
    """Lowercase hex of all components by part, entry and place, joined by commas."""
    return sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _coded(books: np.ndarray, width: int):
    """(vec_id, label, entry_ids, error) of every vector."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = [Slices.of(b) for b in books]
        for piece, x in slices(batches, width):
            codes, error = _assigned(cut, x)
            ids = pa.FixedSizeListArray.from_arrays(pa.array(codes.astype(np.int32).reshape(-1)), len(cut))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), ids.cast(pa.list_(pa.int32())),
                                              pa.array(error)], names=["vec_id", "label", "entry_ids", "error"])
    return code


def encoded(embeddings: DataFrame, vector: str = "embedding", label: str = "label", entries: int = ENTRIES,
            rounds: int = ROUNDS, parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Product codes: (vec_id, label, entry_ids array<int>, error bigint) of every finite vector, and the codebooks.

    Components become integers floor(scale * x); a vector is cut into ``parts`` equal parts, each coded by
    the nearest of ``entries`` entries of its position's codebook. A codebook starts as the parts of
    the smallest vec_ids and is fitted by ``rounds`` rounds over all vectors. ``error`` is the squared
    distance to the entries. The nearest entry is found in the masks of ``Slices``, with integers
    throughout, so equal tables have equal results however they are partitioned.

    A round is one pass over the stored integers; tasks send one row per component of a codebook.

    Defined cases: vectors that are null or hold null or non-finite components are dropped; shorter vectors
    count as filled up with zeros; repeated rows each count; null ids come after all others; fewer vectors than
    entries make shorter codebooks; an empty table gives no row and an empty codebook; other columns
    are ignored; components of 2^26 / scale and more in size raise ValueError.
    """
    rows, width = integer_vectors(embeddings, vector, scale, 0, parts, _LARGEST,
                                  vec_id=F.col("vec_id").cast("bigint"), label=F.col(label))
    books = fitted(rows, width, entries, rounds, parts)
    schema = f"vec_id bigint, label {rows.schema['label'].dataType.simpleString()}, entry_ids array<int>, error bigint"
    return rows.mapInArrow(_coded(books, width), schema), books


def with_group_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels; null labels are one.

    Sums of a proven small number of labels are broadcast. Otherwise every label is cut into slices, so
    that a label with a third of all rows is no single task.
    """
    codes = stored(codes)
    sums = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    same = F.col("label").eqNullSafe(F.col("__label"))
    if small_enough(sums):
        joined = codes.join(F.broadcast(sums), same)
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__salt")
        own = codes.withColumn("__slice", F.pmod(F.xxhash64("vec_id", "entry_ids"), F.lit(_SALTS)).cast("int"))
        joined = own.join(sums.select("*", salt), same & (F.col("__slice") == F.col("__salt")))
    return joined.select(*codes.columns, "label_error")


def hex_code(entry_ids: Column) -> Column:
    """Two lowercase hex digits for each entry id."""
    return F.concat_ws("", F.transform(entry_ids, lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))))


def codes_sql(entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS, scale: int = SCALE) -> str:
    """DuckDB SQL of op12: every round as two steps of one chain. For vectors of one length, a multiple of ``parts``."""
    assign = """assigned{r} AS MATERIALIZED (
  SELECT p.id, p.part, min(struct_pack(d := list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := b.entry)) AS best
  FROM parts p JOIN books{r} b ON p.part = b.part GROUP BY p.id, p.part)"""
    update = """sums{r} AS (
  SELECT part, entry, dim, sum(x)::BIGINT AS total, count(*) AS n FROM (
    SELECT p.part, a.best.e AS entry, unnest(p.v) AS x, unnest(range(1, len(p.v) + 1)) AS dim
    FROM parts p JOIN assigned{r} a ON p.id = a.id AND p.part = a.part) GROUP BY ALL),
means{r} AS (
  SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY dim) AS v FROM sums{r} GROUP BY part, entry),
books{s} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM books{r} b LEFT JOIN means{r} m ON b.part = m.part AND b.entry = m.entry)"""
    steps = [step.format(r=r, s=r + 1) for r in range(rounds) for step in (assign, update)]
    chain = ",\n".join([*steps, assign.format(r=rounds)])
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT id, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS v
  FROM (SELECT id, v, unnest(range({parts})) AS part FROM kept)),
books0 AS (SELECT part, id - 1 AS entry, v FROM parts WHERE id <= {entries}),
{chain},
errors AS (
  SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM assigned{rounds} GROUP BY id),
digest AS (
  SELECT sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN errors USING (id) CROSS JOIN digest"""
