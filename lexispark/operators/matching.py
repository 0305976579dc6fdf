"""Query terms against a stored index.

A batch of up to LITERAL_TERMS distinct terms, few for the size of the index, is turned into filters: groups of terms that are next to
each other in the order of the files, each read by a scan of its own with the buckets and the terms as
literals. Buckets prune folders and terms skip pages, also where a batch touches every bucket.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from lexispark.operators.postings import term_bucket
from lexispark.operators.skew import join_terms
from lexispark.settings import BROADCAST_BYTES, BROADCAST_ROWS, PUSHED_LITERALS, materialize
from lexispark.sources.index_store import InvertedIndex

# Distinct terms of a batch that become literals of its plan, and the bytes they may take.
LITERAL_TERMS, LITERAL_BYTES = 4096, 1 << 20
# Postings of an index for each literal: in a smaller index a scan costs less than so many filters. The rows are the same.
POSTINGS_PER_LITERAL = 20_000
# Matches of a partition that holds whole documents.
PARTITION_MATCHES = 1_000_000


@dataclass(frozen=True)
class Batch:
    """What one bounded look at a table of query terms tells about its size."""

    n_queries: int
    small: bool
    n_buckets: int
    buckets: tuple[int, ...]
    terms: tuple[tuple[int, str], ...] | None = None    # (bucket, term), sorted; None: too many

    def in_buckets(self, n_buckets: int) -> Column:
        """Literal partition filter; none when every bucket is needed or they are cut differently."""
        if len(self.buckets) >= n_buckets or n_buckets != self.n_buckets:
            return F.lit(True)
        return F.col("bucket").isin(list(self.buckets))

    def rows_of(self, table: DataFrame, n_buckets: int) -> DataFrame:
        """The rows of ``table(bucket, term, …)`` that the terms of the batch need, and few others."""
        if self.terms is None or n_buckets != self.n_buckets:
            return table.where(self.in_buckets(n_buckets)).drop("bucket")
        groups = [self.terms[i:i + PUSHED_LITERALS] for i in range(0, len(self.terms), PUSHED_LITERALS)]
        scans = [table.where(F.col("bucket").isin(sorted({b for b, _ in group})) & F.expr(f"term IN ({_literals(group)})"))
                 for group in groups]
        return (reduce(DataFrame.unionByName, scans) if scans else table.where(F.lit(False))).drop("bucket")


def _literals(group: tuple[tuple[int, str], ...]) -> str:
    """The terms of a group as SQL: one expression, not a call for each literal."""
    return ", ".join("'" + term.replace("\\", "\\\\").replace("'", "\\'") + "'" for _, term in group)


def inspect_batch(terms: DataFrame, n_buckets: int, n_postings: int | None = None) -> Batch:
    """Rows, bytes, touched buckets and, if they are few for ``n_postings``, distinct terms of ``terms(query_id, term)``."""
    most = LITERAL_TERMS if n_postings is None else min(LITERAL_TERMS, n_postings // POSTINGS_PER_LITERAL)
    row = terms.agg(
        F.count("*").alias("rows"), F.count_distinct("query_id").alias("queries"),
        F.approx_count_distinct("term").alias("terms"),
        F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0)).alias("bytes"),
        F.array_sort(F.collect_set(term_bucket("term", n_buckets))).alias("buckets")).first()
    small = row.rows <= BROADCAST_ROWS and row.bytes <= BROADCAST_BYTES
    known = None
    if small and row.terms <= 2 * most:
        found = terms.where("term is not null").select(term_bucket("term", n_buckets).alias("bucket"), "term").distinct().limit(
            most + 1).collect()
        if len(found) <= most and sum(len(r.term) for r in found) <= LITERAL_BYTES:
            known = tuple(sorted((r.bucket, r.term) for r in found))
    return Batch(row.queries, small, n_buckets, tuple(row.buckets), known)


def lookup_statistics(index: InvertedIndex, terms: DataFrame, batch: Batch) -> DataFrame:
    """``terms`` found in the index with df, term_total and idf."""
    stats = batch.rows_of(index.term_stats, index.n_buckets)
    return stats.join(F.broadcast(terms) if batch.small else terms, "term")


def document_partitions(*known_terms: DataFrame) -> int:
    """Partitions by document so that one holds about PARTITION_MATCHES matches of ``known_terms(df)``, whatever their size on disk."""
    counts = [known.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first().n for known in known_terms]
    return max(ceil(sum(counts) / PARTITION_MATCHES), known_terms[0].sparkSession.sparkContext.defaultParallelism)


def lookup_postings(index: InvertedIndex, known_terms: DataFrame, batch: Batch, partitions: int | None = None) -> DataFrame:
    """Postings of ``known_terms`` (which carry ``df``), with all columns of both.

    A small batch is broadcast, so the pruned postings are read in place. A larger one is
    joined by term with the hot terms cut into slices. With ``partitions`` the rows come dealt by document into so many; the
    postings of a small batch move before they meet its queries: once, not once for each query that has the term.
    """
    postings = batch.rows_of(index.postings, index.n_buckets)
    if batch.small:
        if partitions:
            # Looked up once for both joins; Spark would read the postings again to filter the statistics by them.
            known_terms = materialize(known_terms)
            wanted = F.broadcast(known_terms.select("term"))
            postings = postings.join(wanted, "term", "left_semi").repartition(partitions, "doc_id")
        return postings.join(F.broadcast(known_terms), "term")
    matches = join_terms(postings, known_terms, index.n_postings)
    return matches.repartition(partitions, "doc_id") if partitions else matches


def lookup_linked(index: InvertedIndex, known_terms: DataFrame, batch: Batch, partitions: int | None = None) -> DataFrame:
    """Postings of terms whose ``df`` is that of another index; hot terms are cut by their list in this one."""
    if batch.small:
        return lookup_postings(index, known_terms, batch, partitions)
    lengths = batch.rows_of(index.term_stats, index.n_buckets).select("term", F.col("df").alias("list_df"))
    postings = batch.rows_of(index.postings, index.n_buckets)
    matches = join_terms(postings, known_terms.join(lengths, "term"), index.n_postings, "list_df").drop("list_df")
    return matches.repartition(partitions, "doc_id") if partitions else matches


def match_terms(index: InvertedIndex, terms: DataFrame, batch: Batch | None = None, by_document: bool = False) -> DataFrame:
    """Postings of the query terms that occur in the index, statistics attached; ``by_document`` deals them (see ``lookup_postings``)."""
    batch = batch or inspect_batch(terms, index.n_buckets, index.n_postings)
    known = lookup_statistics(index, terms, batch)
    return lookup_postings(index, known, batch, document_partitions(known) if by_document else None)
