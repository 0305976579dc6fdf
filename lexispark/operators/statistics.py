"""Term, document and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexispark.functions.text import word_count
from lexispark.operators.skew import join_term_stats

LOGARITHMS = {"e": F.ln, "10": F.log10}


def document_frequency(postings: DataFrame) -> DataFrame:
    """Number of postings per term."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def term_total(postings: DataFrame) -> DataFrame:
    """Number of occurrences per term."""
    return postings.groupBy("term").agg(F.sum("tf").cast("bigint").alias("term_total"))


def idf(n_docs: Column | int, df: Column | str, base: str = "e") -> Column:
    """``log(n_docs / df)`` to base ``e`` or ``10``."""
    n_docs = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    df = F.col(df) if isinstance(df, str) else df
    return LOGARITHMS[base](n_docs / df)


def inverse_document_frequency(frequencies: DataFrame, n_docs: Column | int, base: str = "e") -> DataFrame:
    """``frequencies(term, df)`` with ``idf`` added."""
    return frequencies.withColumn("idf", idf(n_docs, "df", base))


def term_statistics(postings: DataFrame, n_docs: Column | int, base: str = "e") -> DataFrame:
    """(term, df, term_total, idf) in one aggregation pass."""
    stats = postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").cast("bigint").alias("term_total"))
    return inverse_document_frequency(stats, n_docs, base)


def tfidf_postings(postings: DataFrame, term_stats: DataFrame, n_postings: int | None = None) -> DataFrame:
    """``tf * idf`` per posting, no length normalisation."""
    joined = join_term_stats(postings, term_stats.select("term", "df", "idf"), n_postings)
    return joined.select("term", "doc_id", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def doc_lengths(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, dl); documents without word tokens keep a length of 0."""
    return docs.select("doc_id", word_count(text).alias("dl"))


def corpus_statistics(lengths: DataFrame) -> DataFrame:
    """One row: number of documents and mean length."""
    return lengths.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))


def length_weight() -> Column:
    """``tf / dl * idf``; null for a document of length 0."""
    return F.try_divide(F.col("tf"), F.col("dl")) * F.col("idf")


def doc_norms(postings: DataFrame, term_stats: DataFrame, n_postings: int | None = None) -> DataFrame:
    """Euclidean norm of the length-normalised TF-IDF weights of each document.

    ``postings`` carries ``dl``, so no document table has to be joined.
    """
    joined = join_term_stats(postings, term_stats.select("term", "df", "idf"), n_postings)
    weights = joined.select("doc_id", length_weight().alias("w")).where(F.col("w").isNotNull())
    return weights.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
