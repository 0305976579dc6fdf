"""Query tables to query terms, query weights and query expansion.

Queries are ``(query_id, query)``; query terms are ``(query_id, pos, term)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexispark.functions.stemming import stem_word
from lexispark.functions.text import regex_tokens, word_tokens
from lexispark.operators.similarity import most_similar
from lexispark.settings import broadcast_if_small

EPSILON = 0.0000001      # fixed value: smoothing of the query idf


def drop_empty_queries(queries: DataFrame) -> DataFrame:
    """An empty query has an empty result."""
    return queries.where(F.length("query") > 0)


def _positions(queries: DataFrame, tokens: Column, stemming: bool) -> DataFrame:
    terms = drop_empty_queries(queries).select("query_id", F.posexplode(tokens).alias("pos", "term"))
    return terms.withColumn("term", stem_word("term")) if stemming else terms


def process_queries(queries: DataFrame, stemming: bool = False, expand: bool = False,
                    similar_words: int = 6, similarity: float = 0.7,
                    word_vectors: DataFrame | None = None) -> DataFrame:
    """Word tokens, optionally stemmed, then optionally followed by similar words."""
    terms = _positions(queries, word_tokens("query"), stemming)
    if not expand:
        return terms
    if word_vectors is None:
        raise ValueError("expand=True needs word_vectors(term, vec)")
    similar = expand_query(terms, word_vectors, similar_words, similarity)
    last = terms.groupBy("query_id").agg(F.max("pos").alias("last"))
    added = similar.join(last, "query_id").select(
        "query_id", (F.col("last") + F.col("pos")).cast("int").alias("pos"), "term")
    return terms.unionByName(added)


def re_process_queries(queries: DataFrame, stemming: bool = False) -> DataFrame:
    """Pattern tokens, optionally stemmed."""
    return _positions(queries, regex_tokens("query"), stemming)


def term_counts(terms: DataFrame) -> DataFrame:
    """Distinct terms per query: (query_id, term, qtf, length = all tokens of the query)."""
    counts = terms.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))
    return counts.withColumn("length", F.sum("qtf").over(Window.partitionBy("query_id")))


def weigh_query_terms(known: DataFrame, n_docs: Column | int) -> DataFrame:
    """Add ``w_q = qtf / length * log10(n_docs / (df + epsilon))`` and the query norm.

    ``known`` are term counts joined with ``df``; the length counts duplicates and unknown
    words, while terms outside the index have no weight.
    """
    n_docs = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    weight = F.col("qtf") / F.col("length") * F.log10(n_docs / (F.col("df") + EPSILON))
    squares = F.sum(F.col("w_q") * F.col("w_q")).over(Window.partitionBy("query_id"))
    return known.withColumn("w_q", weight).withColumn("query_norm", F.sqrt(squares))


def query_tfidf(terms: DataFrame, term_stats: DataFrame, n_docs: Column | int) -> DataFrame:
    """(query_id, term, w_q) of the query terms that occur in the index."""
    known = term_stats.select("term", "df").join(term_counts(terms), "term")
    return weigh_query_terms(known, n_docs).select("query_id", "term", "w_q")


def similar_terms(terms: DataFrame, word_vectors: DataFrame, similar_words: int = 6,
                  similarity: float = 0.7) -> DataFrame:
    """(term, rank, similarity, similar) of the distinct ``term``: the words a token brings, nearest first.

    Only the ``similar_words`` nearest vectors with a cosine above ``similarity`` count;
    each is tokenised and its first word token kept. Tokens without a vector have no row.
    """
    vectors = word_vectors.select(F.col("term").alias("id"), "vec")
    wanted = terms.select(F.col("term").alias("id")).distinct()
    known = vectors.join(broadcast_if_small(wanted), "id")
    near = most_similar(known, vectors, similar_words).where(F.col("similarity") > similarity)
    words = near.select(F.col("query").alias("term"), "rank", "similarity",
                        F.try_element_at(word_tokens("id"), F.lit(1)).alias("similar"))
    return words.where(F.col("similar").isNotNull())


def expand_query(terms: DataFrame, word_vectors: DataFrame,
                 similar_words: int = 6, similarity: float = 0.7) -> DataFrame:
    """The similar words of :func:`similar_terms` per token, in token order then by similarity, ``pos`` from 1."""
    # Every token occurrence brings its own copy of the similar words.
    words = similar_terms(terms, word_vectors, similar_words, similarity)
    order = Window.partitionBy("query_id").orderBy("token_pos", "rank")
    return (terms.withColumnRenamed("pos", "token_pos").join(words, "term")
            .select("query_id", F.row_number().over(order).alias("pos"), F.col("similar").alias("term")))
