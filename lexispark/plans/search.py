"""Search pipelines: a table of queries in, a table of ranked hits out.

Every pipeline takes ``queries(query_id, query)`` and returns (query_id, rank, doc_id,
score), with titles where they are attached. One pipeline is one lazy plan; only the size of
the query batch is looked at beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lexispark.operators import fusion, scoring
from lexispark.operators.matching import (
    document_partitions, inspect_batch, lookup_linked, lookup_postings, lookup_statistics)
from lexispark.operators.query_terms import (
    process_queries, re_process_queries, similar_terms, term_counts, weigh_query_terms)
from lexispark.operators.statistics import length_weight
from lexispark.settings import materialize
from lexispark.sources.index_store import InvertedIndex

HITS = ["query_id", "rank", "doc_id", "score"]
TITLED_HITS = ["query_id", "rank", "doc_id", "title", "score"]


@dataclass(frozen=True)
class Hits:
    """A lazy hit table with the proven bound of its size (queries × N)."""

    rows: DataFrame
    max_rows: int


@dataclass(frozen=True)
class SearchEngine:
    """The indexes and side tables a search reads; only those it uses need to be given."""

    body: InvertedIndex | None = None
    body_stemmed: InvertedIndex | None = None
    title: InvertedIndex | None = None
    title_stemmed: InvertedIndex | None = None
    anchor: InvertedIndex | None = None
    titles: DataFrame | None = None
    page_rank: DataFrame | None = None
    page_views: DataFrame | None = None
    word_vectors: DataFrame | None = None

    # ---- single sources -------------------------------------------------------------

    def search_body_tfidf(self, queries: DataFrame, stemming: bool = False, n: int = 100) -> DataFrame:
        return self._tfidf(queries, stemming, n).rows.select(*HITS)

    def search_body_bm25(self, queries: DataFrame, k1: float = 2.0, b: float = 0.75, stemming: bool = False,
                         n: int = 100, expand: bool = False, similar_words: int = 6,
                         similarity: float = 0.7, add_anchor: bool = False) -> DataFrame:
        index = self.body_stemmed if stemming else self.body
        return self._bm25(index, queries, k1, b, stemming, n, expand, similar_words,
                          similarity, add_anchor).rows.select(*HITS)

    def search_title_bm25(self, queries: DataFrame, k1: float = 2.0, b: float = 0.75, stemming: bool = False,
                          n: int = 100, expand: bool = False, similar_words: int = 6,
                          similarity: float = 0.7, add_anchor: bool = False) -> DataFrame:
        index = self.title_stemmed if stemming else self.title
        return self._bm25(index, queries, k1, b, stemming, n, expand, similar_words,
                          similarity, add_anchor).rows.select(*HITS)

    def search_body(self, queries: DataFrame, stemming: bool = False, n: int = 100, type: str = "tfidf",
                    **bm25) -> DataFrame:
        """TF-IDF cosine (default) or BM25 over the body, with titles."""
        if type == "tfidf":
            return self._titled(self._tfidf(queries, stemming, n))
        index = self.body_stemmed if stemming else self.body
        return self._titled(self._bm25(index, queries, stemming=stemming, n=n, **bm25))

    def search_title(self, queries: DataFrame, stemming: bool = False, n: int = 100, type: str = "binary",
                     **bm25) -> DataFrame:
        """Binary matching (default; all results, no stemming) or BM25 over the titles."""
        if type == "binary":
            return self.search_title_binary(queries)
        index = self.title_stemmed if stemming else self.title
        return self._titled(self._bm25(index, queries, stemming=stemming, n=n, **bm25))

    def search_title_binary(self, queries: DataFrame, distinct_terms: bool = False) -> DataFrame:
        return self._binary(self.title, queries, distinct_terms)

    def search_anchor(self, queries: DataFrame, distinct_terms: bool = False) -> DataFrame:
        """Binary matching of link texts; targets without a title are dropped."""
        return self._binary(self.anchor, queries, distinct_terms)

    def search_body_bm25_variants(self, queries: DataFrame, variants: Sequence[tuple[float, float, int, float]],
                                  stemming: bool = False, n: int = 100, expand: bool = False) -> DataFrame:
        """(variant, query_id, rank, doc_id, score): ``search_body_bm25`` for all ``variants`` in one plan.

        A variant is (k1, b, similar_words, similarity), numbered from 0; without ``expand`` only k1 and b
        matter. Neighbours are searched once, with the loosest of the settings, and the postings of all terms are
        read once; a term carries the settings that it belongs to.
        """
        index = self.body_stemmed if stemming else self.body
        tokens = process_queries(queries, stemming)
        settings = list(dict.fromkeys((words, near) if expand else () for _, _, words, near in variants))
        every = F.array(*[F.lit(i) for i in range(len(settings))])
        terms = tokens.select("query_id", "term", every.alias("term_sets"))
        if expand:
            offers = similar_terms(tokens, self.word_vectors, max(w for w, _ in settings), min(s for _, s in settings))
            within = F.array_compact(F.array(*[F.when((F.col("rank") <= w) & (F.col("similarity") > s), i)
                                               for i, (w, s) in enumerate(settings)]))
            added = tokens.join(offers, "term").select("query_id", F.col("similar").alias("term"), within.alias("term_sets"))
            terms = terms.unionByName(added)
        terms = terms.groupBy("query_id", "term").agg(
            F.array_distinct(F.flatten(F.collect_set("term_sets"))).alias("term_sets")).where(F.size("term_sets") > 0)
        if expand:
            # The neighbour search is the costly part; the size check must not repeat it.
            terms = materialize(terms)
        batch = inspect_batch(terms, index.n_buckets, index.n_postings)
        known = lookup_statistics(index, terms, batch)
        matches = lookup_postings(index, known, batch, document_partitions(known))
        asked = [(k1, b, settings.index((words, near) if expand else ())) for k1, b, words, near in variants]
        hits = scoring.bm25_scores(scoring.term_candidates(matches), index.n_docs, index.avgdl, asked, dealt=True)
        return fusion.top_n(hits, n, run=["variant"]).select("variant", *HITS)

    # ---- fused sources --------------------------------------------------------------

    def search_body_and_title_bm25(self, queries: DataFrame, stemming: bool = False, n: int = 100,
                                   w1: float = 0.5, w2: float = 0.5, merge_n: int = 20, **bm25) -> DataFrame:
        """BM25 of body and title, merged; at most ``merge_n`` rows per query."""
        body, title = self._body_and_title(queries, stemming, n, bm25, bm25)
        return self._merged(body, title, w1, w2, merge_n)

    def search_body_tfidf_and_title_bm25(self, queries: DataFrame, stemming: bool = False, n: int = 100,
                                         w1: float = 0.5, w2: float = 0.5, merge_n: int = 20,
                                         **bm25) -> DataFrame:
        """TF-IDF of the body and BM25 of the title, merged."""
        title = self._bm25(self.title_stemmed if stemming else self.title, queries,
                           stemming=stemming, n=n, **bm25)
        return self._merged(self._tfidf(queries, stemming, n), title, w1, w2, merge_n)

    def ultimate_search(self, queries: DataFrame, k_body: float = 1.5, b_body: float = 0.2,
                        k_title: float = 1.5, b_title: float = 0.2, stemming: bool = True,
                        add_anchor: bool = False, expand: bool = False, w_body: float = 0.8,
                        w_title: float = 0.8, w_page_rank: float = 0.5, w_page_views: float = 0.5,
                        n: int = 5, source_n: int = 100) -> DataFrame:
        """BM25 of body and title, page rank and page views, fused; best ``n`` with titles.

        ``add_anchor`` adds documents found by link text; off by default.
        """
        shared = {"expand": expand, "add_anchor": add_anchor}
        body, title = self._body_and_title(
            queries, stemming, source_n,
            {"k1": k_body, "b": b_body, **shared}, {"k1": k_title, "b": b_title, **shared})
        ids = fusion.union_candidates(body.rows, title.rows)
        max_ids = body.max_rows + title.max_rows
        ranks = fusion.page_rank_lookup(ids, self.page_rank, max_ids)
        views = fusion.page_views_lookup(ids, self.page_views, max_ids)
        merged = fusion.merge_all(
            body.rows, title.rows, ranks.withColumnRenamed("page_rank", "score"),
            views.withColumnRenamed("views", "score"), w_body, w_title, w_page_rank, w_page_views, n)
        return self._titled(Hits(merged, max_ids))

    # ---- signals of given documents -------------------------------------------------

    def page_rank_of(self, ids: DataFrame) -> DataFrame:
        """``ids(doc_id, …)`` with their page rank, 0 where unknown; a position column keeps the order."""
        return fusion.page_rank_lookup(ids, self.page_rank)

    def page_views_of(self, ids: DataFrame) -> DataFrame:
        """``ids(doc_id, …)`` with their page views, 0 where unknown."""
        return fusion.page_views_lookup(ids, self.page_views)

    # ---- shared steps ---------------------------------------------------------------

    def _titled(self, hits: Hits) -> DataFrame:
        return fusion.attach_titles(hits.rows, self.titles, hits.max_rows).select(*TITLED_HITS)

    def _merged(self, body: Hits, title: Hits, w1: float, w2: float, n: int) -> DataFrame:
        merged = fusion.merge_two(body.rows, title.rows, w1, w2, n)
        return self._titled(Hits(merged, body.max_rows + title.max_rows))

    def _body_and_title(self, queries: DataFrame, stemming: bool, n: int, body: dict, title: dict):
        indexes = (self.body_stemmed, self.title_stemmed) if stemming else (self.body, self.title)
        return [self._bm25(index, queries, stemming=stemming, n=n, **options)
                for index, options in zip(indexes, (body, title))]

    def _tfidf(self, queries: DataFrame, stemming: bool, n: int) -> Hits:
        index = self.body_stemmed if stemming else self.body
        counts = term_counts(re_process_queries(queries, stemming))
        batch = inspect_batch(counts, index.n_buckets, index.n_postings)
        known = weigh_query_terms(lookup_statistics(index, counts, batch), index.n_docs)
        matches = lookup_postings(index, known, batch)
        weighted = matches.withColumn("w_d", length_weight()).where(F.col("w_d").isNotNull())
        hits = scoring.cosine_similarity(weighted, index.norms)
        return Hits(fusion.top_n(hits, n), batch.n_queries * n)

    def _bm25(self, index: InvertedIndex, queries: DataFrame, k1: float = 2.0, b: float = 0.75,
              stemming: bool = False, n: int = 100, expand: bool = False, similar_words: int = 6,
              similarity: float = 0.7, add_anchor: bool = False) -> Hits:
        tokens = process_queries(queries, stemming, expand, similar_words, similarity, self.word_vectors)
        terms = tokens.select("query_id", "term").distinct()
        if expand:
            # The neighbour search is the costly part; the size check must not repeat it.
            terms = materialize(terms)
        batch = inspect_batch(terms, index.n_buckets, index.n_postings)
        known = lookup_statistics(index, terms, batch)
        if add_anchor:
            # Both kinds of postings move by document before they meet the queries; merged and summed up they stay where they are.
            partitions = document_partitions(known, lookup_statistics(self.anchor, terms, batch))
            linked = lookup_linked(self.anchor, known, batch, partitions)
            matches = lookup_postings(index, known, batch, partitions)
            candidates = scoring.term_candidates(matches, linked, index.lengths, dealt=True)
        else:
            candidates = scoring.term_candidates(lookup_postings(index, known, batch))
        hits = scoring.bm25_score(candidates, index.n_docs, index.avgdl, k1, b, dealt=add_anchor)
        return Hits(fusion.top_n(hits, n), batch.n_queries * n)

    def _binary(self, index: InvertedIndex, queries: DataFrame, distinct_terms: bool) -> DataFrame:
        terms = term_counts(re_process_queries(queries))
        batch = inspect_batch(terms, index.n_buckets, index.n_postings)
        known = lookup_statistics(index, terms, batch)
        partitions = document_partitions(known)
        hits = scoring.binary_ranking(lookup_postings(index, known, batch, partitions), distinct_terms, dealt=True)
        # Targets without a title leave the list before it is numbered; the title, which is long and the same in many lists, comes after.
        titles = fusion.number_titles(self.titles, partitions)
        listed = hits.join(titles.select("doc_id", "copy"), "doc_id")
        ranked = fusion.rank_all(listed, splitters=index.splitters(), ties=["copy"])
        return fusion.attach_titles(ranked, titles, keys=["doc_id", "copy"]).select(*TITLED_HITS)
