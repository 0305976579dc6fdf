"""Tables derived from the given ones, in the shapes the library reads.

Indexes are written tables in the shared work folder, built once per application and input
folder.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.operators.matching import match_terms
from lexispark.operators.postings import count_words, explode_anchors
from lexispark.operators.query_terms import re_process_queries, term_counts
from lexispark.operators.scoring import binary_ranking
from lexispark.operators.statistics import document_frequency
from lexispark.plans.build import build_anchor_index, build_index, repeated_ids
from lexispark.plans.search import SearchEngine
from lexispark.settings import work_dir
from lexispark.sources.index_store import InvertedIndex, merged_term_stats
from lexispark.sources.readers import count_page_views, read_corpus

COVERAGE = 0.5           # share of the query words a document needs to be labelled relevant
LINK = '<a href="[^"]*">([^<]*)</a>'

_written: dict[str, object] = {}


def path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Location of a written table that belongs to one application and input folder."""
    return f"{work_dir(spark)}/{md5(sf_dir.encode()).hexdigest()[:8]}/{name}"


def once(spark: SparkSession, sf_dir: str, name: str, write):
    """Run ``write(location)`` the first time and remember what it returns."""
    location = path(spark, sf_dir, name)
    if location not in _written:
        _written[location] = write(location)
    return _written[location]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_corpus(spark, f"{sf_dir}/documents.parquet", "text", "doc_id")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a document is its title."""
    return documents(spark, sf_dir).select("doc_id", F.substring_index("text", "\n", 1).alias("title"))


def title_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).withColumnRenamed("title", "text")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a nested link column; the target is computed from page and link position."""
    n_docs = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    texts = F.regexp_extract_all("html", F.lit(LINK), F.lit(1))
    links = F.transform(texts, lambda text, i: F.struct(
        F.pmod(F.col("page_id") * 7 + i, F.col("n_docs")).cast("bigint").alias("id"), text.alias("text")))
    pages = table(spark, sf_dir, "pages").withColumn("n_docs", n_docs)
    return pages.select(F.col("page_id").alias("doc_id"), links.alias("anchor_text"))


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_anchors(linked_pages(spark, sf_dir))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_page_views(table(spark, sf_dir, "events"), "user_id")


def page_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"), F.col("c_acctbal").alias("page_rank"))


def term_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, df) over all rows of the documents: those of the body index if it is built, so that texts are not counted again.

    The index holds one of the rows that share an id; all rows with such an id are counted here, and its own count is taken off.
    """
    docs = documents(spark, sf_dir)
    index = _written.get(path(spark, sf_dir, "body_False"))
    if index is None:
        return document_frequency(count_words(docs))
    stats = merged_term_stats(index).select("term", "df")
    few = repeated_ids(docs.where(F.col("doc_id").isNotNull()))  # rows without an id are all in the index
    if few is None:
        return stats
    every = document_frequency(count_words(docs.join(few, "doc_id", "left_semi")))
    indexed = document_frequency(index.postings.join(few, "doc_id", "left_semi")).withColumn("df", -F.col("df"))
    return stats.unionByName(every).unionByName(indexed).groupBy("term").agg(F.sum("df").alias("df"))


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector gets the most frequent of the terms whose hash falls on its id."""
    vectors = table(spark, sf_dir, "embeddings")
    n = vectors.agg(F.count("*")).scalar()
    hashed = F.conv(F.substring(F.md5("term"), 1, 10), 16, 10).cast("bigint")
    frequencies = term_frequencies(spark, sf_dir)
    named = frequencies.groupBy(F.pmod(hashed, n).alias("vec_id")).agg(
        F.max(F.struct("df", "term")).getField("term").alias("term"))
    return named.join(vectors, "vec_id").select("term", F.col("embedding").alias("vec"))


def body_index(spark: SparkSession, sf_dir: str, stemming: bool = False) -> InvertedIndex:
    return once(spark, sf_dir, f"body_{stemming}", lambda root: build_index(
        documents(spark, sf_dir), root, stemming))


def title_index(spark: SparkSession, sf_dir: str, stemming: bool = False) -> InvertedIndex:
    return once(spark, sf_dir, f"title_{stemming}", lambda root: build_index(
        title_documents(spark, sf_dir), root, stemming))


def anchor_index(spark: SparkSession, sf_dir: str) -> InvertedIndex:
    return once(spark, sf_dir, "anchor", lambda root: build_anchor_index(anchors(spark, sf_dir), root))


def engine(spark: SparkSession, sf_dir: str, *parts: str) -> SearchEngine:
    """A search engine with the named parts."""
    make = {
        "body": lambda: body_index(spark, sf_dir),
        "body_stemmed": lambda: body_index(spark, sf_dir, True),
        "title": lambda: title_index(spark, sf_dir),
        "title_stemmed": lambda: title_index(spark, sf_dir, True),
        "anchor": lambda: anchor_index(spark, sf_dir),
        "titles": lambda: stored_table(spark, sf_dir, "titles", lambda: titles(spark, sf_dir)),
        "page_rank": lambda: page_rank(spark, sf_dir),
        "page_views": lambda: stored_table(spark, sf_dir, "page_views", lambda: page_views(spark, sf_dir)),
        "word_vectors": lambda: stored_word_vectors(spark, sf_dir),
    }
    return SearchEngine(**{part: make[part]() for part in parts})


def stored_table(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """Write ``make()`` the first time, then read the written table."""
    def write(location: str) -> str:
        make().write.mode("overwrite").parquet(location)
        return location
    return spark.read.parquet(once(spark, sf_dir, f"table_{name}", write))


def stored_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(spark, sf_dir, "word_vectors", lambda: word_vectors(spark, sf_dir))


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(spark, sf_dir, "qrels", lambda: make_qrels(spark, sf_dir))


def make_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id): documents having at least half of the distinct query words."""
    terms = term_counts(re_process_queries(queries(spark, sf_dir)))
    words = terms.groupBy("query_id").agg(F.count("*").alias("n_words"))
    matches = match_terms(body_index(spark, sf_dir), terms, by_document=True)
    found = binary_ranking(matches, distinct_terms=True, dealt=True).withColumnRenamed("score", "n_found")
    return found.join(words, "query_id").where(
        F.col("n_found") >= COVERAGE * F.col("n_words")).select("query_id", "doc_id")
