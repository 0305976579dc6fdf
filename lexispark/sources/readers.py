"""Readers of the corpus, its side tables and relevance labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark import schemas


def spread(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Deal a freshly read table to all cores when its files give fewer tasks than cores.

    One row group is one task; a large corpus has far more row groups than cores and is left
    as it is.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores, key) if docs.rdd.getNumPartitions() < cores else docs


def read_corpus(spark: SparkSession, paths: str | Sequence[str], field: str = "text",
                doc_id: str = "id") -> DataFrame:
    """(doc_id, field) of one or several Parquet paths; other columns are not read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spread(spark.read.parquet(*paths).select(F.col(doc_id).alias("doc_id"), field))


def count_documents(corpus: DataFrame) -> DataFrame:
    """One row with the corpus size."""
    return corpus.agg(F.count("*").alias("n_docs"))


def read_corpus_sample(spark: SparkSession, paths: str | Sequence[str], field: str = "text",
                       doc_id: str = "id", n: int = 1000) -> DataFrame:
    """The first ``n`` documents by id."""
    return read_corpus(spark, paths, field, doc_id).orderBy("doc_id").limit(n)


def read_page_rank(spark: SparkSession, path: str) -> DataFrame:
    """Headerless, optionally gzipped CSV of (doc_id, page_rank)."""
    return spark.read.schema(schemas.PAGE_RANK).csv(path)


def read_page_views(spark: SparkSession, path: str, doc_id: str = "doc_id", views: str = "views") -> DataFrame:
    """(doc_id, views) from a Parquet table of totals."""
    return spark.read.parquet(path).select(F.col(doc_id).alias("doc_id"), F.col(views).cast("bigint").alias("views"))


def count_page_views(log: DataFrame, doc_id: str) -> DataFrame:
    """(doc_id, views) from a log with one row per view."""
    return log.groupBy(F.col(doc_id).alias("doc_id")).agg(F.count("*").alias("views"))


def read_titles(spark: SparkSession, paths: str | Sequence[str], title: str = "title",
                doc_id: str = "id") -> DataFrame:
    """(doc_id, title) of a corpus."""
    return read_corpus(spark, paths, title, doc_id).withColumnRenamed(title, "title")


def read_qrels(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """(query, pos, doc_id) from JSON objects ``{query: [doc ids]}``.

    One object per line, so a large label set is many lines and is read in parallel;
    ``multiline`` is for a single pretty-printed object per file.
    """
    objects = spark.read.text(path, wholetext=multiline).select(
        F.from_json("value", schemas.QRELS_OBJECT).alias("labels"))
    labelled = objects.select(F.explode("labels").alias("query", "doc_ids"))
    return labelled.select("query", F.posexplode("doc_ids").alias("pos", "doc_id"))
