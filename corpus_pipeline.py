"""From raw documents to a mix for training: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.llm import decontaminate, language_id, mixing, parity_join, suffix_dedup
from lexispark.llm.tables import row_key, stored

#: Characters of a benchmark passage that rejects a document: suffix dedup may have cut 200 bytes and more of an item before.
LEAK_CHARS = 100

#: SQL cannot express the classifier of the first stage; ``tests/llm`` has a brute-force version.
ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of ``docs`` (see ``language_id.recognised``); a missing ``lang`` becomes the one found.

    Without a labelled text there is nothing to learn from, and all documents with a letter stay.
    """
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = docs.withColumn("__found", language_id.recognised(F.col("text"), model))
    kept = found.where("__found.clear")
    return kept.withColumn("lang", F.coalesce("lang", "__found.lang")).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that share id and text one stays, different texts under one id all stay; rows without an id are in no group.
    """
    first = parity_join.similar_documents(docs).where("doc_id = component_id").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("__rows"))
    kept = docs.join(stored(first), "doc_id")
    return (kept.where(F.col("__rows") == 1)
            .unionByName(kept.where(F.col("__rows") > 1).dropDuplicates(["doc_id", "text"])).select(*docs.columns)
            .unionByName(docs.where(F.col("doc_id").isNull())))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without byte strings that occur twice."""
    return suffix_dedup.without_repeats(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark and no passage of LEAK_CHARS characters."""
    leaks = decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), LEAK_CHARS)
    return docs.withColumn("__rid", row_key()).join(
        leaks.select(F.col("rid").alias("__rid")).distinct(), "__rid", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken (see ``mixing.mixed``)."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify), ("jaccard_join", deduplicate), ("suffix_dedup", remove_repeats),
    ("decontamination", remove_leaks), ("mixing", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
