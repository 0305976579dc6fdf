"""Index building: documents to a stored generation of index tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.functions.stemming import stem_tokens
from lexispark.functions.text import regex_tokens, word_count
from lexispark.operators.postings import N_BUCKETS, anchor_postings, count_tokens
from lexispark.settings import broadcast_if_small, materialize, released_shuffles, small_enough
from lexispark.sources.index_store import (
    Commit, InvertedIndex, merged_term_stats, next_generation, read_index, read_table, with_norms, write_commit,
    write_doc_stats, write_postings, write_term_stats)


def tokenize_documents(docs: DataFrame, stemming: bool = False) -> DataFrame:
    """(doc_id, dl, tokens) of ``docs(doc_id, text)``; row by row, no shuffle."""
    tokens = regex_tokens("text")
    return docs.select("doc_id", word_count("text").alias("dl"),
                       (stem_tokens(tokens) if stemming else tokens).alias("tokens"))


def build_index(docs: DataFrame, root: str, stemming: bool = False,
                n_buckets: int = N_BUCKETS, idf_base: str = "e") -> InvertedIndex:
    """Write a new index over ``docs(doc_id, text)`` to ``root`` and open it.

    Below ``root`` it is the next free generation and the first of its own: an index that was
    there before is not touched, and stays the visible one until this is complete. Of rows that
    share a doc_id one is indexed (see ``one_per_id``).
    """
    return publish_tokens(docs.sparkSession, root, _tokens_of(docs, stemming), None, stemming, n_buckets, idf_base)


def add_documents(docs: DataFrame, root: str, refresh: bool = False) -> InvertedIndex:
    """Add ``docs(doc_id, text)`` to a stored index; ids already indexed are skipped.

    Reads no old postings, unless ``refresh`` asks for new norms at once (see ``refresh_norms``).
    """
    spark = docs.sparkSession
    index = read_index(spark, root)
    return publish_tokens(spark, root, _tokens_of(not_indexed(docs, index), index.stemming), index, refresh=refresh)


def _tokens_of(docs: DataFrame, stemming: bool) -> DataFrame:
    """``one_per_id`` of the tokenised ``docs``; rows that are equal are tokenised once."""
    few = repeated_ids(docs)
    if few is None:
        return tokenize_documents(docs, stemming)
    # Their texts move once, by id: equal rows meet, and so do the tokens of the rows that are left.
    several = docs.join(few, "doc_id", "left_semi").repartition("doc_id").dropDuplicates(["doc_id", "text"])
    single = docs.join(few, "doc_id", "left_anti")
    return tokenize_documents(single, stemming).unionByName(_best_per_id(tokenize_documents(several, stemming)))


def one_per_id(tokens: DataFrame) -> DataFrame:
    """One row per doc_id of tokenised documents: that with most words, of several the last by its words.

    Only the ids are counted; rows whose id occurs once are not shuffled.
    """
    few = repeated_ids(tokens)
    if few is None:
        return tokens
    return tokens.join(few, "doc_id", "left_anti").unionByName(_best_per_id(tokens.join(few, "doc_id", "left_semi")))


def repeated_ids(rows: DataFrame) -> DataFrame | None:
    """The ids that ``rows`` hold more than once; None if there are none."""
    repeated = materialize(rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    return None if repeated.isEmpty() else broadcast_if_small(repeated)


def _best_per_id(tokens: DataFrame) -> DataFrame:
    best = tokens.groupBy("doc_id").agg(F.max(F.struct("dl", "tokens")).alias("best"))
    return best.select("doc_id", "best.dl", "best.tokens")


def build_anchor_index(anchors: DataFrame, root: str, stemming: bool = False,
                       n_buckets: int = N_BUCKETS, idf_base: str = "e") -> InvertedIndex:
    """Index of link texts ``anchors(source_id, pos, doc_id, text)``; documents have no length."""
    with released_shuffles(anchors.sparkSession):
        return _publish_anchors(anchors, root, stemming, n_buckets, idf_base)


def _publish_anchors(anchors: DataFrame, root: str, stemming: bool, n_buckets: int, idf_base: str) -> InvertedIndex:
    spark = anchors.sparkSession
    gen = next_generation(spark, root)
    postings = materialize(anchor_postings(anchors, stemming))
    write_postings(postings, f"{root}/postings/gen={gen}", postings.count(), n_buckets)
    postings = _generation(spark, root, "postings", gen)
    write_doc_stats(postings.select("doc_id").distinct().withColumn("dl", F.lit(None).cast("bigint")),
                    f"{root}/doc_stats/gen={gen}")
    n_docs = _generation(spark, root, "doc_stats", gen).count()
    _write_term_stats(postings, f"{root}/term_stats/gen={gen}", n_buckets)
    n_postings = postings.count()
    return write_commit(spark, root, gen, Commit(n_docs, 0, n_postings, n_buckets, idf_base, stemming, (gen,), (n_postings,)))


def publish_tokens(spark: SparkSession, root: str, tokens: DataFrame, previous: InvertedIndex | None,
                   stemming: bool = False, n_buckets: int = N_BUCKETS, idf_base: str = "e",
                   refresh: bool | None = None, inbox_files: Sequence[str] = ()) -> InvertedIndex:
    """Turn tokenised documents into the next generation of the index at ``root``.

    The tokens are written first: the text is tokenised once, later steps read only the
    columns they need, and a lost executor costs no second tokenisation. A ``previous``
    state keeps its files and its settings; ``tokens`` hold none of its documents (see ``not_indexed``). ``refresh``
    says whether the norms are computed, which takes all postings: by default for a new index only.
    The files of an exchange are given back when its step is written.
    """
    with released_shuffles(spark):
        return _publish(spark, root, tokens, previous, stemming, n_buckets, idf_base, refresh, inbox_files)


def _publish(spark: SparkSession, root: str, tokens: DataFrame, previous: InvertedIndex | None, stemming: bool, n_buckets: int,
             idf_base: str, refresh: bool | None, inbox_files: Sequence[str]) -> InvertedIndex:
    gen = next_generation(spark, root)
    if previous:
        n_buckets, idf_base, stemming = previous.n_buckets, previous.idf_base, previous.stemming
    n_tokens = F.coalesce(F.size("tokens"), F.lit(0)).cast("bigint")
    tokens.select("doc_id", "dl", n_tokens.alias("n_tokens"), F.concat_ws(" ", "tokens").alias("tokens")).write.mode(
        "overwrite").parquet(f"{root}/tokens/gen={gen}")
    tokens = _generation(spark, root, "tokens", gen)
    added = tokens.agg(F.count("*").alias("docs"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("dl", "n_tokens")]).first()
    if previous and added.docs == 0 and not inbox_files:
        return previous

    counted = count_tokens(tokens.drop("n_tokens"), n_buckets=n_buckets)
    write_postings(counted, f"{root}/postings/gen={gen}", added.n_tokens, n_buckets)
    postings = _generation(spark, root, "postings", gen)
    n_postings = postings.count()
    _write_term_stats(postings, f"{root}/term_stats/gen={gen}", n_buckets)
    write_doc_stats(tokens, f"{root}/doc_stats/gen={gen}")
    _write_log(spark, inbox_files, f"{root}/inbox_log/gen={gen}")
    old = previous.commit if previous else Commit(0, 0, 0, n_buckets, idf_base, stemming)
    norms = (old.norms, old.norm_buckets) if added.docs == 0 else (None, 0)
    commit = replace(old, n_docs=old.n_docs + added.docs, sum_dl=old.sum_dl + added.dl, n_postings=old.n_postings + n_postings,
                     gens=(*old.gens, gen), sizes=(*old.sizes, n_postings), norms=norms[0], norm_buckets=norms[1])
    if refresh or refresh is None and not previous:
        commit = with_norms(InvertedIndex(spark, root, gen, commit))
    return write_commit(spark, root, gen, commit)


def not_indexed(rows: DataFrame, index: InvertedIndex) -> DataFrame:
    """The rows whose doc_id is not in ``index``; of a small addition only its own ids are looked up."""
    known, added = index.lengths.select("doc_id"), rows.select("doc_id")
    if small_enough(added):
        known = F.broadcast(known.join(F.broadcast(added), "doc_id", "left_semi"))
    return rows.join(known, "doc_id", "left_anti")


def _generation(spark: SparkSession, root: str, table: str, gen: int) -> DataFrame:
    return read_table(spark, root, table, [gen]).drop("gen")


def _write_term_stats(postings: DataFrame, path: str, n_buckets: int) -> None:
    """Frequencies within one generation; those of several are added up when they are read."""
    sums = postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").cast("bigint").alias("term_total"))
    write_term_stats(sums, path, n_buckets)


def _write_log(spark: SparkSession, files: Sequence[str], path: str) -> None:
    """The files of an inbox that a generation was made of."""
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.mode("overwrite").parquet(path)


def compact_index(spark: SparkSession, root: str, ratio: float | None = None) -> InvertedIndex:
    """Merge generations of an index into one; searches give the same before and after.

    Without ``ratio`` all become one. With it the newest ones are merged, and an older one joins
    as long as it is at most ``ratio`` times as large as those after it together: called after each addition,
    this leaves a number of generations that grows with the logarithm of the size, and every posting
    is rewritten about as often. The merged generation is read in place of its parts; files of the
    parts stay for readers that have them open, but are not read again. The norms stay as they are.
    """
    index = read_index(spark, root)
    first, merged = len(index.gens) - 1, index.commit.sizes[-1]
    while first > 0 and (ratio is None or index.commit.sizes[first - 1] <= ratio * merged):
        first -= 1
        merged += index.commit.sizes[first]
    chosen = index.gens[first:]
    if len(chosen) < 2:
        return index
    gen = next_generation(spark, root)
    write_postings(index.table("postings", chosen).drop("bucket"), f"{root}/postings/gen={gen}", merged, index.n_buckets)
    write_term_stats(merged_term_stats(index, chosen), f"{root}/term_stats/gen={gen}", index.n_buckets)
    write_doc_stats(index.table("doc_stats", chosen), f"{root}/doc_stats/gen={gen}")
    index.table("inbox_log", chosen).coalesce(1).write.mode("overwrite").parquet(f"{root}/inbox_log/gen={gen}")
    return write_commit(spark, root, gen, replace(
        index.commit, gens=(*index.gens[:first], gen), sizes=(*index.commit.sizes[:first], merged)))
