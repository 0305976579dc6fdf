"""Disk: postings are dealt by document before they meet the queries, and exchanges are given back."""

import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from lexispark.operators import fusion, matching, scoring, selection
from lexispark.operators.matching import (
    document_partitions, inspect_batch, lookup_linked, lookup_postings, lookup_statistics, match_terms)
from lexispark.plans.build import build_anchor_index, build_index
from lexispark.plans.search import SearchEngine
from lexispark.settings import CLEAN_SHUFFLES, released_shuffles

DOCS = "doc_id bigint, text string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(n, seed=6):
    rng = random.Random(seed)
    return [(i, " ".join(f"word{rng.randrange(30)}" for _ in range(rng.randrange(1, 20)))) for i in range(n)]


def shuffle_files(spark):
    spark_env = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in spark_env.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def new_files(spark, before, most=5.0):
    """Shuffle files besides ``before``; they are removed a moment after a query ends."""
    until = time.time() + most
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_postings_move_once_for_all_queries(spark, rows, tmp_path, monkeypatch):
    data = [*texts(60), (None, "word1 word2"), (None, "word1")]
    index = build_index(spark.createDataFrame(data, DOCS), str(tmp_path / "index"), n_buckets=4)
    terms = spark.createDataFrame([(q, f"word{t}") for q in range(9) for t in (1, 2, 3 + q)] + [(None, "word1"), (1, "none")],
                                  "query_id bigint, term string")
    batch = inspect_batch(terms, 4, index.n_postings)
    known = lookup_statistics(index, terms, batch)
    columns, key = ["query_id", "term", "doc_id", "tf", "dl", "df"], lambda df: sorted(map(str, df.select(*columns).collect()))
    whole = key(lookup_postings(index, known, batch))
    dealt = lookup_postings(index, known, batch, 3)
    # The queries are met above the exchange, in its partitions.
    assert "hashpartitioning(doc_id" in plan(dealt) and "query_id" not in plan(dealt).split("Exchange hashpartitioning(doc_id")[1].split(
        "Scan parquet")[0].split("BroadcastExchange")[0]
    assert key(dealt) == whole == key(match_terms(index, terms, by_document=True)) and len(whole) > 200
    large = matching.Batch(9, False, 4, batch.buckets)
    assert key(lookup_postings(index, known, large, 3)) == whole
    for df in (scoring.binary_ranking(dealt.withColumn("qtf", F.lit(2)), dealt=True), scoring.bm25_score(dealt, 62, 5.0, dealt=True)):
        assert plan(df).count("Exchange hashpartitioning(") == 1
    monkeypatch.setattr(matching, "PARTITION_MATCHES", 10)
    assert document_partitions(known) == -(-len(whole) // 10)


def test_a_build_gives_its_exchanges_back(spark, tmp_path):
    before, conf = shuffle_files(spark), spark.conf.get(CLEAN_SHUFFLES, "false")
    index = build_index(spark.createDataFrame(texts(80), DOCS), str(tmp_path / "index"), n_buckets=4)
    assert not new_files(spark, before) and spark.conf.get(CLEAN_SHUFFLES) == conf
    assert index.postings.groupBy("term").count().count() == 30  # a plan made outside of the block runs as ever


def test_grid_holds_the_exchanges_of_one_search(spark, rows):
    found, before = [], shuffle_files(spark)

    def search(queries, variants, stemming, n, expand):
        found.append(new_files(spark, before))
        docs = spark.range(50).withColumnRenamed("id", "doc_id").repartition(3, "doc_id")
        hits = queries.crossJoin(docs).select("query_id", (F.col("doc_id") + 1).cast("int").alias("rank"), "doc_id")
        return hits.crossJoin(spark.createDataFrame([(i,) for i in range(len(variants))], "variant int")).where(F.col("rank") <= n)

    queries = spark.createDataFrame([(q, "x") for q in range(4)], "query_id bigint, query string")
    qrels = spark.createDataFrame([(q, d) for q in range(4) for d in (q, 2 * q + 1)], "query_id bigint, doc_id bigint")
    result = selection.grid_search_variants(search, queries, qrels, num_results=[5, 10], expand=[False, True], stemming=[False, True])
    assert len(found) == 4 and not any(found) and not new_files(spark, before)
    assert result.count() == 5 * 8 and "Range" not in plan(result)  # the searches are done
    with released_shuffles(spark):
        assert spark.conf.get(CLEAN_SHUFFLES) == "true"


def test_own_and_linked_postings_move_once(spark, rows, tmp_path):
    data = [*texts(60), (None, "word1 word2"), (None, "word1")]
    index = build_index(spark.createDataFrame(data, DOCS), str(tmp_path / "index"), n_buckets=4)
    rng = random.Random(7)
    links = [(s, 0, rng.choice([*range(40, 75), None]), rng.choice(["word1", "word2 word2", "word2 word1 word1", "other"])) for s in range(90)]
    anchor = build_anchor_index(spark.createDataFrame(links, "source_id bigint, pos int, doc_id bigint, text string"),
                                str(tmp_path / "anchor"), n_buckets=4)
    terms = spark.createDataFrame([(q, f"word{t}") for q in range(5) for t in (1, 2, 3 + q)], "query_id bigint, term string")
    batch = inspect_batch(terms, 4, index.n_postings)
    known = lookup_statistics(index, terms, batch)
    columns, key = ["query_id", "term", "doc_id", "tf", "dl", "df"], lambda df, names: sorted(map(str, df.select(*names).collect()))
    want = scoring.term_candidates(lookup_postings(index, known, batch), lookup_linked(anchor, known, batch), index.lengths)
    own = lookup_postings(index, known, batch, 3)
    merged = scoring.term_candidates(own, lookup_linked(anchor, known, batch, 3), index.lengths, dealt=True)
    assert key(merged, columns) == key(want, columns) and merged.count() > own.count()
    # Linked documents that are not in the index, and those without an id, have no length.
    assert merged.where("doc_id >= 60").isEmpty() and not own.where("doc_id is null").isEmpty()
    names, scores = ["query_id", "doc_id", "score"], scoring.bm25_score(merged, 60, 9.0, dealt=True)
    assert key(scores, names) == key(scoring.bm25_score(want, 60, 9.0), names)
    # Own postings, linked ones and lengths move by document, nothing by query.
    text = plan(scores).split("BroadcastExchange")
    assert plan(scores).count("Exchange hashpartitioning(doc_id") == 2 and plan(scores).count("Exchange hashpartitioning(__id") == 1
    assert "Exchange hashpartitioning(query_id" not in text[0]
    # A document with two lengths counts for its linked rows only, as ever.
    twice = index.lengths.unionByName(index.lengths.withColumn("dl", F.lit(99).cast("bigint")))
    split = scoring.term_candidates(lookup_postings(index, known, batch), lookup_linked(anchor, known, batch), twice)
    assert key(scoring.term_candidates(own, lookup_linked(anchor, known, batch, 3), twice, dealt=True), columns) == key(split, columns)


@pytest.mark.parametrize("search", ["search_title", "search_title_binary", "search_anchor"])
def test_lists_are_ranked_without_their_titles(spark, rows, tmp_path, monkeypatch, search):
    data = [*texts(40), (None, "word1 word2"), (10 ** 15, "word1 word1 word2")]
    index = build_index(spark.createDataFrame(data, DOCS), str(tmp_path / "index"), n_buckets=4)
    named = [(i, f"title {i}" if i % 5 else None) for i, _ in data[:38]] + [(10 ** 15, "far"), (3, "other 3"), (3, "title 3"), (None, "none"), (99, "x")]
    titles = spark.createDataFrame(named, "doc_id bigint, title string")
    queries = spark.createDataFrame([(1, "word1 word2 word1"), (2, "word3"), (3, "none"), (4, ""), (None, "word1")], "query_id bigint, query string")
    seen, whole = [], fusion.rank_all
    monkeypatch.setattr(fusion, "rank_all", lambda hits, **options: seen.append(hits.columns) or whole(hits, **options))
    monkeypatch.setattr(matching, "PARTITION_MATCHES", 10)
    engine = SearchEngine(title=index, anchor=index, titles=titles)
    found = [tuple(r) for r in getattr(engine, search)(queries).collect()]
    assert seen and not any("title" in columns for columns in seen)
    want = []
    for query, words in ((1, ["word1", "word1", "word2"]), (2, ["word3"])):
        scored = [(-sum(w in text.split() for w in words), doc) for doc, text in data if doc is not None and set(words) & set(text.split())]
        hits = [(s, doc, title) for s, doc in sorted(scored) for title in sorted((t for i, t in named if i == doc), key=lambda t: t or "")]
        want += [(query, rank, doc, title, -s) for rank, (s, doc, title) in enumerate(hits, 1)]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_dense_rows_are_filled_in_across_batches(spark, tmp_path):
    words = [f"term{chr(97 + i)}" for i in range(26)]  # words of letters: others have no length
    rng = random.Random(8)
    data = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(60)] + [(None, "terma termb"), (None, "termc termc"), (70, "")]
    index = build_index(spark.createDataFrame(data, DOCS), str(tmp_path / "index"), n_buckets=4)
    terms = spark.createDataFrame([(q, words[t]) for q in range(5) for t in (1, 2, 3 + q, 5 * q)] + [(None, words[1]), (8, "none")],
                                  "query_id bigint, term string").distinct()
    weights = scoring.candidate_tfidf(match_terms(index, terms))
    found = {(r.query_id, r.doc_id, r.term): r.w_d for r in weights.collect() if r.query_id is not None}
    wanted = {q: sorted({t for p, _, t in found if p == q}) for q, _, _ in found}
    want = sorted(((q, d, wanted[q], [round(found.get((q, d, t), 0.0), 9) for t in wanted[q]]) for q, d in {(q, d) for q, d, _ in found}), key=str)
    dealt = scoring.candidate_tfidf(match_terms(index, terms, by_document=True), dealt=True)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for size in ("1", "3", before):
            spark.conf.set(key, size)
            for matrix in (scoring.dense_tfidf_matrix(weights), scoring.dense_tfidf_matrix(dealt, terms.join(weights, ["query_id", "term"], "left_semi"), True)):
                assert "transform" not in plan(matrix) and "collect_list" not in plan(matrix)
                assert sorted(((r.query_id, r.doc_id, r.terms, [round(w, 9) for w in r.weights]) for r in matrix.collect()), key=str) == want
    finally:
        spark.conf.set(key, before)
    assert scoring.dense_tfidf_matrix(weights.limit(0)).isEmpty() and any(d is None for _, d, _, _ in want)
