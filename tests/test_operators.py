import random
from bisect import bisect_right

from pyspark.sql import functions as F

from brute import average_precision, scale
from lexispark.operators import fusion, metrics, selection, skew, statistics
from lexispark.operators.postings import (
    anchor_postings, count_words, merge_posting_lists, posting_lists, term_bucket, unnest_posting_lists)
from lexispark.operators.similarity import most_similar
from lexispark.operators.splitters import block_of, id_splitters


def hits(spark, *lists):
    data = [(q, d, float(s)) for q, pairs in enumerate(lists) for d, s in pairs]
    return spark.createDataFrame(data, "query_id bigint, doc_id bigint, score double")


def ranked(spark, predicted):
    data = [(q, i + 1, d) for q, docs in predicted.items() for i, d in enumerate(docs)]
    return spark.createDataFrame(data, "query_id bigint, rank int, doc_id bigint")


def labels(spark, truth):
    return spark.createDataFrame([(q, d) for q, docs in truth.items() for d in docs], "query_id bigint, doc_id bigint")


# ---- postings ---------------------------------------------------------------------------

def test_counts_add_up(spark, rows):
    docs = spark.createDataFrame([(1, "cat cat dog"), (2, ""), (3, "dog 12 dog")], "doc_id bigint, text string")
    counts = count_words(docs)
    assert rows(counts, "term", "doc_id", "tf") == [("12", 3, 1), ("cat", 1, 2), ("dog", 1, 1), ("dog", 3, 2)]
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    stats = statistics.term_statistics(counts, 3)
    assert stats.where("df > term_total").count() == 0
    assert rows(stats, "term", "df", "term_total") == [("12", 1, 1), ("cat", 1, 2), ("dog", 2, 3)]
    assert rows(count_words(docs.select("doc_id", F.lit("cats cat").alias("text")), stemming=True), "term", "tf") == [
        ("cat", 2)] * 3


def test_anchor_postings_are_a_set_of_triples(spark, rows):
    links = [(1, 0, 7, "java"), (2, 0, 7, "java"), (2, 1, 7, "java java"), (3, 0, 8, "java")]
    anchors = spark.createDataFrame(links, "source_id bigint, pos int, doc_id bigint, text string")
    assert rows(anchor_postings(anchors)) == [("java", 7, 1), ("java", 7, 2), ("java", 8, 1)]


def test_blocks_split_a_hot_term_and_merge_back(spark, rows):
    data = [("hot", d, 1 + d % 3) for d in range(1000)] + [("cold", 5, 1)]
    postings = spark.createDataFrame(data, "term string, doc_id bigint, tf bigint")
    lists = posting_lists(postings, 100)
    assert rows(lists.groupBy("term").agg(F.count("*"), F.max(F.size("postings")))) == [("cold", 1, 1), ("hot", 10, 100)]
    shards = [posting_lists(postings.where(part), 100) for part in ("doc_id % 2 = 0", "doc_id % 2 = 1")]
    assert rows(merge_posting_lists(shards)) == rows(lists)
    assert rows(unnest_posting_lists(lists), "term", "doc_id", "tf") == sorted(data)


def test_buckets_are_stable(spark):
    df = spark.createDataFrame([("java",), ("été",), ("",)], "t string")
    from hashlib import md5
    want = [int(md5(t.encode()).hexdigest()[:10], 16) % 124 for t in ("java", "été", "")]
    assert [r[0] for r in df.select(term_bucket("t")).collect()] == want


# ---- skew -------------------------------------------------------------------------------

def test_joins_for_hot_terms_equal_the_plain_join(spark, rows, monkeypatch):
    monkeypatch.setattr(skew, "PLAIN_JOIN_POSTINGS", 10)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
    monkeypatch.setattr(skew, "FREQUENT_TERMS", 10)
    data = [("hot", d) for d in range(400)] + [("warm", d) for d in range(60)] + [(f"t{d}", d) for d in range(40)]
    postings = spark.createDataFrame(data, "term string, doc_id bigint")
    stats = postings.groupBy("term").agg(F.count("*").alias("df")).unionByName(
        spark.createDataFrame([("unused", 900)], "term string, df bigint"))
    columns = ["term", "doc_id", "df"]
    want = rows(postings.join(stats, "term"), *columns)
    by_size = skew.join_term_stats(postings, stats, len(data))
    assert rows(by_size, *columns) == want
    assert "Union" in by_size._jdf.queryExecution().optimizedPlan().toString()
    terms = stats.crossJoin(spark.range(3).withColumnRenamed("id", "query_id"))
    sliced = skew.join_terms(postings, terms, len(data))
    assert rows(sliced, *columns, "query_id") == rows(postings.join(terms, "term"), *columns, "query_id")
    assert "slice" in sliced._jdf.queryExecution().optimizedPlan().toString()


def test_numbering_in_pieces_equals_one_window(spark, rows):
    rng = random.Random(3)
    data = [(rng.randint(0, 1), d, rng.randint(1, 4)) for d in range(500)]
    df = spark.createDataFrame(data, "query_id bigint, doc_id bigint, score bigint")
    want = []
    for q in (0, 1):
        ordered = sorted((r for r in data if r[0] == q), key=lambda r: (-r[2], r[1]))
        want += [(*r, i + 1) for i, r in enumerate(ordered)]
    assert rows(fusion.rank_all(df, block_docs=7), "query_id", "doc_id", "score", "rank") == sorted(want)


def test_measured_blocks_bound_pieces_and_their_number(spark, rows):
    rng = random.Random(4)
    ids = sorted({rng.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(4000)} | set(range(1000)))   # sparse, and a dense spot
    docs = spark.createDataFrame([(d,) for d in ids], "doc_id bigint")
    splitters = id_splitters(docs, len(ids), 100)
    assert 40 <= len(splitters) < 50
    assert id_splitters(docs, 100, 100) == [] and id_splitters(docs.limit(0), 0) == []

    blocks = docs.withColumn("block", block_of(F.col("doc_id"), splitters))
    assert rows(blocks, "doc_id", "block") == sorted((d, bisect_right(splitters, d)) for d in ids)
    assert all(r["count"] <= 125 for r in blocks.groupBy("block").count().collect())

    hits = docs.selectExpr("1 AS query_id", "doc_id", "7 AS score")
    assert rows(fusion.rank_all(hits, splitters=splitters), "doc_id", "rank") == [(d, i + 1) for i, d in enumerate(ids)]
    lists = posting_lists(docs.selectExpr("'hot' AS term", "doc_id", "1L AS tf"), splitters=splitters)
    whole = [p.doc_id for r in lists.orderBy("block").collect() for p in r.postings]
    assert whole == ids and lists.count() == len(splitters) + 1


# ---- fusion -----------------------------------------------------------------------------

def test_scaling(spark, rows):
    lists = [[(1, 3), (2, 1), (3, 2)], [(1, 5), (2, 5)], [(9, -1), (8, 1)]]
    want = sorted((q, d, s) for q, pairs in enumerate(lists) for d, s in scale(pairs))
    assert rows(fusion.min_max_scale(hits(spark, *lists), ["query_id"]), "query_id", "doc_id", "score") == want


def test_fusion_with_one_empty_side(spark, rows):
    first = hits(spark, [(1, 4), (2, 2)], [], [(1, 1)])
    second = hits(spark, [(2, 9), (3, 3)], [(5, 1), (6, 0)], [])
    merged = fusion.merge_two(first, second)
    assert rows(merged, "query_id", "rank", "doc_id", "score") == [
        (0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 3, 0.0), (1, 1, 5, 0.5), (1, 2, 6, 0.0), (2, 1, 1, 0.0)]
    everything = fusion.merge_title_rank_views(first, second, hits(spark, [(1, 1)], [(5, 1)], [(1, 1)]))
    assert rows(everything, "query_id", "doc_id") == [(0, 1), (0, 2), (0, 3)]


def test_lookup_defaults_to_zero_and_keeps_order_columns(spark, rows):
    ids = spark.createDataFrame([(0, 5), (1, 6), (2, 5)], "pos int, doc_id bigint")
    values = spark.createDataFrame([(5, 1.5)], "doc_id bigint, page_rank double")
    for bound in (None, 3):
        assert rows(fusion.page_rank_lookup(ids, values, bound), "pos", "doc_id", "page_rank") == [
            (0, 5, 1.5), (1, 6, 0.0), (2, 5, 1.5)]


# ---- neighbours -------------------------------------------------------------------------

def test_neighbours_do_not_depend_on_the_blocks(spark, rows, monkeypatch):
    rng = random.Random(5)
    data = [(f"w{i:03d}", [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)]
    vectors = spark.createDataFrame(data, "id string, vec array<double>")
    one = rows(most_similar(vectors, vectors, 4), "query", "rank", "id", "similarity")
    monkeypatch.setattr("lexispark.operators.similarity.QUERY_BLOCK", 30)
    monkeypatch.setattr("lexispark.operators.similarity.VECTOR_BLOCK", 25)
    assert rows(most_similar(vectors, vectors, 4), "query", "rank", "id", "similarity") == one

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    best = sorted(((round(cosine(data[0][1], v), 6), w) for w, v in data[1:]), key=lambda x: (-x[0], x[1]))[:4]
    assert [(s, w) for q, _, w, s in one if q == "w000"] == best


# ---- metrics ----------------------------------------------------------------------------

def test_metrics_by_hand(spark):
    predicted = {1: [10, 11, 12], 2: [20, 21, 20, 22], 3: [30] * 15 + [31], 5: [50]}
    truth = {1: [99], 2: [20, 22, 29], 3: [31], 4: [40]}
    found = {r.query_id: r for r in metrics.evaluate(ranked(spark, predicted), labels(spark, truth), 100).collect()}
    assert set(found) == {1, 2, 3, 4}                           # only labelled queries, answered or not
    assert all(found[1][m] == 0 for m in ("map", "recall", "precision", "r_precision", "reciprocal_rank", "f_score"))
    two = found[2]
    assert (two.recall, two.precision) == (1.0, 0.075)          # the repeated document counts twice
    assert two.r_precision == 0.333 and two.reciprocal_rank == 1.0
    assert two.fallout_rate == round((4 - 2) / (100 - 3), 3)
    assert two.f_score == round(2 * 0.075 / 1.075, 3) and two.f1 == round(2 * 0.075 / 1.075, 3)
    assert two.map == round((1 + 0.667 + 0.75) / 3, 3)
    assert found[3].map == 0.062 and found[3].reciprocal_rank == 0.062   # 1/16 rounds half to even
    assert found[4].map == 0 and found[4].fallout_rate == 0
    run = {r.query_id: r.ap for r in metrics.evaluate_run(ranked(spark, predicted), labels(spark, truth)).collect()}
    assert run[4] is None and run[1] == 0.0
    summary = metrics.summarize_run(metrics.evaluate_run(ranked(spark, predicted), labels(spark, truth))).first()
    assert (summary.n_queries, summary.n_failed) == (4, 1)


def test_precision_means_against_lists(spark):
    rng = random.Random(7)
    predicted = {q: rng.sample(range(60), 50) for q in range(20)}
    truth = {q: rng.sample(range(60), 12) for q in range(20)}
    counts = metrics.count_hits(ranked(spark, predicted), labels(spark, truth))
    got = counts.select("query_id", metrics.map_at_k().alias("m"), metrics.average_precision().alias("a")).collect()
    for r in got:
        t, p = set(truth[r.query_id]), predicted[r.query_id]
        assert abs(r.m - average_precision(t, p, inner=3)) <= 0.0005001
        assert abs(r.a - average_precision(t, p)) <= 0.0005001


# ---- selection --------------------------------------------------------------------------

def test_split_sizes_and_grid(spark):
    queries = spark.createDataFrame([(q, f"q{q}") for q in range(30)], "query_id bigint, query string")
    split = selection.shuffle_split(queries.select("query_id"), cv=4).groupBy("fold").agg(
        F.sum(F.col("is_train").cast("int")).alias("train"), F.count("*").alias("n")).collect()
    assert [(r.train, r.n) for r in split] == [(24, 30)] * 4
    assert selection.shuffle_split(queries.select("query_id")).where("is_train").groupBy("query_id").count().count() > 24

    calls = []

    def search(asked, n, expand, similar_words, similarity, stemming):
        calls.append((n, expand, similar_words, similarity, stemming))
        hit_rank = 1 if stemming else 3                         # the relevant document is its own query id
        return asked.select("query_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("rank")).select(
            "query_id", "rank", F.when(F.col("rank") == hit_rank, F.col("query_id")).otherwise(-F.col("rank")).alias("doc_id"))

    qrels = queries.selectExpr("query_id", "query_id AS doc_id")
    results = selection.grid_search(search, queries, qrels, cv=2, num_results=[1, 3], expand=[False, True],
                                    similar_words=[3, 6], stemming=[False, True])
    assert len(calls) == 6 and all(c[0] == 3 for c in calls)    # without expansion its parameters share a search
    found = {(r.fold, r.num_results, r.expand, r.similar_words, r.stemming): (r.train_map, r.test_map)
             for r in results.collect()}
    assert len(found) == 2 * 2 * 2 * 2 * 2
    assert all(v == ((1.0, 1.0) if k[4] else ((0.333, 0.333) if k[1] == 3 else (0.0, 0.0))) for k, v in found.items())
    best = selection.best_params(results).first()
    assert best.stemming and best.train_map == 1.0
    average = selection.best_params(results, "average").first()
    assert average.stemming == round(2 / 3, 6)                  # every result above zero was accepted
