"""Steps that grew faster than their input: counting, dense rows, sums of matches, neighbours."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lexispark.functions import stemming
from lexispark.operators import postings, scoring, similarity
from lexispark.operators.similarity import most_similar


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_counted_in_bounded_slices(spark, rows, monkeypatch):
    rng = random.Random(3)
    docs = [(i, f"k{i}", [f"t{rng.randrange(9)}" for _ in range(rng.randrange(40))]) for i in range(30)]
    docs += [(30, None, None), (31, "empty", []), (30, None, ["t1", "t1", "ü"])]
    df = spark.createDataFrame(docs, "doc_id bigint, other string, tokens array<string>").coalesce(1)
    expected = sorted(((d, o, t, n) for d, o, ts in docs for t, n in Counter(ts or []).items()), key=str)
    monkeypatch.setattr(postings, "SLICE_TOKENS", 25)
    monkeypatch.setattr(postings, "SLICE_ROWS", 4)
    counted = postings.count_tokens(df)
    assert counted.columns == ["doc_id", "other", "term", "tf"]
    assert sorted((tuple(r) for r in counted.collect()), key=str) == expected
    sizes = np.array([3, 0, 30, 20, 5, 1])
    assert list(postings._slices(sizes)) == [(0, 2), (2, 1), (3, 2), (5, 1)]


def test_stems_are_counted_in_one_python_step(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(1, "running runs run cats"), (2, "cat, Cats!"), (3, None)], "doc_id bigint, text string")
    counted = postings.count_words(docs, stemming=True)
    text = plan(counted)
    assert text.count("Python") + text.count("MapInArrow") == 1 and "Exchange" not in text
    monkeypatch.setattr(stemming, "MEMO_LIMIT", 2)
    assert rows(postings.count_words(docs, stemming=True)) == rows(counted) == [(1, "cat", 1), (1, "run", 3), (2, "cat", 2)]


def test_dense_rows_stay_where_they_are(spark, rows):
    rng = random.Random(4)
    weights = [(q, d, f"t{t}", float(rng.randint(1, 9))) for q in range(3) for d in range(40)
               for t in rng.sample(range(12), rng.randint(1, 5))]
    matches = spark.createDataFrame(weights, "query_id bigint, doc_id bigint, term string, idf double").withColumns(
        {"tf": F.lit(1).cast("bigint"), "dl": F.lit(1).cast("bigint")})
    dense = scoring.dense_tfidf_matrix(scoring.candidate_tfidf(matches))
    # The rows of the documents move once, by query and document; not again to meet the columns of their query.
    assert plan(dense).count("Exchange hashpartitioning") == 1
    terms = {q: sorted({t for p, _, t, _ in weights if p == q}) for q in range(3)}
    found = {(q, d, t): w for q, d, t, w in weights}
    assert sorted((r.query_id, r.doc_id, r.terms, r.weights) for r in dense.collect()) == [
        (q, d, terms[q], [found.get((q, d, t), 0.0) for t in terms[q]]) for q, d in sorted({(q, d) for q, d, _, _ in weights})]


def test_matches_are_summed_behind_the_exchange(spark, rows):
    matches = spark.createDataFrame([(1, 5, "a", 2), (1, 5, "b", 1), (1, 6, "a", 2), (None, 6, "a", 2)],
                                    "query_id bigint, doc_id bigint, term string, qtf bigint")
    for distinct, expected in ((True, [(1, 5, 2), (1, 6, 1), (None, 6, 1)]), (False, [(1, 5, 3), (1, 6, 2), (None, 6, 2)])):
        ranked = scoring.binary_ranking(matches, distinct_terms=distinct)
        # No sums below the exchange, where they would hold all matches of a scan.
        assert "Aggregate" not in plan(ranked).split("Exchange hashpartitioning(query_id")[1]
        assert sorted((tuple(r) for r in ranked.collect()), key=str) == sorted(expected, key=str)


def test_scores_of_variants_travel_as_frequencies(spark, rows):
    data = [(1, d, 1 + d % 3, 10 + d % 7, 4, [0]) for d in range(50)] + [(1, d, 2, 10 + d % 7, 9, [0]) for d in range(0, 50, 3)]
    candidates = spark.createDataFrame(data, "query_id bigint, doc_id bigint, tf bigint, dl bigint, df bigint, term_sets array<int>")
    asked = [(1.2, 0.2, 0), (2.0, 0.75, 0)]
    scores = scoring.bm25_scores(candidates, 60, 12.0, asked, len(data))
    below = plan(scores).split("Exchange hashpartitioning(query_id")[1]
    assert "Aggregate" not in below and "part0" not in below
    for v, (k1, b, _) in enumerate(asked):
        alone = rows(scoring.bm25_score(candidates, 60, 12.0, k1, b), "query_id", "doc_id", "score")
        assert rows(scores.where(F.col("variant") == v), "query_id", "doc_id", "score") == alone


def test_best_of_rows_with_ties_and_missing_scores():
    rng = np.random.default_rng(6)
    scores = np.round(rng.normal(size=(20, 50)), 1) + rng.normal(size=(20, 50)) * 1e-8
    scores[3], scores[4, 2:] = -np.inf, -np.inf
    for n in (1, 4, 50, 60):
        row, column, found = similarity._best_of_rows(scores.copy(), n)
        for i in range(len(scores)):
            want = [(s, c) for s, c in sorted((-round(s, 6), c) for c, s in enumerate(scores[i]) if s > -np.inf)][:n]
            assert [(-s, c) for s, c in zip(found[row == i], column[row == i])] == want


def test_neighbours_travel_in_large_blocks(spark, rows, monkeypatch):
    vectors = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(40)] + [(7, [9.0, 1.0]), (None, [1.0, 1.0]), (99, [float("nan"), 1.0])],
                                    "id bigint, vec array<double>")
    key = lambda df: sorted((tuple(r) for r in df.select("query", "rank", "id", "similarity").collect()), key=str)
    one = key(most_similar(vectors, vectors, 3))
    assert not [r for r in one if r[0] is not None and (r[0] == r[2] or 99 in r[::2])]
    monkeypatch.setattr(similarity, "SCORE_ROWS", 7)
    assert key(most_similar(vectors, vectors, 3)) == one
    assert similarity.QUERY_BLOCK >= 8192 and similarity.VECTOR_BLOCK >= 16384
