"""Joins cut by the length of another list, and common documents."""

from lexispark.operators import metrics, skew


def test_hot_terms_are_cut_by_the_named_length(spark, monkeypatch):
    monkeypatch.setattr(skew, "PLAIN_JOIN_POSTINGS", 0)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
    postings = spark.createDataFrame([("a", d) for d in range(90)] + [("b", 1)], "term string, doc_id bigint")
    terms = spark.createDataFrame([(1, "a", 2, 90), (2, "a", 2, 90), (1, "b", 900, 1)],
                                  "query_id int, term string, df bigint, list_df bigint")
    rows = skew.join_terms(postings, terms, 91, "list_df").select("query_id", "term", "doc_id").collect()
    assert sorted(map(tuple, rows)) == sorted([(q, "a", d) for q in (1, 2) for d in range(90)] + [(1, "b", 1)])


def test_intersect(spark):
    hits = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 6), (2, 1, 7)], "query_id int, rank int, doc_id bigint")
    qrels = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "query_id int, doc_id bigint")
    assert [tuple(r) for r in metrics.intersect(hits, qrels).collect()] == [(1, 5)]
