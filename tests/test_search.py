from dataclasses import replace

import pytest

from brute import Index, fuse, top
from lexispark.functions.stemming import stem_tokens
from lexispark.functions.text import regex_tokens, word_tokens
from lexispark.operators import scoring
from lexispark.operators.postings import explode_anchors
from lexispark.plans.build import add_documents, build_anchor_index, build_index
from lexispark.plans.search import SearchEngine
from lexispark.sources.index_store import read_index, scan_posting_lists

DOCS = [
    (1, "Java coffee houses\nJava is an island; java coffee is grown on the island's hills."),
    (2, "Programming languages\nJava and Python are programming languages for programmers."),
    (3, ""),
    (4, "2024 1999\n12 34 56"),
    (5, "Coffee grinders\nGrinding coffee beans, a grinder's guide to coffee: it doesn't hurt."),
    (6, "Coffee grinders\nGrinding coffee beans, a grinder's guide to coffee: it doesn't hurt."),
    (7, "Python snakes\nPythons are non-venomous snakes of the islands."),
]
QUERIES = [(1, "java java coffee"), (2, "Python programming languages"), (3, ""), (4, "nothing here"),
           (5, "grinding islands' coffee"), (6, "1999")]
LINKS = [(1, [(7, "java snakes"), (99, "java"), (7, "java java")]), (2, [(5, "python python"), (4, "coffee")])]
RANKS = [(1, 0.5), (2, -1.0), (5, 2.5)]
VIEWS = [(1, 10), (6, 30)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index"))
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    titles = docs.selectExpr("doc_id", "substring_index(text, '\n', 1) AS text")
    links = explode_anchors(spark.createDataFrame(LINKS, "doc_id bigint, anchor_text array<struct<id: bigint, text: string>>"))
    parts = {}
    for name, table in (("body", docs), ("title", titles)):
        parts[name] = build_index(table, f"{root}/{name}", n_buckets=8)
        parts[f"{name}_stemmed"] = build_index(table, f"{root}/{name}_stemmed", stemming=True, n_buckets=8)
    engine = SearchEngine(
        **parts, anchor=build_anchor_index(links, f"{root}/anchor", n_buckets=8),
        titles=titles.withColumnRenamed("text", "title"),
        page_rank=spark.createDataFrame(RANKS, "doc_id bigint, page_rank double"),
        page_views=spark.createDataFrame(VIEWS, "doc_id bigint, views bigint"))
    queries = spark.createDataFrame(QUERIES, "query_id bigint, query string")

    def token_lists(df, key, text, stemming):
        patterns, words = regex_tokens(text), word_tokens(text)
        if stemming:
            patterns, words = stem_tokens(patterns), stem_tokens(words)
        return {r[0]: (r[1], r[2]) for r in df.select(key, patterns, words).collect()}

    brute = {}
    for stemming in (False, True):
        suffix = "_stemmed" if stemming else ""
        for name, table in (("body", docs), ("title", titles)):
            brute[name + suffix] = Index({d: (p, len(w)) for d, (p, w) in token_lists(table, "doc_id", "text", stemming).items()})
        brute["queries" + suffix] = token_lists(queries.where("length(query) > 0"), "query_id", "query", stemming)
    return engine, queries, brute


def by_query(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.doc_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def nonempty(lists):
    return {q: hits for q, hits in lists.items() if hits}


@pytest.mark.parametrize("stemming", [False, True])
def test_tfidf_and_bm25(corpus, stemming):
    engine, queries, brute = corpus
    suffix = "_stemmed" if stemming else ""
    asked, body = brute["queries" + suffix], brute["body" + suffix]
    want = nonempty({q: top(body.cosine(p), 3) for q, (p, _) in asked.items() if p})
    assert by_query(engine.search_body_tfidf(queries, stemming=stemming, n=3)) == want
    want = nonempty({q: top(body.bm25(w, 2.0, 0.75), 100) for q, (_, w) in asked.items()})
    assert by_query(engine.search_body_bm25(queries, stemming=stemming)) == want
    assert 4 not in want and 3 not in want


def test_binary_title_and_anchor(corpus):
    engine, queries, brute = corpus
    want = nonempty({q: top(brute["title"].binary(p)) for q, (p, _) in brute["queries"].items()})
    assert by_query(engine.search_title(queries)) == want
    assert dict(want[1])[1] == 3                     # duplicate query words count
    distinct = by_query(engine.search_title_binary(queries, distinct_terms=True))
    assert dict(distinct[1])[1] == 2
    # Doc 7 has java with two frequencies: both rows count, for both query occurrences; 99 has no title.
    anchor = by_query(engine.search_anchor(queries))
    assert anchor[1] == [(7, 4), (4, 1)]


@pytest.mark.parametrize("add_anchor", [False, True])
def test_ultimate_search(corpus, add_anchor):
    engine, queries, brute = corpus
    linked = {"java": {7: 2, 99: 1}, "snakes": {7: 1}, "python": {5: 2}, "coffee": {4: 1}} if add_anchor else None
    want = {}
    for q, (_, words) in brute["queries"].items():
        body = top(brute["body"].bm25(words, 1.5, 0.2, linked), 100)
        title = top(brute["title"].bm25(words, 1.5, 0.2, linked), 100)
        ids = {d for d, _ in body + title}
        ranks = [(d, dict(RANKS).get(d, 0)) for d in ids]
        views = [(d, dict(VIEWS).get(d, 0)) for d in ids]
        want[q] = fuse([body, title, ranks, views], [0.8, 0.8, 0.5, 0.5], 5, True)
    got = by_query(engine.ultimate_search(queries, stemming=False, add_anchor=add_anchor))
    assert got == nonempty(want)


def test_merged_lists_keep_queries_with_one_source(corpus):
    engine, queries, brute = corpus
    want = {}
    for q, (_, words) in brute["queries"].items():
        lists = [top(brute[f].bm25(words, 2.0, 0.75), 100) for f in ("body", "title")]
        want[q] = fuse(lists, [0.5, 0.5], 20, False)
    assert by_query(engine.search_body_and_title_bm25(queries)) == nonempty(want)


def test_added_documents_equal_one_build(spark, corpus, tmp_path, rows):
    engine, _, _ = corpus
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    root = str(tmp_path / "grown")
    build_index(docs.where("doc_id <= 4"), root, n_buckets=8)
    grown = add_documents(docs, root)
    again = add_documents(docs, root)
    assert grown.gen == again.gen == 1 and again.n_docs == len(DOCS)
    for table in ("postings", "term_stats", "doc_stats"):
        columns = sorted(getattr(grown, table).columns)
        assert rows(getattr(grown, table), *columns) == rows(getattr(engine.body, table), *columns)
    assert (grown.n_docs, grown.sum_dl, grown.n_postings) == (engine.body.n_docs, engine.body.sum_dl, engine.body.n_postings)


def test_unfinished_generation_stays_invisible(spark, corpus, tmp_path, rows):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    root = str(tmp_path / "crashed")
    first = build_index(docs.where("doc_id <= 4"), root, n_buckets=8)
    before = rows(first.postings)
    first.postings.write.partitionBy("bucket").parquet(f"{root}/postings/gen=1")      # what a dead job leaves behind
    assert rows(read_index(spark, root).postings) == before
    grown = add_documents(docs, root)
    assert grown.postings.groupBy("term", "doc_id").count().where("count > 1").count() == 0


@pytest.mark.parametrize("measured", [False, True])
def test_lists_cover_all_postings(corpus, measured):
    engine, _, brute = corpus
    lists = {}
    for r in scan_posting_lists(engine.body, block_docs=3, measured=measured).collect():
        assert [tuple(p) for p in r.postings] == sorted(tuple(p) for p in r.postings)
        lists.setdefault(r.term, {}).update({p.doc_id: p.tf for p in r.postings})
    assert lists == dict(brute["body"].lists)


def test_variants_in_one_plan_equal_single_searches(corpus, spark, monkeypatch):
    """One reading of the postings and one neighbour search answer every setting, whatever fits in a row."""
    engine, queries, _ = corpus
    monkeypatch.setattr(scoring, "SCORE_COLUMNS", 3)
    vectors = spark.createDataFrame(
        [("java", [1.0, 0.0]), ("coffee", [0.9, 0.1]), ("island", [0.7, 0.7]), ("python", [0.0, 1.0]), ("snakes", [0.1, 0.9])],
        "term string, vec array<double>")
    engine = replace(engine, word_vectors=vectors)
    for expand, stemming in ((False, False), (True, False), (True, True)):
        variants = [(k1, b, words, near) for k1 in (1.2, 2.0) for b in (0.2,) for words, near in ((1, 0.3), (3, 0.3), (3, 0.95))]
        found = engine.search_body_bm25_variants(queries, variants, stemming=stemming, n=4, expand=expand)
        got = {}
        for r in found.collect():
            got.setdefault(r.variant, set()).add((r.query_id, r["rank"], r.doc_id, r.score))
        for i, (k1, b, words, near) in enumerate(variants):
            single = engine.search_body_bm25(queries, k1, b, stemming, 4, expand, words, near)
            assert got.get(i, set()) == {(r.query_id, r["rank"], r.doc_id, r.score) for r in single.collect()}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        scans = [line for line in plan.splitlines() if "Relation" in line and ",tf#" in line]
        assert len(scans) == 1, plan
