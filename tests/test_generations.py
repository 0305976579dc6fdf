"""Term filters, additions that leave old postings alone, compaction, and norms clustered by document."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.operators import matching
from lexispark.operators.matching import inspect_batch, lookup_postings, lookup_statistics, match_terms
from lexispark.plans import build
from lexispark.plans.build import add_documents, build_index, compact_index
from lexispark.plans.search import SearchEngine
from lexispark.sources import index_store
from lexispark.sources.index_store import read_index, refresh_norms
from lexispark.streaming.ingest import ingest_tokens, publish_inbox, stream_documents

DOCS = "doc_id bigint, text string"


def word(number):
    """A word of letters alone."""
    return "qz" + "".join("abcdefghij"[int(d)] for d in str(number))


def corpus(n, seed=1, words=3000):
    rng = random.Random(seed)
    return [(i, " ".join(word(min(int(rng.expovariate(1 / 300)), words)) for _ in range(60))) for i in range(n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df, column):
    """Rows that each scan with ``column`` gave, after ``df`` was run."""
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    nodes, found = [executed.executedPlan() if executed.nodeName() == "AdaptiveSparkPlan" else executed], []
    while nodes:
        node = nodes.pop()
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        elif node.nodeName().startswith("Scan") and f"{column}#" in node.output().mkString(","):
            found.append(node.metrics().apply("numOutputRows").value())
        nodes.extend(node.children().apply(i) for i in range(node.children().size()))
    assert found
    return found


# ---- term-level skipping ----------------------------------------------------------------

def test_a_batch_in_every_bucket_reads_few_postings(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "PAGE_ROWS", 50)
    monkeypatch.setattr(matching, "POSTINGS_PER_LITERAL", 100)
    index = build_index(spark.createDataFrame(corpus(800), DOCS).repartition(4), str(tmp_path / "index"), n_buckets=8)
    names = [r.term for r in index.term_stats.orderBy("df", "term").limit(40).collect()]
    terms = spark.createDataFrame([(i % 7, t) for i, t in enumerate(names + ["missing"])], "query_id bigint, term string")
    batch = inspect_batch(terms, index.n_buckets)
    assert len(batch.buckets) == 8 and len(batch.terms) == 41
    found = match_terms(index, terms)
    read = scanned(found, "tf")
    assert sum(read) < index.n_postings / 5
    assert sum(scanned(lookup_statistics(index, terms, batch), "term_total")) < index.term_stats.count() / 2
    monkeypatch.setattr(matching, "LITERAL_TERMS", 10)
    whole = match_terms(index, terms)
    assert inspect_batch(terms, index.n_buckets).terms is None
    monkeypatch.setattr(matching, "LITERAL_TERMS", 4096)
    assert inspect_batch(terms, index.n_buckets, 41 * 100 - 1).terms is None and inspect_batch(terms, index.n_buckets, 41 * 100).terms
    columns = ["query_id", "term", "doc_id", "tf", "dl", "df", "term_total"]
    assert rows(found, *columns) == rows(whole, *columns) and sum(scanned(whole, "tf")) >= index.n_postings


def test_groups_of_terms_cover_the_batch_once(spark, rows, tmp_path, monkeypatch):
    index = build_index(spark.createDataFrame(corpus(60), DOCS), str(tmp_path / "index"), n_buckets=4)
    names = [r.term for r in index.term_stats.collect()]
    terms = spark.createDataFrame([(1, t) for t in names] + [(2, names[0]), (3, None)], "query_id bigint, term string")
    want = rows(index.postings.select("term", "doc_id"))
    monkeypatch.setattr(matching, "POSTINGS_PER_LITERAL", 1)
    for size in (1000, 7):
        monkeypatch.setattr(matching, "PUSHED_LITERALS", size)
        assert rows(match_terms(index, terms).where("query_id = 1").select("term", "doc_id")) == want
    nothing = terms.where("false")
    assert match_terms(index, nothing).count() == 0
    large = matching.Batch(3, False, 4, (0, 1, 2, 3), inspect_batch(terms, 4).terms)
    matched = lookup_postings(index, lookup_statistics(index, terms, large), large)
    assert rows(matched, "query_id", "term", "doc_id") == rows(match_terms(index, terms), "query_id", "term", "doc_id")


def test_terms_with_quotes_are_literals(spark):
    odd = ["it's", "a\\b", "'", "\\'", "x\"y"]
    table = spark.createDataFrame([(i % 2, t) for i, t in enumerate([*odd, "its", "b"])], "bucket int, term string")
    batch = matching.Batch(1, True, 2, (0, 1), tuple(sorted((i % 2, t) for i, t in enumerate(odd))))
    assert sorted(r.term for r in batch.rows_of(table, 2).collect()) == sorted(odd)


# ---- additions and compaction -----------------------------------------------------------

def searches(spark, index, rows):
    queries = spark.createDataFrame([(1, f"{word(1)} {word(2)} {word(200)}"), (2, word(17)), (3, f"{word(900)} {word(1)}")], "query_id bigint, query string")
    engine = SearchEngine(body=index, title=index)
    return [rows(engine.search_body_bm25(queries, n=20)), rows(engine.search_body_tfidf(queries, n=20)),
            rows(index.term_stats, "bucket", "term", "df", "term_total"), rows(index.doc_stats, "doc_id", "dl"),
            [(d, round(n, 9)) for d, n in rows(index.norms, "doc_id", "norm")]]


def test_an_addition_reads_no_old_postings(spark, rows, tmp_path, monkeypatch):
    docs, root = corpus(90), str(tmp_path / "grown")
    build_index(spark.createDataFrame(docs[:60], DOCS), root, n_buckets=4)
    read = []
    plain = index_store.read_table
    monkeypatch.setattr(index_store, "read_table", lambda s, r, t, g=None: read.append(t) or plain(s, r, t, g))
    grown = add_documents(spark.createDataFrame(docs[50:], DOCS), root)
    assert not {"postings", "term_stats", "tokens"} & set(read)  # of the old state only ids and commits
    monkeypatch.undo()
    assert grown.gens == (0, 1) and grown.commit.norms is None
    whole = build_index(spark.createDataFrame(docs, DOCS), str(tmp_path / "whole"), n_buckets=4)
    want = searches(spark, whole, rows)
    assert searches(spark, grown, rows) == want
    fresh = refresh_norms(spark, root)
    assert fresh.commit.norms and fresh.gens == grown.gens and searches(spark, fresh, rows) == want
    assert refresh_norms(spark, root).gen == fresh.gen


def test_compaction_changes_no_search(spark, rows, tmp_path):
    docs, root = corpus(120), str(tmp_path / "grown")
    build_index(spark.createDataFrame(docs[:30], DOCS), root, n_buckets=4)
    for first in (30, 60, 90):
        grown = add_documents(spark.createDataFrame(docs[first:first + 30], DOCS), root)
    before = searches(spark, grown, rows)
    files = set(grown.postings.inputFiles())
    merged = compact_index(spark, root)
    assert len(merged.gens) == 1 == len(set(merged.gens)) and not files & set(merged.postings.inputFiles())
    assert merged.base_gen == merged.gen > grown.gen and merged.n_postings == sum(merged.commit.sizes) == merged.postings.count()
    assert searches(spark, merged, rows) == before == searches(spark, grown, rows)
    assert compact_index(spark, root).gen == merged.gen
    last = add_documents(spark.createDataFrame([(500, f"{word(1)} new")], DOCS), root)
    assert last.gens == (merged.gen, last.gen) and last.n_docs == 121


def test_compaction_by_size_keeps_few_generations(spark, rows, tmp_path):
    docs, root = corpus(70), str(tmp_path / "grown")
    build_index(spark.createDataFrame(docs[:40], DOCS), root, n_buckets=4)
    for first in range(40, 70, 10):
        add_documents(spark.createDataFrame(docs[first:first + 10], DOCS), root)
        index = compact_index(spark, root, ratio=1.0)
    sizes = index.commit.sizes
    assert index.gens == (0, 3, 4) and sizes[0] > sizes[1] > sizes[2]
    whole = build_index(spark.createDataFrame(docs, DOCS), str(tmp_path / "whole"), n_buckets=4)
    assert searches(spark, index, rows) == searches(spark, whole, rows)


def test_compaction_that_dies_leaves_the_index(spark, rows, tmp_path, monkeypatch):
    docs, root = corpus(40), str(tmp_path / "grown")
    build_index(spark.createDataFrame(docs[:20], DOCS), root, n_buckets=4)
    grown = add_documents(spark.createDataFrame(docs[20:], DOCS), root)
    before = searches(spark, grown, rows)

    def die(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(build, "write_doc_stats", die)
    with pytest.raises(RuntimeError):
        compact_index(spark, root)
    monkeypatch.undo()
    assert read_index(spark, root).gens == grown.gens and searches(spark, read_index(spark, root), rows) == before
    assert searches(spark, compact_index(spark, root), rows) == before


def test_stream_steps_open_only_new_files(spark, rows, tmp_path, monkeypatch):
    source, inbox, root = (str(tmp_path / n) for n in ("in", "inbox", "index"))
    docs = corpus(90)
    build_index(spark.createDataFrame(docs[:30], DOCS), root, n_buckets=4)
    opened = []
    plain = build.tokenize_documents
    monkeypatch.setattr(build, "tokenize_documents", plain)
    for first in (30, 60):
        spark.createDataFrame(docs[first - 5:first + 30], DOCS).write.mode("append").parquet(source)
        ingest_tokens(stream_documents(spark, source), inbox, str(tmp_path / "log")).awaitTermination()
        index = publish_inbox(spark, inbox, root)
        opened.append({r.file for r in index.table("inbox_log", index.gens[-1:]).collect()})
    assert opened[0] and opened[1] and not opened[0] & opened[1]
    assert publish_inbox(spark, inbox, root).gen == index.gen
    assert compact_index(spark, root).table("inbox_log").count() == len(opened[0] | opened[1])
    merged = publish_inbox(spark, inbox, root)
    assert merged.n_docs == 90
    whole = build_index(spark.createDataFrame(docs, DOCS), str(tmp_path / "whole"), n_buckets=4)
    assert searches(spark, merged, rows) == searches(spark, whole, rows)


# ---- norms clustered by document --------------------------------------------------------

def test_cosine_moves_only_the_sums(spark, tmp_path):
    index = build_index(spark.createDataFrame(corpus(200), DOCS), str(tmp_path / "index"), n_buckets=4)
    queries = spark.createDataFrame([(1, f"{word(1)} {word(2)}")], "query_id bigint, query string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # at any size: no small side
    try:
        text = plan(SearchEngine(body=index).search_body_tfidf(queries, n=5))
    finally:
        spark.conf.set(key, before)
    lines = text.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "norm#" in line)
    assert "Bucketed: true" in lines[at]
    above, level = [], depth[at]
    for i in range(at, -1, -1):  # from the norms up to their join
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
        if above and "Join" in above[-1]:
            break
    assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)


def test_norms_are_found_again_by_another_catalog(spark, rows, tmp_path):
    index = build_index(spark.createDataFrame(corpus(30), DOCS), str(tmp_path / "index"), n_buckets=4)
    want = rows(index.norms)
    spark.sql(f"DROP TABLE {index_store._norms_table(index.root + '/norms/' + index.commit.norms)}")
    assert rows(read_index(spark, index.root).norms) == want and len(want) == 30
