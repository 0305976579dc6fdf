import gzip
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexispark.operators.matching import inspect_batch, lookup_postings, lookup_statistics, match_terms
from lexispark.plans.build import build_index
from lexispark.plans.search import SearchEngine
from lexispark.settings import small_enough, work_dir
from lexispark.sources import readers
from lexispark.sources.index_store import lookup_tokens
from lexispark.streaming.ingest import ingest_tokens, publish_inbox, stream_documents

DOCS = [(i, f"java word{i % 7} w{i} python{i % 3}") for i in range(60)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    return build_index(docs, str(tmp_path_factory.mktemp("store")), n_buckets=16)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# ---- readers ----------------------------------------------------------------------------

def test_readers(spark, tmp_path, rows):
    corpus = spark.createDataFrame([(1, "A", "text a"), (2, "B", "text b"), (3, "C", "text c")],
                                   "id bigint, title string, text string")
    corpus.where("id < 3").write.parquet(str(tmp_path / "a"))
    corpus.where("id = 3").write.parquet(str(tmp_path / "b"))
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    df = readers.read_corpus(spark, paths, "text")
    assert rows(df) == [(1, "text a"), (2, "text b"), (3, "text c")]
    assert "title" not in formatted(df).split("ReadSchema")[1]
    assert readers.count_documents(df).first()[0] == 3
    assert rows(readers.read_corpus_sample(spark, paths, n=2), "doc_id") == [(1,), (2,)]
    assert rows(readers.read_titles(spark, paths)) == [(1, "A"), (2, "B"), (3, "C")]

    with gzip.open(tmp_path / "pr.csv.gz", "wt") as f:
        f.write("1,0.5\n2,1.25\n")
    assert rows(readers.read_page_rank(spark, str(tmp_path / "pr.csv.gz"))) == [(1, 0.5), (2, 1.25)]

    labels = {"first query": [5, 3], "zweite": [7]}
    want = [("first query", 0, 5), ("first query", 1, 3), ("zweite", 0, 7)]
    (tmp_path / "one.json").write_text(json.dumps(labels))
    (tmp_path / "pretty.json").write_text(json.dumps(labels, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({q: d}) for q, d in labels.items()))
    assert rows(readers.read_qrels(spark, str(tmp_path / "one.json"))) == want
    assert rows(readers.read_qrels(spark, str(tmp_path / "lines.json"))) == want
    assert rows(readers.read_qrels(spark, str(tmp_path / "pretty.json"), multiline=True)) == want


def test_work_folder_comes_from_the_session(spark):
    assert work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=spark.sparkContext)
    assert work_dir(unset) == work_dir(unset) != work_dir(spark)
    assert small_enough(spark.range(10), 10) and not small_enough(spark.range(11), 10)


# ---- index access and plans -------------------------------------------------------------

def test_lookup_reads_only_the_buckets_of_its_tokens(index):
    found = lookup_tokens(index, ["word3", "missing", "word3"])
    assert sorted(r.doc_id for r in found.collect()) == [i for i in range(60) if i % 7 == 3]
    text = formatted(found)
    assert "bucket" in text.split("PartitionFilters:")[1].split("\n")[0]
    assert "term" in text.split("PushedFilters:")[1].split("\n")[0]
    assert lookup_tokens(index, []).count() == 0


def test_search_plan_has_no_python_and_prunes(spark, index):
    queries = spark.createDataFrame([(1, "java word3"), (2, "python1")], "query_id bigint, query string")
    text = plan(SearchEngine(body=index).search_body_bm25(queries, n=5))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "WindowGroupLimit" in text
    assert "PartitionFilters: [isnotnull(gen" in text and "bucket" in text.split("PartitionFilters")[1]
    # One exchange for the scores, one for the top-N; the postings themselves are not shuffled.
    assert text.count("Exchange hashpartitioning(query_id") == 3


def test_large_batches_join_without_a_broadcast_of_the_terms(spark, index, rows):
    terms = spark.createDataFrame([(1, "java"), (1, "word3"), (2, "python1")], "query_id bigint, term string")
    batch = inspect_batch(terms, index.n_buckets)
    assert batch.small and batch.n_queries == 2
    large = type(batch)(batch.n_queries, False, batch.n_buckets, batch.buckets)
    columns = ["query_id", "term", "doc_id", "tf", "dl", "df"]
    matched = lookup_postings(index, lookup_statistics(index, terms, large), large)
    assert rows(matched, *columns) == rows(match_terms(index, terms), *columns)


def test_postings_are_sorted_inside_a_file(index):
    files = index.postings.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"))
    by_file = {}
    for r in files.orderBy("n").collect():
        by_file.setdefault(r.file, []).append((r.term, r.doc_id))
    assert len(by_file) >= 10 and all(v == sorted(v) for v in by_file.values())


# ---- streaming --------------------------------------------------------------------------

def test_stream_equals_batch_and_a_rerun_adds_nothing(spark, index, tmp_path, rows):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    source, inbox, root = (str(tmp_path / n) for n in ("in", "inbox", "index"))

    def ingest():
        ingest_tokens(stream_documents(spark, source), inbox, str(tmp_path / "log")).awaitTermination()

    docs.where("doc_id < 25").write.parquet(source)
    ingest()
    publish_inbox(spark, inbox, root, first=True, n_buckets=16)
    docs.where("doc_id >= 25").write.mode("append").parquet(source)
    ingest()
    grown = publish_inbox(spark, inbox, root)
    ingest()
    assert publish_inbox(spark, inbox, root).gen == grown.gen == 1
    for table in ("postings", "term_stats", "doc_stats"):
        columns = sorted(getattr(index, table).columns)
        assert rows(getattr(grown, table), *columns) == rows(getattr(index, table), *columns)
