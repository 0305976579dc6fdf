"""Rebuilding and repeated ids: an opened index is one index, never a mix."""

import pytest

from lexispark.plans import build
from lexispark.plans.build import add_documents, build_anchor_index, build_index
from lexispark.sources.index_store import read_index

DOCS = "doc_id bigint, text string"


def state(index, rows):
    return (index.n_docs, index.sum_dl, index.n_postings, rows(index.postings, "term", "doc_id", "tf"),
            rows(index.doc_stats, "doc_id", "dl"), rows(index.term_stats, "term", "df"))


def test_rebuild_opens_only_the_new_documents(spark, rows, tmp_path):
    root = str(tmp_path / "index")
    build_index(spark.createDataFrame([(1, "java tea"), (2, "tea")], DOCS), root)
    add_documents(spark.createDataFrame([(3, "java")], DOCS), root)
    new = spark.createDataFrame([(10, "ruby"), (11, "perl perl")], DOCS)
    fresh = state(build_index(new, str(tmp_path / "fresh")), rows)
    assert state(build_index(new, root), rows) == fresh
    assert state(read_index(spark, root), rows) == fresh
    grown = add_documents(spark.createDataFrame([(1, "tea"), (10, "ruby")], DOCS), root)
    assert rows(grown.doc_stats, "doc_id", "dl") == [(1, 1), (10, 1), (11, 2)]


def test_rebuild_that_dies_leaves_the_old_index(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    before = state(build_index(spark.createDataFrame([(1, "java tea")], DOCS), root), rows)

    def die(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(build, "write_doc_stats", die)
    with pytest.raises(RuntimeError):
        build_index(spark.createDataFrame([(5, "other words")], DOCS), root)
    monkeypatch.undo()
    assert state(read_index(spark, root), rows) == before
    assert rows(build_index(spark.createDataFrame([(6, "ruby")], DOCS), root).postings, "term", "doc_id") == [("ruby", 6)]


def test_repeated_ids_count_once(spark, rows, tmp_path):
    root = str(tmp_path / "index")
    build_index(spark.createDataFrame([(1, "java tea"), (2, "tea"), (2, "tea tea")], DOCS), root)
    index = add_documents(spark.createDataFrame([(3, "java"), (3, "java"), (2, "x"), (4, "tea")], DOCS), root)
    assert index.n_docs == 4
    assert rows(index.doc_stats, "doc_id", "dl") == [(1, 2), (2, 2), (3, 1), (4, 1)]
    assert rows(index.term_stats, "term", "df") == [("java", 2), ("tea", 3)]


def test_anchor_rebuild(spark, rows, tmp_path):
    root, schema = str(tmp_path / "anchors"), "source_id bigint, pos int, doc_id bigint, text string"
    build_anchor_index(spark.createDataFrame([(1, 0, 7, "old words")], schema), root)
    index = build_anchor_index(spark.createDataFrame([(1, 0, 8, "ruby")], schema), root)
    assert rows(index.postings, "term", "doc_id") == [("ruby", 8)] and rows(index.doc_stats, "doc_id") == [(8,)]
