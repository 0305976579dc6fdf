"""The build of an index: tokens counted once, postings in runs, files cut without sampled bounds."""

import random

from pyspark.sql import functions as F

from lexispark.operators.postings import count_tokens, term_bucket
from lexispark.operators.scoring import term_candidates
from lexispark.plans import build
from lexispark.sources import index_store
from lexispark.sources.index_store import write_postings


def test_tokens_in_one_string_are_counted_as_an_array(spark, rows):
    rng = random.Random(5)
    texts = [" ".join(f"t{rng.randrange(30)}" for _ in range(rng.randrange(50))) for _ in range(40)] + ["", None, "ü a ü", "#c++ a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, tokens string").coalesce(1)
    arrays = docs.withColumn("tokens", F.when(F.col("tokens") != "", F.split("tokens", " ")))
    counted = count_tokens(docs, n_buckets=7)
    assert rows(counted, "doc_id", "term", "tf") == rows(count_tokens(arrays)) == rows(count_tokens(docs))
    assert counted.where(F.col("bucket") != term_bucket("term", 7)).isEmpty()
    run = [(r.bucket, r.term.encode(), r.doc_id) for r in counted.collect()]
    assert run == sorted(run)


def test_postings_are_taken_once_and_spread_over_files(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "TASK_POSTINGS", 100)
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    data = [("hot", d, 1, 3) for d in range(900)] + [(f"t{d}", d, 2, 3) for d in range(100)]
    schema = "term string, doc_id bigint, tf bigint, dl bigint"
    postings = spark.createDataFrame(data, schema).mapInArrow(look, schema)
    write_postings(postings, str(tmp_path / "p"), len(data), 4)
    assert seen.value == len(data)  # no pass for the bounds of ranges
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert rows(stored, "term", "doc_id", "tf", "dl") == sorted(data)
    assert stored.where(F.col("bucket") != term_bucket("term", 4)).isEmpty()
    assert stored.where("term = 'hot'").select(F.input_file_name()).distinct().count() == 3  # 1000 rows, 4 buckets, 100 each
    write_postings(postings.limit(0), str(tmp_path / "none"), 0, 4)


def test_equal_rows_are_tokenised_once(spark, rows, tmp_path, monkeypatch):
    seen, whole = [], build.tokenize_documents
    monkeypatch.setattr(build, "tokenize_documents", lambda docs, *args: seen.append(docs.count()) or whole(docs, *args))
    docs = [(1, "java"), (2, "tea pot"), (3, "x"), (None, "null"), (None, "null")]
    build.build_index(spark.createDataFrame(docs[:1], "doc_id bigint, text string"), str(tmp_path / "i"), n_buckets=4)
    seen.clear()
    more = docs * 2 + [(2, "tea"), (4, None), (4, "red blue"), (4, "blue red"), (5, "alone")]
    index = build.add_documents(spark.createDataFrame(more, "doc_id bigint, text string"), str(tmp_path / "i"))
    # Known ids are not tokenised, equal rows once; rows without an id are rows of their own.
    assert sorted(seen) == [5, 6]
    assert sorted(map(str, rows(index.lengths.na.fill(-1)))) == sorted(map(str, [(1, 1), (2, 2), (3, 1), (4, 2), (5, 1)] + [(-1, 1)] * 4))
    assert rows(index.postings.where("doc_id = 4 or doc_id = 2"), "doc_id", "term") == [(2, "pot"), (2, "tea"), (4, "blue"), (4, "red")]


def test_link_candidates_are_merged_behind_the_exchange(spark, rows):
    schema = "query_id bigint, term string, doc_id bigint, df bigint, tf bigint, dl bigint"
    own = spark.createDataFrame([(1, "a", d, 9, 2, 5) for d in range(6)] + [(None, "a", 1, 9, 2, 5)], schema)
    linked = spark.createDataFrame([(1, "a", d, 9, d, None) for d in range(4, 9)] + [(1, "a", 7, 9, 9, None)], schema)
    lengths = spark.createDataFrame([(d, 7) for d in range(8)], "doc_id bigint, dl bigint")
    merged = term_candidates(own, linked, lengths)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # A scan meets no posting twice: sums below the exchange would hold all of its matches.
    assert "Aggregate" not in plan.split("Exchange hashpartitioning(query_id", 1)[1].split("Exchange")[0].split("Scan")[0]
    assert sorted(str(tuple(r)) for r in merged.select("query_id", "doc_id", "tf", "dl").collect()) == sorted(map(str, [
        *[(1, d, 2, 5) for d in range(6)], (None, 1, 2, 5), (1, 6, 6, 7), (1, 7, 9, 7)]))
