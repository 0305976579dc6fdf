"""Frequencies of words for their vectors: taken from the body index where it is built."""

import pytest

from catalog import fixtures as fx


@pytest.mark.parametrize("ids", [[1, 2, 3, None, None, 4], [1, 2, 2, None, None, 2]])
def test_frequencies_come_from_the_index(spark, rows, tmp_path, monkeypatch, ids):
    texts = ["java tea tea", "tea pot", "tea cup cup cup", "java", "java", None]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "vec_id bigint, embedding array<double>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    counted, whole = [], fx.count_words
    monkeypatch.setattr(fx, "count_words", lambda docs, *args: counted.append(docs.count()) or whole(docs, *args))
    frequencies, vectors = rows(fx.term_frequencies(spark, str(tmp_path))), rows(fx.word_vectors(spark, str(tmp_path)))
    assert frequencies == [("cup", 1), ("java", 3), ("pot", 1), ("tea", 3)] and counted == [6, 6]
    fx.body_index(spark, str(tmp_path))
    counted.clear()
    assert rows(fx.term_frequencies(spark, str(tmp_path))) == frequencies
    assert rows(fx.word_vectors(spark, str(tmp_path))) == vectors
    # Texts are counted once: only rows that share an id are counted again.
    assert counted == ([] if ids[1] != ids[2] else [3, 3])
