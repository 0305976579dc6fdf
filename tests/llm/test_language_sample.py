"""The training sample of language identification."""

from lexispark.llm import language_id


def test_slices_do_not_change_the_sample(spark, monkeypatch):
    taught = []
    monkeypatch.setattr(language_id, "train", lambda texts, langs, marks: taught.append((texts, langs, marks.tolist())))
    rows = [(i if i % 7 else None, f"text {i % 40} of", "ab"[i % 3 == 0]) for i in range(300)] * 2 + [(1, "x", None), (2, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    for slices in (1, 32):
        monkeypatch.setattr(language_id, "SLICES", slices)
        language_id.fit(docs, per_language=25, landmarks=5)
    assert taught[0] == taught[1]
    assert [taught[0][1].count(lang) for lang in "ab"] == [25, 25]
