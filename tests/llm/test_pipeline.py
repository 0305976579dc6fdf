"""The pipeline's decisions, stage by stage, on the smallest tables."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] == counts[3] >= counts[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == counts[4]
    items = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    kept = [r[0] for r in docs.select("text").collect()]
    assert not any(i in t for i in items for t in kept if t)


def test_unlearned_language(spark):
    clean = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = ["Съешь же ещё этих мягких французских булок, да выпей чаю.", "今日は天気がいいですね", "zzqxj kkwqz xxvq jjqz wwx",
               "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
               "Γνώθι σεαυτόν και μηδέν άγαν " * 2_000, "12 34", "", None]
    more = spark.createDataFrame([(10_000 + i, t, None) for i, t in enumerate(strange)], clean.schema)
    kept = corpus_pipeline.identify(spark, clean.unionByName(more), SF).collect()
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in clean.collect()}
    assert all(r["lang"] in ("en", "fr", "de", "es") for r in kept)


def python_nodes(df):
    """How many nodes of the physical plan run Python."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum(plan.count(node) for node in ("ArrowEvalPython", "InPandas", "MapInArrow"))


def test_one_python_worker_per_task(spark):
    texts = ["the quick brown fox jumps over the lazy dog and runs away from all of them " * 8 + str(i % 3) for i in range(12)]
    docs = corpus_pipeline.stored(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"))
    assert python_nodes(corpus_pipeline.remove_repeats(spark, docs, SF)) == 1  # was 2: the union of the spans and the cut texts
    assert python_nodes(corpus_pipeline.identify(spark, docs, SF)) == 1  # was 2: a filter on the answer had its own
