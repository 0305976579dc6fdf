"""Registered queries of the ten operators, and their SQL where DuckDB can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (chunked_bpe, decontaminate, hamming_index, language_id, licenses, mixing, parity_join, quality,
               substring_dedup, suffix_dedup, url_filter, vector_codes, whitening)

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
NEIGHBOURS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for a fifth of all ids; a null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), language_id.language(F.col("text"), model).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.earlier_spans(table(spark, sf_dir, "documents")))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))
    return quality.scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), RULES)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, NEIGHBOURS)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similar_documents(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = chunked_bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.encoded(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_group_error(codes).select(
        "vec_id", vector_codes.hex_code(F.col("entry_ids")).alias("code"), "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_decontamination": op1, "op2_language_id": op2, "op3_suffix_dedup": op3, "op4_substring_dedup": op4,
    "op5_quality": op5, "op6_url_filter": op6, "op7_nearest": op7, "op8_mixing": op8, "op9_licenses": op9,
    "op10_jaccard_join": op10, "op11_bpe": op11, "op12_vector_codes": op12, "op13_whitening": op13, "pipeline": pipeline,
}


def _url_sql() -> str:
    lower = f"translate(coalesce(url, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    hits = lambda terms: " + ".join(f"regexp_matches({lower}, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT" for t in terms)
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered)
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{url_filter.URL_PARTS}', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         coalesce(regexp_extract(url, '{url_filter.URL_PARTS}', 2), '') AS path,
         {hits(url_filter.STRICT_TERMS)} AS n_strict, {hits(url_filter.SOFT_TERMS)} AS n_soft FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN {url_filter.STRICT} * n_strict + {url_filter.SOFT} * n_soft >= {url_filter.LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
       n_strict, n_soft FROM parts"""


_JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
runs AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS s FROM words),
sets AS (SELECT DISTINCT doc_id, s FROM runs),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
ways AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
reach AS (SELECT u AS node, u AS root FROM ways UNION SELECT ways.v, reach.root FROM reach JOIN ways ON reach.node = ways.u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON r.node = d.doc_id"""

_SUBSTRING_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(list_aggregate(w[i:i + 49], 'string_agg', ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM windows) WHERE first < doc_id),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated),
gone AS (SELECT doc_id, list(i) AS gone FROM removed GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(list_aggregate(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, 'string_agg', ' '), '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """SQL for the same rows; the other operators are tested against brute force in ``tests/llm``."""
    return {"op4_substring_dedup": _SUBSTRING_SQL, "op6_url_filter": _url_sql(), "op8_mixing": mixing.mix_sql(),
            "op9_licenses": licenses.scan_sql(), "op10_jaccard_join": _JACCARD_SQL,
            "op12_vector_codes": vector_codes.codes_sql()}
