"""Column layouts shared by readers, index tables and operators."""

from __future__ import annotations

from pyspark.sql import types as T

ANCHOR = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
])

CORPUS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("anchor_text", T.ArrayType(ANCHOR)),
])

PAGE_RANK = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("page_rank", T.DoubleType()),
])

QRELS_OBJECT = T.MapType(T.StringType(), T.ArrayType(T.LongType()))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
])

# Tables of a stored index, partition columns last.
# The tokens of a document are one string, blanks between them: far cheaper to write and to hand to Python than an array.
TOKENS = "doc_id bigint, dl bigint, n_tokens bigint, tokens string, gen int"
INBOX = "doc_id bigint, dl bigint, tokens array<string>"
POSTINGS = "term string, doc_id bigint, tf bigint, dl bigint, gen int, bucket int"
TERM_STATS = "bucket int, term string, df bigint, term_total bigint, gen int"
DOC_STATS = "doc_id bigint, dl bigint, gen int"
INBOX_LOG = "file string, gen int"
CORPUS_STATS = ("n_docs bigint, sum_dl bigint, n_postings bigint, n_buckets int, idf_base string, stemming boolean, "
                "gens array<int>, sizes array<bigint>, norms string, norm_buckets int, gen int")
