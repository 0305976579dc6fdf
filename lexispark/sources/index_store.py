"""The stored index: a log of generations of bucketed posting files and statistics tables.

``root/{tokens,postings,term_stats,doc_stats,inbox_log}/gen=K`` hold what one step added, and
``root/corpus_stats/gen=K`` is the commit of step K: one row with the generations that are visible, the
size of each, the norms table and the corpus statistics. It is written last and makes a step
visible: no visible file is ever overwritten, and a job that dies half-way leaves the previous
index intact and is simply run again. An addition writes only what is new; ``plans.compact`` merges
generations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from hashlib import md5
from math import ceil
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark import schemas
from lexispark.operators.postings import N_BUCKETS, posting_lists, term_bucket
from lexispark.operators.splitters import BLOCK_DOCS, id_splitters
from lexispark.operators.statistics import doc_norms, inverse_document_frequency
from lexispark.settings import push_literals

TABLES = {"tokens": schemas.TOKENS, "postings": schemas.POSTINGS, "term_stats": schemas.TERM_STATS,
          "doc_stats": schemas.DOC_STATS, "inbox_log": schemas.INBOX_LOG, "corpus_stats": schemas.CORPUS_STATS}
# Rows of a Parquet page of the term-sorted tables: the unit that a term filter skips.
PAGE_ROWS = 1024
# Postings of a task that sorts them, and the fewest for which it is worth another task.
TASK_POSTINGS, LEAST_POSTINGS = 1_000_000, 50_000
# Documents of one bucket of the norms.
NORM_BUCKET_DOCS = 4_000_000


@dataclass(frozen=True)
class Commit:
    """The one row that makes a state of the index visible."""

    n_docs: int
    sum_dl: int
    n_postings: int
    n_buckets: int
    idf_base: str
    stemming: bool
    gens: tuple[int, ...] = ()         # visible generations, oldest first
    sizes: tuple[int, ...] = ()        # postings of each
    norms: str | None = None           # folder of the norms; None: not computed for this state
    norm_buckets: int = 0


@dataclass(frozen=True)
class InvertedIndex:
    """An opened index: lazy tables plus its one row of corpus statistics."""

    spark: SparkSession
    root: str
    gen: int
    commit: Commit

    def __getattr__(self, name: str):
        """The corpus statistics: n_docs, sum_dl, n_postings, n_buckets, idf_base, stemming, gens."""
        if name in Commit.__dataclass_fields__:
            return getattr(self.commit, name)
        raise AttributeError(name)

    @property
    def base_gen(self) -> int:
        """The oldest generation that is read."""
        return min(self.commit.gens)

    @property
    def avgdl(self) -> float:
        return self.sum_dl / self.n_docs if self.n_docs else 0.0

    def table(self, name: str, gens: Sequence[int] | None = None) -> DataFrame:
        """The visible (or the given) generations of one table."""
        gens = self.commit.gens if gens is None else gens
        return read_table(self.spark, self.root, name, gens).where(F.col("gen").isin(list(gens))).drop("gen")

    def splitters(self, block_docs: int = BLOCK_DOCS) -> list[int]:
        """First ids of even blocks of the documents; one pass over the ids, none over an index of a single block."""
        return id_splitters(self.lengths, self.n_docs, block_docs)

    @property
    def postings(self) -> DataFrame:
        """bucket, term, doc_id, tf, dl"""
        return self.table("postings")

    @property
    def term_stats(self) -> DataFrame:
        """bucket, term, df, term_total, idf; the parts of several generations are added up."""
        return inverse_document_frequency(merged_term_stats(self), self.n_docs, self.idf_base)

    @property
    def lengths(self) -> DataFrame:
        """doc_id, dl of every document."""
        return self.table("doc_stats")

    @property
    def norms(self) -> DataFrame:
        """doc_id, norm of documents with terms: the stored table, or taken over all postings where it is not up to date."""
        if self.commit.norms:
            return read_norms(self.spark, f"{self.root}/norms/{self.commit.norms}", self.norm_buckets)
        return doc_norms(self.postings, self.term_stats, self.n_postings)

    @property
    def doc_stats(self) -> DataFrame:
        """doc_id, dl, norm of every document."""
        return self.lengths.join(self.norms, "doc_id", "left")


def merged_term_stats(index: InvertedIndex, gens: Sequence[int] | None = None) -> DataFrame:
    """bucket, term, df, term_total of the visible (or the given) generations."""
    gens = index.gens if gens is None else gens
    stats = index.table("term_stats", gens)
    if len(gens) == 1:
        return stats
    return stats.groupBy("bucket", "term").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("df", "term_total")])


def write_postings(postings: DataFrame, path: str, n_rows: int, n_buckets: int = N_BUCKETS) -> None:
    """At most ``n_rows`` postings partitioned by bucket and sorted by (term, doc_id), in small pages; their ``bucket`` may be given.

    A task sorts a few buckets, or a slice of the documents of one: about TASK_POSTINGS rows, so one very frequent term is
    spread over several tasks and files. Where a row goes follows from the row: nothing is counted twice to sample bounds.
    """
    if "bucket" not in postings.columns:
        postings = postings.withColumn("bucket", term_bucket("term", n_buckets))
    cores = postings.sparkSession.sparkContext.defaultParallelism
    groups = min(n_buckets, max(ceil(n_rows / TASK_POSTINGS), min(cores, ceil(n_rows / LEAST_POSTINGS)), 1))
    slices = max(ceil(n_rows / (n_buckets * TASK_POSTINGS)), 1)
    task = F.floor(F.col("bucket") * groups / n_buckets) * slices + F.pmod(F.xxhash64("doc_id"), F.lit(slices))
    (postings.repartitionById(groups * slices, task.cast("int")).sortWithinPartitions("bucket", "term", "doc_id").write.mode("overwrite")
     .option("parquet.page.row.count.limit", PAGE_ROWS).partitionBy("bucket").parquet(path))


def write_term_stats(stats: DataFrame, path: str, n_buckets: int = N_BUCKETS) -> None:
    """Term statistics (term, df, term_total) sorted by (bucket, term), in small pages."""
    bucketed = stats.select(term_bucket("term", n_buckets).alias("bucket"), "term", "df", "term_total")
    (bucketed.repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term")
     .write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def write_doc_stats(stats: DataFrame, path: str) -> None:
    """Document lengths (doc_id, dl)."""
    stats.select("doc_id", "dl").write.mode("overwrite").parquet(path)


# ---- norms ------------------------------------------------------------------------------

def _norms_table(location: str) -> str:
    return f"lexispark_norms_{md5(location.encode()).hexdigest()[:16]}"


def write_norms(norms: DataFrame, root: str, n_docs: int) -> tuple[str, int]:
    """Write (doc_id, norm) clustered by document; returns its folder below ``root/norms`` and the number of buckets.

    One file per bucket, sorted: a join by document reads it in place, without an exchange.
    """
    spark = norms.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, folder = max(shuffle, -(-n_docs // NORM_BUCKET_DOCS)), uuid4().hex
    location = f"{root}/norms/{folder}"
    (norms.select("doc_id", "norm").repartition(buckets, "doc_id").write.bucketBy(buckets, "doc_id").sortBy("doc_id")
     .option("path", location).format("parquet").saveAsTable(_norms_table(location)))
    return folder, buckets


def read_norms(spark: SparkSession, location: str, buckets: int) -> DataFrame:
    """The norms at ``location`` as a bucketed table; a session that did not write it enters it in its catalog."""
    name = _norms_table(location)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} (doc_id BIGINT, norm DOUBLE) USING parquet "
                  f"CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(name)


# ---- commits ----------------------------------------------------------------------------

def read_table(spark: SparkSession, root: str, table: str, gens: Sequence[int] | None = None) -> DataFrame:
    """All (or the given) generations of one table, with its fixed schema (an empty table is fine); only their folders are listed."""
    folder = f"{root}/{table}"
    paths = [folder] if gens is None else [f"{folder}/gen={gen}" for gen in gens]
    # Sorted files are skipped by the bounds of their pages; a look into every dictionary would cost more than it saves.
    return spark.read.schema(TABLES[table]).option("basePath", folder).option(
        "parquet.filter.dictionary.enabled", "false").parquet(*paths)


def next_generation(spark: SparkSession, root: str) -> int:
    """The number after the newest commit; 0 where there is no index."""
    try:
        newest = read_table(spark, root, "corpus_stats").agg(F.max("gen")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return 0 if newest is None else newest + 1


def write_commit(spark: SparkSession, root: str, gen: int, commit: Commit) -> InvertedIndex:
    """Make ``commit`` the visible state of the index."""
    values = [getattr(commit, c.split()[0]) for c in schemas.CORPUS_STATS.split(", ")[:-1]]
    row = [list(v) if isinstance(v, tuple) else v for v in values]
    spark.createDataFrame([row], schemas.CORPUS_STATS.rpartition(", ")[0]).write.mode("overwrite").parquet(
        f"{root}/corpus_stats/gen={gen}")
    return read_index(spark, root)


def read_index(spark: SparkSession, root: str) -> InvertedIndex:
    """Open the newest commit below ``root``."""
    push_literals(spark)
    row = read_table(spark, root, "corpus_stats").orderBy(F.desc("gen")).first().asDict()
    gen = row.pop("gen")
    return InvertedIndex(spark, root, gen, Commit(**{k: tuple(v) if isinstance(v, list) else v for k, v in row.items()}))


def with_norms(index: InvertedIndex) -> Commit:
    """The commit of ``index`` with written norms; they are not visible before it is."""
    if index.commit.norms:
        return index.commit
    folder, buckets = write_norms(index.norms, index.root, index.n_docs)
    return replace(index.commit, norms=folder, norm_buckets=buckets)


def refresh_norms(spark: SparkSession, root: str) -> InvertedIndex:
    """Compute the norms of the visible state and commit them.

    The idf of every term moves with the corpus size, so this reads all postings; until it is
    called after an addition, a cosine search takes the norms it needs from the postings itself.
    """
    index = read_index(spark, root)
    return index if index.commit.norms else write_commit(spark, root, next_generation(spark, root), with_norms(index))


# ---- reading ----------------------------------------------------------------------------

def scan_posting_lists(index: InvertedIndex, block_docs: int | None = None, measured: bool = False) -> DataFrame:
    """All posting lists of terms that have statistics; ``measured`` cuts them into blocks of documents, not of the id range."""
    known = index.postings.join(index.term_stats.select("term"), "term", "left_semi")
    if measured:
        return posting_lists(known, splitters=index.splitters(block_docs or BLOCK_DOCS))
    return posting_lists(known, block_docs) if block_docs else posting_lists(known)


def lookup_tokens(index: InvertedIndex, tokens: Sequence[str]) -> DataFrame:
    """Postings of the given tokens; unknown tokens give nothing.

    The buckets are literals of the plan, so only their folders are opened, and the terms
    are pushed to the pages of the term-sorted files.
    """
    tokens = sorted(set(tokens))
    if not tokens:
        return index.postings.limit(0)
    probe = index.spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in tokens])).alias("term"))
    buckets = probe.select(term_bucket("term", index.n_buckets).alias("bucket")).distinct().collect()
    return index.postings.where(
        F.col("bucket").isin([row.bucket for row in buckets]) & F.col("term").isin(tokens))
