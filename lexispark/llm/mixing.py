"""Mixing sources to target weights by entropy balancing (operator 8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lexispark.operators.skew import number_rows
from lexispark.settings import broadcast_if_small

from .tables import WORD, stored

#: Weights of the sources in code point order, repeating, and the share of all words to take.
WEIGHTS, TOTAL_SHARE, MOST_REPEATS = (3, 1, 2), 1.5, 2.0
_NEWTON_STEPS = 60


def sized(docs: DataFrame, *columns: str) -> DataFrame:
    """The documents with ``size``, the number of words of the whole text (null: 0)."""
    return docs.select(*columns, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 in code point order, null last, in range partitions."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stored(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn("inside", inside).join(offsets, "part").select(
        "source", "source_size", (F.col("inside") + F.col("offset") - 1).alias("number"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = TOTAL_SHARE,
                   most: float = MOST_REPEATS) -> DataFrame:
    """(source, number, source_size, target): words to take of each source.

    Sources share ``share`` of all words by weight; a target stops at ``most`` times its source,
    and the excess is shared anew. The shares are least(most * size, level * weight); the level rises
    until all words are given, each round one sum over the table of sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    rows = stored(_numbered(sources).withColumn("weight", pick))
    cap = F.col("source_size") * F.lit(most)
    level, last = 0.0, None
    while level != last:
        last = level
        full = cap < F.col("weight") * F.lit(level)
        everything, given, weight = rows.agg(
            F.sum("source_size"), F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not everything or not weight:
            break
        level = max(level, (everything * share - given) / weight)
    return rows.select("source", "number", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def balanced_rates(targets: DataFrame) -> DataFrame:
    """The targets with ``rate``, how often each word of a source is taken.

    Entropy balancing: of all rates r per word with sum(size * r) = target for each source, those
    closest to 1, by sum(size * (r log r - r + 1)), are r = exp(l), with l the minimum of the
    convex dual source_size * exp(l) - target * l. The constraints share no document, so the Hessian
    is diagonal: Newton's iteration runs for all sources at once, on sums made on the cluster.
    """
    size, target = F.col("source_size").cast("double"), F.col("target")
    step = F.aggregate(F.sequence(F.lit(1), F.lit(_NEWTON_STEPS)), F.lit(0.0),
                       lambda l, _: l - (size * F.exp(l) - target) / (size * F.exp(l)))
    rate = F.when((size > 0) & (target > 0), F.round(F.exp(step), 12)).otherwise(0.0)
    return targets.withColumn("rate", rate)


def _evened(placed: DataFrame) -> DataFrame:
    """``placed`` with ``taken``: its copies, and what a source then lacks or has too much, in words of its largest documents.

    From the last place down, each document takes or gives what it can until the source holds its target; sums of
    pieces of one size and hash slice are added up before places inside of them.
    """
    first = F.col("copies") * F.col("size")
    lack = placed.groupBy("number").agg((F.floor(F.max("target") + F.lit(1e-6)) - F.sum(first)).alias("lack"))
    most = F.floor(F.lit(MOST_REPEATS) * F.col("size"))
    rows = placed.join(broadcast_if_small(lack), "number").withColumn(
        "room", F.when(F.col("lack") > 0, most - first).otherwise(first)).withColumn("slice", F.substring("key", 1, 2))
    piece = ["number", "size", "slice"]
    above = Window.partitionBy("number").orderBy(F.desc("size"), F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*piece).agg(F.sum("room").alias("held")).select(
        *piece, F.coalesce(F.sum("held").over(above), F.lit(0)).alias("above"))
    inside = Window.partitionBy(*piece).orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("inside", F.coalesce(F.sum("room").over(inside), F.lit(0))).join(offsets, piece)
    moved = F.least("room", F.greatest(F.abs("lack") - F.col("above") - F.col("inside"), F.lit(0)))
    return summed.withColumn("taken", (first + F.signum("lack") * moved).cast("bigint"))


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, part_words, taken) of every document.

    ``copies`` are whole copies and ``part_words`` the first words of one more; ``taken`` counts the words of all.
    The documents of a source are ordered by size, then by a hash of the id, and the i-th is taken floor(i * rate + u)
    - floor((i - 1) * rate + u) times, u from a hash of the source's number: its rate rounded down or up, the
    error carried on to documents of like size. Any run of neighbours is off by less than one copy, so by partial sums
    a source is off its target by less than the size of its largest document, whatever the number of
    documents. The largest even that out by words (``_evened``). Reruns agree; no document exceeds MOST_REPEATS
    times its size. Places in the order are counted in pieces of one size and hash slice.

    Defined cases: null or empty texts have size 0, and no words; a null source is a source, the
    last one; rows that share an id stand side by side if their sizes agree, a null id has its place too; other
    columns are ignored; no rows, no result.
    """
    sizes = stored(sized(docs, "doc_id", "source"))
    rates = broadcast_if_small(stored(balanced_rates(source_targets(sizes)))).withColumnRenamed("source", "of")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    joined = sizes.join(rates, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("key", key)
    placed = number_rows(joined, ["number"], [F.col("size"), F.substring("key", 1, 2)], [F.col("key")], "place")
    shift = F.conv(F.substring(F.md5(F.col("number").cast("string")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    copies = F.floor(F.col("rate") * F.col("place") + shift) - F.floor(F.col("rate") * (F.col("place") - 1) + shift)
    taken = _evened(stored(placed.withColumn("copies", copies.cast("bigint"))))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("bigint")
    return taken.withColumn("copies", whole).withColumn("part_words", F.col("taken") - F.col("copies") * F.col("size")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", "part_words", "taken")


def mix_sql() -> str:
    """doc_id, size, source_size, target, taken in DuckDB SQL over ``documents``."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM sources),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(number % 3 + 1)::INT]::DOUBLE AS weight FROM numbered),
ordered AS (
  SELECT *, 2.0 * source_size / weight AS ratio, sum(2.0 * source_size) OVER up AS full_size, sum(weight) OVER up AS full_weight,
         sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
  FROM weighed WINDOW up AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
level AS (
  SELECT min_by(level, full_weight) FILTER (WHERE level <= ratio) AS level FROM (
    SELECT *, (1.5 * words - (full_size - 2.0 * source_size)) / (weights - (full_weight - weight)) AS level FROM ordered)),
targets AS (
  SELECT source, number, source_size, least(2.0 * source_size, level * weight)::DOUBLE AS target FROM weighed, level),
rates AS (
  SELECT *, ('0x' || substring(md5(number::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift, CASE WHEN source_size > 0 THEN round(target / source_size, 12) ELSE 0 END AS rate FROM targets),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, md5(coalesce(doc_id::VARCHAR, ''))) AS place FROM sized),
copied AS (
  SELECT d.doc_id, d.source, d.size, d.place, r.number, r.source_size, r.target,
         (d.size * (floor(r.rate * d.place + r.shift) - floor(r.rate * (d.place - 1) + r.shift)))::BIGINT AS first
  FROM placed d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
lacking AS (
  SELECT *, (floor(target + 1e-6) - sum(first) OVER (PARTITION BY number))::BIGINT AS lack FROM copied),
rooms AS (
  SELECT *, CASE WHEN lack > 0 THEN 2 * size - first ELSE first END AS room FROM lacking),
summed AS (
  SELECT *, coalesce(sum(room) OVER (PARTITION BY number ORDER BY place DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM rooms)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (first + sign(lack) * least(room, greatest(abs(lack) - above, 0)))::BIGINT AS taken
FROM summed"""
