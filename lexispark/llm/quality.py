"""Quality score by regularised quadratic discriminant analysis (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import joined, slices, running, word_bounds, byte_values
from .segments import pieces, text_of

#: Share of the pooled covariance in each class covariance, and of a multiple of the identity.
POOLED, SPHERE = 0.15, 0.02

_KIND = np.full(256, 6, np.int64)  # other ASCII signs
_KIND[:32] = 5
_KIND[128:] = 7
for kind, signs in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".,;:'\"-()?")):
    _KIND[list(signs)] = kind
FEATURES = ("bytes words word_length word_spread longest_word lower upper digit space common_sign control "
            "other_sign wide lines distinct_words top_word distinct_lines capitals sign_ends one_letter").split()


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Transformed statistics of joined texts, one row per text: logs of sizes and of shares."""
    n_texts = len(bounds) - 1
    size = np.diff(bounds).astype(float)
    text = np.repeat(np.arange(n_texts), np.diff(bounds))
    kinds = np.bincount(text * 8 + _KIND[data], minlength=8 * n_texts).reshape(n_texts, 8)
    start, end, of_text = word_bounds(data, bounds)
    words = np.diff(of_text).astype(float)
    owner = np.repeat(np.arange(n_texts), np.diff(of_text))
    length = (end - start).astype(float)
    total = lambda x: np.bincount(owner, x, minlength=n_texts)
    some = np.maximum(words, 1)
    mean = total(length) / some
    spread = np.sqrt(np.maximum(total(length ** 2) / some - mean ** 2, 0))
    longest = np.zeros(n_texts)
    np.maximum.at(longest, owner, length)
    prints = slices(running(byte_values(data, bounds)[0]), start, end)
    order = np.lexsort((prints, owner))
    new = np.concatenate([[True], (prints[order][1:] != prints[order][:-1]) | (owner[order][1:] != owner[order][:-1])]) \
        if len(order) else np.empty(0, bool)
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(order)))
    distinct = np.bincount(owner[order[first]], minlength=n_texts)
    top = np.zeros(n_texts)
    np.maximum.at(top, owner[order[first]], times)
    breaks = np.flatnonzero(data == 10)
    lines = np.bincount(text[breaks], minlength=n_texts) + 1.0
    line_bounds = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
    line_bounds = line_bounds[line_bounds < len(data)]
    line_text = text[line_bounds] if len(line_bounds) else line_bounds
    line_end = np.append(line_bounds[1:], len(data))
    line_prints = slices(running(byte_values(data, bounds)[0]), line_bounds, line_end)
    pairs = np.unique(np.stack([line_text.astype(np.uint64), line_prints], 1), axis=0) if len(line_bounds) else np.empty((0, 2))
    kept_lines = np.bincount(pairs[:, 0].astype(np.int64), minlength=n_texts)
    capitals = total(_KIND[data[start]] == 1)
    sign_ends = total(_KIND[data[end - 1]] == 6)
    share = lambda x, of: np.log((x + 0.02) / (np.maximum(of, 1) + 1))
    columns = [np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(spread), np.log1p(longest),
               *(share(kinds[:, k], size) for k in range(8)), share(lines, words), share(distinct, words),
               share(top, words), share(kept_lines, lines), share(capitals, words), share(sign_ends, words),
               share(total(length == 1), words)]
    return np.stack(columns, 1)


@dataclass
class QualityModel:
    """Class means, cached inverse Cholesky factors and log densities' constants; class 0 first."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of class 1: the logistic of the difference of the two log densities."""
        if not len(self.mean):
            return np.full(len(features), 0.5)
        log_density = [c - 0.5 * (((features - m) @ w.T) ** 2).sum(1)
                       for m, w, c in zip(self.mean, self.whiten, self.constant)]
        return 1 / (1 + np.exp(np.clip(log_density[0] - log_density[1], -500, 500)))


def train(count: np.ndarray, total: np.ndarray, product: np.ndarray) -> QualityModel:
    """Fit from the moments of the two classes: rows, sums and sums of outer products."""
    if (count < 2).any():
        return QualityModel(np.empty((0, 0)), np.empty((0, 0)), np.empty(0))
    mean = total / count[:, None]
    cov = product / count[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = np.tensordot(count, cov, 1) / count.sum()
    shift = total.sum(0) / count.sum()
    overall = product.sum(0) / count.sum() - np.outer(shift, shift)
    scale = np.maximum(np.diag(overall), 1e-6)
    whiten, constant = [], []
    for k in range(2):
        own = (1 - POOLED) * cov[k] + POOLED * pooled
        own = (1 - SPHERE) * own + SPHERE * np.diag(scale)
        root = np.linalg.cholesky(own)
        whiten.append(np.linalg.inv(root))
        constant.append(np.log(count[k] / count.sum()) - np.log(np.diag(root)).sum())
    return QualityModel(mean, np.array(whiten), np.array(constant))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for piece in pieces(batch):
            yield piece, statistics(*joined(text_of(piece)))


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Train on all rows of ``labels`` (doc_id, quality 0 or 1) that have a document in ``docs``.

    Only the features move, not the texts; class counts, sums and outer products are summed on the
    cluster, and only these few numbers reach the driver. Labels that are null, or of no document, teach
    nothing; without two rows of each class every score is 0.5.
    """
    d = len(FEATURES)

    def measure(batches):
        for piece, found in _features(batches):
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(list(found), pa.list_(pa.float64()))],
                                             names=["doc_id", "features"])

    def moments(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            features = np.array(batch.column(0).to_pylist(), float).reshape(-1, d)
            quality = batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = features[quality == k]
                sums[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))],
                                         names=["quality", "sums"])

    found = _texts(docs).where(F.col("doc_id").isNotNull()).mapInArrow(measure, "doc_id bigint, features array<double>")
    known = labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = (found.join(known, "doc_id").select("features", "quality").mapInArrow(moments, "quality int, sums array<double>")
            .select("quality", F.posexplode("sums").alias("at", "value")).groupBy("quality", "at")
            .agg(F.sum("value").alias("value")).collect())
    sums = np.zeros((2, 1 + d + d * d))
    for row in rows:
        sums[row["quality"], row["at"]] = row["value"]
    return train(sums[:, 0], sums[:, 1:d + 1], sums[:, d + 1:].reshape(2, d, d))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every document, 0 to 1, from its whole text.

    A null text is scored as an empty one; repeated rows give repeated rows; a null id is kept; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for piece, found in _features(batches):
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(shared.value.score(found))], names=["doc_id", "score"])

    return _texts(docs).mapInArrow(score, "doc_id bigint, score double")
