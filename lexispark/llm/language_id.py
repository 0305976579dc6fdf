"""Language identification with a string kernel (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

#: The label of a text without letters.
UNDETERMINED = "und"
#: At most this many training texts of each language are read, chosen by a hash of their id.
SAMPLE_PER_LANGUAGE = 400
#: Slices of a language that are ranked apart first; it changes the work, not the sample.
SLICES = 32
#: Of these, so many are Nyström landmarks.
LANDMARKS_PER_LANGUAGE = 40
#: Character n-grams of 1 to this length are blended.
LONGEST_GRAM = 3
RIDGE = 1e-3
#: A text is in no known language if less of it is known than LEEWAY times what all training texts but this share
#: of them reach.
CLEAN_QUANTILE, LEEWAY = 0.01, 0.6
_BUCKET_BITS = 18
_LETTER = regex.compile(r"\p{L}")
_LETTERS = regex.compile(r"\p{L}+")
_BATCH = 64


def gram_buckets(text: str) -> list[np.ndarray]:
    """Buckets of the character n-grams of a whole text, lower-cased, for each length."""
    chars = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    code = np.zeros(len(chars), np.uint64)
    out = []
    for n in range(1, LONGEST_GRAM + 1):
        if len(chars) < n:
            break
        code = code[:len(chars) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1:] + np.uint64(n)
        out.append((((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64))
    return out


def letter_buckets(text: str) -> np.ndarray:
    """Buckets of the longest grams of the words of letters of a text, with one blank between words."""
    return gram_buckets(" ".join(_LETTERS.findall(text)))[-1]


@dataclass
class LanguageModel:
    """Kernel ridge regression on Nyström landmarks, folded to one weight vector per language.

    ``column`` maps a gram bucket to its column among the grams of the landmarks (0: none). The kernel of
    two texts is the number of grams that both have, over the root of the product of their numbers of
    grams, grams of the landmarks only. ``weights`` are the landmarks' presence rows times
    the regression coefficients, so a batch of texts is scored by one matrix product.

    The answers of a text sum to 1, and one that shares nothing with the landmarks gets the bias, so neither the
    best answer nor its margin says whether any language fits. ``recognised`` asks for something that can
    fail: the share of a text's letter grams that are ``common``, those of the landmarks.
    """

    languages: list[str]
    column: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    common: np.ndarray | None = None
    least: float = 0.0

    def presence(self, texts: list[str]) -> np.ndarray:
        rows = np.zeros((len(texts), len(self.weights)), np.float32)
        for row, text in zip(rows, texts):
            for buckets in gram_buckets(text):
                row[self.column[buckets]] = 1
        rows[:, 0] = 0
        return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))

    def recognised(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Labels, scores, and whether a text is in one of the languages at all."""
        labels, scores = self.predict(texts)
        clear = np.array([label != UNDETERMINED and self.common[letter_buckets(text)].mean() >= self.least
                          for label, text in zip(labels, texts)], bool)
        return labels, scores, clear

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        for at in range(0, len(known) if self.languages else 0, _BATCH):
            rows = known[at:at + _BATCH]
            found = self.presence([texts[i] for i in rows]) @ self.weights + self.bias
            best = found.argmax(1)
            for i, b, s in zip(rows, best, found[np.arange(len(rows)), best]):
                labels[i] = self.languages[b]
                scores[i] = min(max(float(s), 0.0), 1.0)
        return labels, scores


def train(texts: list[str], labels: list[str], landmarks: np.ndarray) -> LanguageModel:
    """Fit the one-versus-rest ridge regressions; ``landmarks`` are rows of ``texts``."""
    languages = sorted(set(labels))
    column = np.zeros(1 << _BUCKET_BITS, np.int32)
    for i in landmarks:
        for buckets in gram_buckets(texts[i]):
            column[buckets] = 1
    used = np.flatnonzero(column)
    column[used] = np.arange(1, len(used) + 1)
    model = LanguageModel(languages, column, np.zeros((len(used) + 1, 1), np.float32), np.zeros(1))
    rows = model.presence(texts).astype(np.float64)
    marks = rows[landmarks]
    values, vectors = np.linalg.eigh(marks @ marks.T)
    good = values > 1e-9 * values.max(initial=1e-300)
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([rows @ marks.T @ whiten, np.ones((len(rows), 1))])
    target = (np.array(labels)[:, None] == np.array(languages)).astype(float)
    share = target / target.sum(0)  # every language weighs the same
    weight = share.sum(1, keepdims=True) / len(languages)
    gram = features.T @ (features * weight)
    gram[np.arange(gram.shape[0] - 1), np.arange(gram.shape[0] - 1)] += RIDGE / len(marks)
    coefficients = np.linalg.lstsq(gram, features.T @ (target * weight), rcond=None)[0]
    model.weights = (marks.T @ (whiten @ coefficients[:-1])).astype(np.float32)
    model.bias = coefficients[-1].astype(np.float32)
    _set_least(model, texts, landmarks)
    return model


def _set_least(model: LanguageModel, texts: list[str], landmarks: np.ndarray) -> None:
    """Set what ``recognised`` asks for from the training texts, each judged as if it were no landmark."""
    grams = [letter_buckets(t) for t in texts]
    holders = np.zeros(1 << _BUCKET_BITS, np.int32)
    for i in landmarks:
        holders[np.unique(grams[i])] += 1
    model.common = holders > 0
    own = np.zeros(len(texts), np.int32)
    own[landmarks] = 1
    model.least = LEEWAY * float(np.quantile([(holders[g] > o).mean() for g, o in zip(grams, own)], CLEAN_QUANTILE))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE) -> LanguageModel:
    """Train on the rows of ``docs`` (doc_id, text, lang) whose text and lang are not null.

    At most ``per_language`` texts of each language are used, a bounded sample by a hash of the id; of
    those the first ``landmarks`` are landmarks. Texts without letters teach nothing. No rows: a
    model that answers ``und``.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "doc_id", "text", "lang", F.xxhash64("text").alias("hash"), F.length("text").alias("size"))
    first = [F.xxhash64("doc_id", "size"), F.col("doc_id"), F.col("hash")]
    # The first of each slice of a language are ranked before the language meets in one task, as SLICES x per_language rows.
    ids = usable.select("doc_id", "lang", "hash", "size").distinct().withColumn("slice", F.pmod(F.xxhash64("hash", "doc_id"), F.lit(SLICES)))
    for keys in (["lang", "slice"], ["lang"]):
        ids = ids.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(
            F.col("rank") <= per_language)
    ids = ids.select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "lang", "hash")], "rank")
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("lang") == F.col("__lang")) & (F.col("hash") == F.col("__hash"))
    # A repeated row is one training text.
    rows = usable.join(F.broadcast(ids), same).groupBy("lang", "rank").agg(F.min("text").alias("text")).collect()
    if not rows:
        return LanguageModel([], np.zeros(1 << _BUCKET_BITS, np.int32), np.zeros((1, 1), np.float32), np.zeros(1))
    rows.sort(key=lambda r: (r["lang"], r["rank"], r["text"]))
    marks = np.flatnonzero([r["rank"] <= landmarks for r in rows])
    return train([r["text"] for r in rows], [r["lang"] for r in rows], marks)


def language(text: Column, model: LanguageModel) -> Column:
    """Column struct<lang, score>: the language of each whole text and the regression's answer, 0 to 1.

    Ties go to the first language by name. A null text, or one without letters, is ``und`` with score 0.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf(StructType().add("lang", "string").add("score", "double"))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            labels, scores = own.predict(batch.tolist())
            yield pd.DataFrame({"lang": labels, "score": scores})

    return predict(text)


def recognised(text: Column, model: LanguageModel) -> Column:
    """Column struct<lang, score, clear>: as ``language``, and whether the text is in one of the languages at all.

    Spark copies a deterministic function into a filter on its result, and would classify each text twice, in two
    Python workers for each task.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf(StructType().add("lang", "string").add("score", "double").add("clear", "boolean"))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            labels, scores, clear = own.recognised(batch.tolist())
            yield pd.DataFrame({"lang": labels, "score": scores, "clear": clear})

    return predict.asNondeterministic()(text)
