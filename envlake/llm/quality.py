"""Quality by regularised quadratic discriminant analysis over statistics of whole texts.

Each class has a mean and a covariance of the transformed statistics. The covariance is
shrunk towards the pooled one, then towards a multiple of the identity. The score of a
text is the posterior probability of class 1: the difference of the two log densities,
whose Mahalanobis distances come from the inverse Cholesky factors that the model keeps.

The model is learned from a sample of labelled rows of about ``FIT_ROWS`` rows at most,
chosen by a hash of the id; sums of products of the statistics are all that leaves the
tasks. Null and empty texts have the statistics of no words and are scored like others.
Labels other than 0 and 1 are passed over, repeated labels count repeatedly. Without
two labelled rows of each class nothing is learned: every score is ``NOTHING_LEARNED``, and
no row is dropped. Scoring an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm.tables import held_out, read_table, small_batches

THRESHOLD = 0.7
NOTHING_LEARNED = 0.5
# Bound of the rows learned from, in expectation.
FIT_ROWS = 40_000
TO_POOLED, TO_IDENTITY = 0.5, 0.05

# Classes of UTF-8 bytes: lower, upper, digit, line end, other space, sentence mark, other mark, lead and trail of longer characters.
LOWER, UPPER, DIGIT, LINE, SPACE, MARK, SYMBOL, LEAD, TRAIL = range(9)
BYTE_CLASS = np.full(256, SYMBOL, np.uint8)
BYTE_CLASS[ord("a") : ord("z") + 1] = LOWER
BYTE_CLASS[ord("A") : ord("Z") + 1] = UPPER
BYTE_CLASS[ord("0") : ord("9") + 1] = DIGIT
BYTE_CLASS[[9, 11, 12, 13, 32]] = SPACE
BYTE_CLASS[10] = LINE
BYTE_CLASS[list(b".,;:?'\"()-")] = MARK
BYTE_CLASS[128:192] = TRAIL
BYTE_CLASS[192:] = LEAD

STATISTICS = (
    "log_words", "log_word_length", "log_word_spread", "upper", "digits", "symbols", "marks", "spaces", "long_characters",
    "variety", "commonest", "short_words", "capitalised", "marked_ends", "bare_marks", "repeated_lines", "log_line_words", "stops",
)


def text_statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text: logarithms of sizes, square roots of shares."""
    text = text or ""
    kinds = np.bincount(BYTE_CLASS[np.frombuffer(text.encode(), np.uint8)], minlength=9)
    characters = max(1, int(kinds.sum() - kinds[TRAIL]))
    letters = max(1, int(kinds[LOWER] + kinds[UPPER] + kinds[LEAD]))
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    ends = [word[-1] for word in words]
    share = lambda part, whole: math.sqrt(part / whole)
    return [
        math.log1p(len(words)),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        share(kinds[UPPER], letters),
        share(kinds[DIGIT], characters),
        share(kinds[SYMBOL], characters),
        share(kinds[MARK], characters),
        share(kinds[SPACE] + kinds[LINE], characters),
        share(kinds[LEAD], characters),
        math.log1p(len(counts)) / math.log1p(n),
        share(max(counts.values(), default=0), n),
        share(int((lengths <= 3).sum()) if words else 0, n),
        share(sum(word[0].isupper() for word in words), n),
        share(sum(not end.isalnum() and end not in ".,;:?'\")" for end in ends), n),
        share(sum(not (word[0].isalnum() or word[-1].isalnum()) for word in words), n),
        share(len(lines) - len(set(lines)), max(1, len(lines))),
        math.log1p(n / max(1, len(lines))),
        share(sum(end in ".?" for end in ends), n),
    ]


@dataclass
class QualityModel:
    """Per class: mean, inverse Cholesky factor of the shrunk covariance, and the constant of its log density."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, statistics: np.ndarray) -> np.ndarray:
        """Posterior probability of class 1 per row."""
        density = [
            constant - 0.5 * (((statistics - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def quality_model(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> QualityModel:
    """Model from counts, sums and sums of products per class."""
    d = sums.shape[1]
    means = sums / counts[:, None]
    own = products / counts[:, None, None] - np.einsum("ki,kj->kij", means, means)
    pooled = np.einsum("k,kij->ij", counts, own) / counts.sum()
    # Statistics have different scales; the identity is taken in units of their pooled variance.
    scale = np.diag(np.diag(pooled) + 1e-6)
    factors, constants = [], []
    for share, covariance in zip(counts / counts.sum(), own, strict=True):
        shrunk = (1 - TO_POOLED) * covariance + TO_POOLED * pooled
        shrunk = (1 - TO_IDENTITY) * shrunk + TO_IDENTITY * scale
        factor = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.solve(factor, np.eye(d)))
        constants.append(math.log(share) - float(np.log(np.diag(factor)).sum()))
    return QualityModel(means, np.array(factors), np.array(constants))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, sums and products per class, one row per entry."""
    d = len(STATISTICS)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            x = np.array(text_statistics(text.as_py()))
            total[label] += np.concatenate([[1.0], x, np.outer(x, x).ravel()])
    label, entry = np.divmod(np.arange(total.size), total.shape[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(label, pa.int32()), pa.array(entry, pa.int32()), pa.array(total.ravel())], ["label", "entry", "value"]
    )


def fit_quality(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel | None:
    """Learn from labelled documents outside the held-out fold; None without two of each class."""
    small_batches(documents.sparkSession)
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    rows = usable.count()
    part = min(1.0, fit_rows / max(rows, 1))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(part * (1 << 30))))
    # At most about fit_rows ids and labels, hence the broadcast.
    marked = F.broadcast(chosen.select(F.col("doc_id").alias("labelled_id"), F.col("quality").cast("int").alias("label")))
    texts = documents.select("doc_id", "text").join(marked, F.col("doc_id") == F.col("labelled_id")).select("text", "label")
    entries = texts.mapInArrow(_moments, "label int, entry int, value double")
    found = entries.groupBy("label", "entry").agg(F.sum("value").alias("value")).collect()  # 2 x 343 numbers
    d = len(STATISTICS)
    total = np.zeros((2, 1 + d + d * d))
    for row in found:
        total[row.label, row.entry] = row.value
    if (total[:, 0] < 2).any():
        return None
    return quality_model(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


def quality_score(model: QualityModel, text: Column) -> Column:
    """Score of a text, 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([text_statistics(one) for one in texts]).reshape(len(texts), -1)))

    return score(text)


def score_documents(documents: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    small_batches(documents.sparkSession)
    score = F.lit(NOTHING_LEARNED) if model is None else quality_score(model, F.col("text"))
    scored = documents.select("doc_id", score.alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_low_quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of documents whose score reaches the threshold, all columns as they were."""
    model = fit_quality(documents, labels)
    if model is None:
        return documents
    small_batches(documents.sparkSession)
    return documents.filter(quality_score(model, F.col("text")) >= threshold)


def op6_quality_qda(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents."""
    documents = read_table(spark, folder, "documents")
    return score_documents(documents, fit_quality(documents, read_table(spark, folder, "labels")))
