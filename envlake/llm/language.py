"""Language of whole texts by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every run of other characters than letters becomes one space, and
the n-grams of one to three characters are hashed to ``BUCKETS``. The model is a matrix of
log probabilities, a row per bucket and a column per language; a batch of texts is scored
by gathering the rows of all its n-grams and adding them up per text.

The model is learned from a sample of about ``FIT_ROWS`` rows at most, chosen by a hash
of the id. N-grams overlap, so the evidence of a text is divided by the number of orders
before it becomes a probability, and counts as that of ``EVIDENCE`` n-grams at most.

The language is ``und`` with score 0 if a text is null or has no letter. Ties go to the
language first in binary order. Repeated rows are scored each, an empty table gives an
empty result. Where no text has a language to learn, every language is ``und`` with score
0, and no row is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm.tables import held_out, read_table, small_batches

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
FIT_ROWS = 40_000
EVIDENCE = 300
GATHERED = 1 << 18
# The matrix takes BUCKETS times this many numbers at most.
MAX_LANGUAGES = 1000
UNKNOWN = "und"
MIN_SCORE = 0.3

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Lower-cased code point of every letter, a space for all else; made once per process."""
    if not _letters:
        table = np.full(0x110000, 32, np.uint32)
        for point in range(0x110000):
            one = chr(point)
            if one.isalpha():
                low = one.lower()
                table[point] = ord(low[0]) if low else point
        _letters.append(table)
    return _letters[0]


def text_grams(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of a text; empty if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    points = np.concatenate([[32], _letter_table()[points], [32]]).astype(np.uint64)
    points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
    if len(points) < 2:
        return np.empty(0, np.int64)
    found = []
    for order in ORDERS:
        mixed = np.full(max(0, len(points) - order + 1), order, np.uint64)
        for k in range(order):
            mixed = (mixed ^ points[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        found.append(mixed % np.uint64(BUCKETS))
    return np.concatenate(found).astype(np.int64)


@dataclass
class LanguageModel:
    """Languages in binary order and the log probabilities (bucket, language)."""

    languages: list[str]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        grams = [text_grams(text) for text in texts]
        sizes = np.array([len(one) for one in grams], np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(texts):
            # Rows of the matrix are gathered for a bounded number of n-grams, or one text, at a time.
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + GATHERED, "right")))
            own = np.flatnonzero(sizes[begin:end]) + begin
            if len(own):
                # Sparse rows: n-grams of the texts, and where each text begins.
                starts = np.concatenate([[0], np.cumsum(sizes[own])[:-1]])
                total[own] = np.add.reduceat(self.weights[np.concatenate([grams[k] for k in own])], starts, axis=0, dtype=np.float64)
            begin = end
        evidence = total * (np.minimum(sizes, EVIDENCE) / np.maximum(sizes, 1) / len(ORDERS))[:, None]
        chance = np.exp(evidence - evidence.max(axis=1, keepdims=True, initial=-np.inf))
        chance /= np.maximum(chance.sum(axis=1, keepdims=True), 1e-300)
        best = total.argmax(axis=1)
        named = [self.languages[b] if size else UNKNOWN for b, size in zip(best.tolist(), sizes.tolist(), strict=True)]
        return named, np.where(sizes > 0, chance[np.arange(len(texts)), best], 0.0)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (lang, bucket, n) of a task, zeros left out."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            own += np.bincount(text_grams(text.as_py()), minlength=BUCKETS)
    for lang, own in counts.items():
        (buckets,) = own.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(buckets), pa.string()), pa.array(buckets, pa.int32()), pa.array(own[buckets])],
            ["lang", "bucket", "n"],
        )


def fit_language(documents: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Learn from documents with a language outside the held-out fold."""
    small_batches(documents.sparkSession)
    part = min(1.0, fit_rows / max(documents.count(), 1))
    usable = documents.filter(F.col("lang").isNotNull() & ~held_out())
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(part * (1 << 30))))
    counted = chosen.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(_gram_counts, "lang string, bucket int, n bigint")
    entries = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # Bounded by languages times buckets; the limit only guards that bound.
    found = entries.limit(MAX_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(found["lang"].unique(), key=lambda name: name.encode())
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"More than {MAX_LANGUAGES} languages.")
    counts = np.zeros((BUCKETS, len(languages)))
    place = {name: k for k, name in enumerate(languages)}
    counts[found["bucket"], found["lang"].map(place)] = found["n"]
    weights = np.log(counts + SMOOTHING) - np.log((counts + SMOOTHING).sum(axis=0))
    return LanguageModel(languages, weights.astype(np.float32))


def language_of(model: LanguageModel, spark: SparkSession, text: Column) -> Column:
    """Struct of lang_pred and score; the matrix is sent to every executor once."""
    shared = spark.sparkContext.broadcast((model.languages, model.weights))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        named, scores = LanguageModel(*shared.value).predict(texts.tolist())
        return pd.DataFrame({"lang_pred": named, "score": scores})

    return predict(text)


def predict_documents(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    small_batches(documents.sparkSession, 512)
    found = documents.select("doc_id", language_of(model, documents.sparkSession, F.col("text")).alias("found"))
    return found.select("doc_id", held_out().alias("held_out"), "found.lang_pred", "found.score")


def drop_unknown_language(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of documents with a language predicted at ``min_score`` or more, all columns as they were."""
    model = fit_language(documents)
    if not model.languages:
        return documents
    small_batches(documents.sparkSession, 512)
    return documents.filter(language_of(model, documents.sparkSession, F.col("text")).getField("score") >= min_score)


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents."""
    documents = read_table(spark, folder, "documents")
    return predict_documents(documents, fit_language(documents))
