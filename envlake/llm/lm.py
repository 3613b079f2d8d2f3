"""Stupid-backoff scores of whole texts, by joins of n-gram count tables.

Words are as in the near-duplicate operator: A to Z lower-cased, cut at white space. The
model counts words and word pairs of the documents it is fitted on, and has them all; a
caller may leave out pairs that occur less than ``least`` times. A pair (u, w) scores c(u w) / c(u) if the model has
it, else 0.4 c(w) / N; the first word of a text scores c(w) / N; a word that the model
lacks counts once. The score of a text is the mean of the natural logarithms over all its
words.

Tables are partitioned by the hash of the leading word. Tasks send the distinct pairs of
their documents to the partition of u, in arrays; there pairs of fitted documents add up to
the count table, which is joined to all pairs and to the word counts. Pairs it lacks go on
to the partition of w for the word counts alone. Words that make up a ``HOT_SHARE`` of the
corpus are at most 1/HOT_SHARE: their counts are known everywhere, their pairs are dealt by
both words, and pairs that lack a model are scored there if their second word is hot. Pairs
that make up a HOT_SHARE are counted before and dealt by the document too. Sums per document follow. Words and pairs are told apart by 64-bit
hashes.

Null and empty texts have no words and a null score. Repeated rows count repeatedly in the
model and are scored each. An empty table gives an empty result; with nothing to fit on,
every word counts once in a corpus of one word.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm.tables import SPACE_CLASS, read_table, small_batches, written

BACKOFF = 0.4
LEAST_PAIRS = 1
HOT_SHARE = 0.001
# Words a task gathers before it sends their pairs on, and pairs per partition of the tables.
FLUSH_WORDS = 1 << 21
PARTITION_PAIRS = 1 << 20

# Pairs of a batch of documents for one partition, sorted by document, as packed arrays: the distinct words u and w and the
# place of each row's word among them, n; per document its number in the batch, its number of rows, and whether the model is
# fitted on it. The keys of a batch's documents go once, under a bucket below zero.
PAIRS = "bucket int, batch bigint, u binary, u_at binary, w binary, w_at binary, n binary, docs binary, rows binary, fitted binary"
ARROW_PAIRS = pa.schema(
    [("bucket", pa.int32()), ("batch", pa.int64()), *((part.split()[0], pa.binary()) for part in PAIRS.split(", ")[2:])]
)
# Words that the level of pairs passes on: per row its word and n, per document its rows; documents as the place of the batch
# among the batches met, and the number in the batch.
PASSED = "bucket int, w binary, n binary, batches binary, batch_at binary, docs binary, rows binary"
# Sums of a batch's documents, as packed arrays: numbers in the batch, sums of logarithms, words; whether they backed off.
SUMS = "batch bigint, docs binary, total binary, words binary, backed boolean"
SCORES = "key bigint, total double, words bigint, backed bigint"


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _hash(words: list[bytes]) -> np.ndarray:
    """As the engine hashes a string."""
    return np.fromiter((xxhash.xxh64_intdigest(word, 42) for word in words), np.uint64, len(words))


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n): hash and count of every word; each task sends a word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            hashes = _hash(list(counts)).view(np.int64)
            found = pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return found

        for batch in batches:
            for text in batch.column(0):
                counts.update(_words(text.as_py()))
            if len(counts) >= FLUSH_WORDS:
                yield out()
        yield out()

    counted = documents.select("text").mapInArrow(run, "word bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _first_word(text: Column) -> Column:
    """Hash of the first word, null without words."""
    first = F.regexp_extract(text, "[^" + SPACE_CLASS[1:-1] + "]+", 0)
    return F.when(first != "", F.xxhash64(F.translate(first, string.ascii_uppercase, string.ascii_lowercase)))


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _numbers(values: np.ndarray) -> np.ndarray:
    """Small numbers in two bytes each, larger ones in four; telling which is left to the number of rows."""
    return values.astype(np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32)


def _unpacked_numbers(data: bytes, rows: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * rows else np.uint32).astype(np.int64)


def _mixed(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes."""
    mixed = (u * np.uint64(0x9E3779B97F4A7C15)) ^ (w + np.uint64(0x632BE59BD9B4E019))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _dealt(u: np.ndarray, w: np.ndarray, of: np.ndarray, hot: np.ndarray, hot_pairs: np.ndarray, buckets: int) -> np.ndarray:
    """Partition of each pair: by u, by both words where u is hot, by the document's number too where the pair is hot."""
    mixed = _mixed(u, w)
    by = np.where(np.isin(u, hot), mixed, u)
    by = np.where(np.isin(mixed, hot_pairs), _mixed(mixed, of.astype(np.uint64)), by)
    return (by % np.uint64(buckets)).astype(np.int64)


def hot_pair_counts(documents: DataFrame, hot: np.ndarray, corpus: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that make up a HOT_SHARE of the corpus, as sorted hashes, and their counts; both words of such a pair are hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[bytes, int] = {}
        hashes = np.zeros(0, np.uint64)
        for batch in batches:
            met = []
            for text in batch.column(0):
                met += [*(place.setdefault(word, len(place)) for word in _words(text.as_py())), -1]
            hashes = np.concatenate([hashes, _hash(list(islice(place, len(hashes), None)))])
            codes = np.array(met, np.int64)
            # Places of no word, between texts, are not hot.
            is_hot = np.append(np.isin(hashes, hot), False)[codes]
            both = is_hot[:-1] & is_hot[1:]
            pairs, n = np.unique(_mixed(hashes[codes[:-1][both]], hashes[codes[1:][both]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n, pa.int64())], ["pair", "n"])
            if len(place) >= FLUSH_WORDS:
                place, hashes = {}, np.zeros(0, np.uint64)

    counted = documents.select("text").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    # Fewer than 1/HOT_SHARE pairs.
    frequent = counted.filter(F.col("n") > corpus * HOT_SHARE).toPandas()
    pairs, n = frequent["pair"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64)
    order = np.argsort(pairs)
    return pairs[order], n[order]


def _runs(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of each run."""
    if not len(sorted_values):
        return []
    begins = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    return list(zip(sorted_values[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(sorted_values)], strict=True))


def distinct_pairs(doc: np.ndarray, pair: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (document, pair) in order and how often each stands there; pairs are numbers below ``size``, documents in order."""
    if not len(doc) or int(doc[-1] + 1) * size < 1 << 62:
        both, n = np.unique(doc * size + pair, return_counts=True)
        return both // size, both % size, n
    # Both in one number would leave 64 bits.
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])])
    return doc[first], pair[first], np.diff(np.r_[first, len(doc)])


def _send_pairs(hot: np.ndarray, hot_pairs: np.ndarray, buckets: int):
    """Distinct pairs of documents (key, fitted, text), per partition of the tables."""

    def flush(place: dict[bytes, int], texts: list[np.ndarray], keys: list[int], fitted: list[bool]) -> Iterator[pa.RecordBatch]:
        hashes, size = _hash(list(place)), max(len(place), 1)
        codes = np.concatenate(texts)
        doc = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
        inside = doc[1:] == doc[:-1]
        of, pairs, n = distinct_pairs(doc[1:][inside], (codes[:-1] * size + codes[1:])[inside], size * size)
        u, w = hashes[pairs // size], hashes[pairs % size]
        to = _dealt(u, w, of, hot, hot_pairs, buckets)
        order = np.argsort(to, kind="stable")
        u, w, of, n = u[order], w[order], of[order], n[order]
        key, fit = np.array(keys, np.int64), np.array(fitted, np.uint8)
        batch = int(np.uint64(xxhash.xxh64_intdigest(key.tobytes())).astype(np.int64))

        def row(bucket: int, columns: list[np.ndarray]) -> pa.RecordBatch:
            packed = [pa.array([_packed(column)], pa.binary()) for column in columns]
            packed += [pa.nulls(1, pa.binary())] * (len(ARROW_PAIRS) - 2 - len(packed))
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([batch], pa.int64()), *packed], schema=ARROW_PAIRS)

        yield row(-1 - batch % buckets, [key])
        for bucket, a, b in _runs(to[order]):
            docs, rows = np.unique(of[a:b], return_counts=True)
            columns = []
            for words in (u[a:b], w[a:b]):
                distinct, at = np.unique(words, return_inverse=True)
                columns += [distinct, _numbers(at)]
            yield row(bucket, [*columns, _numbers(n[a:b]), _numbers(np.diff(docs, prepend=0)), _numbers(rows), fit[docs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[bytes, int] = {}
        texts, keys, fitted, gathered = [], [], [], 0
        for batch in batches:
            for key, fit, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                texts.append(np.array([place.setdefault(word, len(place)) for word in _words(text.as_py())], np.int64))
                keys.append(key)
                fitted.append(fit)
                gathered += len(texts[-1])
                if gathered >= FLUSH_WORDS:
                    yield from flush(place, texts, keys, fitted)
                    place, texts, keys, fitted, gathered = {}, [], [], [], 0
        if gathered:
            yield from flush(place, texts, keys, fitted)

    return run


def _stacked(arrays: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def _pair_rows(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """u, w, document and n of every pair; batch, number in it, and fitted of every document."""
    fitted = [_unpacked(one, np.uint8) for one in rows["fitted"]]
    counts = [_unpacked_numbers(one, len(own)) for one, own in zip(rows["rows"], fitted, strict=True)]
    docs = [np.cumsum(_unpacked_numbers(one, len(own))) for one, own in zip(rows["docs"], fitted, strict=True)]
    sizes = [int(own.sum()) for own in counts]
    words = [
        _stacked([_unpacked(d, np.uint64)[_unpacked_numbers(at, n)] for d, at, n in zip(rows[name], rows[f"{name}_at"], sizes, strict=True)], np.uint64)
        for name in ("u", "w")
    ]
    n = _stacked([_unpacked_numbers(one, size) for one, size in zip(rows["n"], sizes, strict=True)])
    batch = np.repeat(rows["batch"].to_numpy(np.int64), [len(own) for own in fitted])
    counts = _stacked(counts)
    return (*words, np.repeat(np.arange(len(counts)), counts), n, batch, _stacked(docs), _stacked(fitted, np.uint8))


def _looked_up(words: np.ndarray, counts: pd.DataFrame, hot: np.ndarray, hot_counts: np.ndarray) -> np.ndarray:
    """Model count of each word; zero where it has none."""
    known = np.concatenate([counts["word"].to_numpy(np.int64).view(np.uint64), hot])
    n = np.concatenate([counts["n"].to_numpy(np.int64), hot_counts])
    if not len(known):
        return np.zeros(len(words), np.int64)
    order = np.argsort(known)
    known, n = known[order], n[order]
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, n[at], 0)


def _sums(batch: np.ndarray, number: np.ndarray, doc: np.ndarray, logs: np.ndarray, n: np.ndarray, backed: bool) -> pd.DataFrame:
    """Sums per document, a row per batch."""
    named, at = np.unique(doc, return_inverse=True)
    total, words = np.bincount(at, logs * n, len(named)), np.bincount(at, n, len(named)).astype(np.int64)
    batch, number = batch[named], number[named]
    order = np.lexsort((number, batch))
    batch, number, total, words = batch[order], number[order], total[order], words[order]
    rows = [
        (of, *map(_packed, (_numbers(np.diff(number[a:b], prepend=0)), total[a:b], _numbers(words[a:b]))), backed) for of, a, b in _runs(batch)
    ]
    return pd.DataFrame(rows, columns=["batch", "docs", "total", "words", "backed"]).astype({"batch": "int64"})


def _fold_batch(_key: tuple, sums: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """Sums of all partitions for the documents of a batch, by their keys."""
    if not len(keys):
        return pd.DataFrame({"key": [], "total": [], "words": [], "backed": []})
    key = _unpacked(keys["keys"].iloc[0], np.int64)
    total, words, backed = np.zeros(len(key)), np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    for row in sums.itertuples(index=False):
        logs = _unpacked(row.total, np.float64)
        doc, n = np.cumsum(_unpacked_numbers(row.docs, len(logs))), _unpacked_numbers(row.words, len(logs))
        np.add.at(total, doc, logs)
        np.add.at(words, doc, n)
        if row.backed:
            np.add.at(backed, doc, n)
    return pd.DataFrame({"key": key, "total": total, "words": words, "backed": backed})


def _modelled(
    u: np.ndarray, w: np.ndarray, doc: np.ndarray, n: np.ndarray, fitted: np.ndarray, hot_pairs: np.ndarray, hot_pair_counts: np.ndarray
) -> np.ndarray:
    """Occurrences of each pair in the documents fitted on; those of hot pairs, which are dealt to all partitions, are given."""
    if not len(u):
        return np.zeros(0)
    mixed, same = np.unique(_mixed(u, w), return_inverse=True)
    found = np.bincount(same, n * fitted[doc])
    if len(hot_pairs):
        at = np.minimum(np.searchsorted(hot_pairs, mixed), len(hot_pairs) - 1)
        found = np.where(hot_pairs[at] == mixed, hot_pair_counts[at], found)
    return found[same]


def _score_pairs(hot: np.ndarray, hot_counts: np.ndarray, least: int, corpus: int, hot_pairs: np.ndarray, hot_pair_counts: np.ndarray) -> Callable:
    """Level of pairs: sums over the pairs that the model has, and over those it lacks if their second word is hot."""

    def run(_key: tuple, rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        u, w, doc, n, batch, number, fitted = _pair_rows(rows)
        pair_count = _modelled(u, w, doc, n, fitted, hot_pairs, hot_pair_counts)
        has = pair_count >= max(least, 1)
        logs = np.log(pair_count[has] / np.maximum(_looked_up(u[has], counts, hot, hot_counts), 1))
        # Counts of hot words are here; dealt by w, all their pairs would meet in one partition.
        backs = ~has & np.isin(w, hot)
        share = np.maximum(_looked_up(w[backs], counts.head(0), hot, hot_counts), 1) / max(corpus, 1)
        backed = _sums(batch, number, doc[backs], np.log(BACKOFF * share), n[backs], True)
        return pd.concat([_sums(batch, number, doc[has], logs, n[has], False), backed], ignore_index=True)

    return run


def _pass_words(hot: np.ndarray, buckets: int, least: int, hot_pairs: np.ndarray, hot_pair_counts: np.ndarray) -> Callable:
    """The words that the model has no pair for, but for hot ones, dealt by their hash."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        u, w, doc, n, batch, number, fitted = _pair_rows(rows)
        missing = (_modelled(u, w, doc, n, fitted, hot_pairs, hot_pair_counts) < max(least, 1)) & ~np.isin(w, hot)
        w, doc, n = w[missing], doc[missing], n[missing]
        to = (w % np.uint64(buckets)).astype(np.int64)
        # Documents come in the order of their numbers, batch by batch.
        order = np.lexsort((doc, to))
        w, doc, n = w[order], doc[order], n[order]
        out = []
        for bucket, a, b in _runs(to[order]):
            own, per_doc = np.unique(doc[a:b], return_counts=True)
            batches, at = np.unique(batch[own], return_inverse=True)
            out.append((bucket, *map(_packed, (w[a:b], _numbers(n[a:b]), batches, _numbers(at), _numbers(number[own]), per_doc.astype(np.uint32)))))
        return pd.DataFrame(out, columns=["bucket", "w", "n", "batches", "batch_at", "docs", "rows"]).astype({"bucket": "int32"})

    return run


def _score_words(hot: np.ndarray, hot_counts: np.ndarray, corpus: int) -> Callable:
    """Level of words: backed-off logarithms of their shares."""

    def run(_key: tuple, rows: pd.DataFrame, counts_of: pd.DataFrame) -> pd.DataFrame:
        words = [_unpacked(one, np.uint64) for one in rows["w"]]
        n = _stacked([_unpacked_numbers(one, len(own)) for one, own in zip(rows["n"], words, strict=True)])
        batch, number, counts = [], [], []
        for row in rows.itertuples(index=False):
            batches = _unpacked(row.batches, np.int64)
            per_doc = _unpacked(row.rows, np.uint32).astype(np.int64)
            counts.append(per_doc)
            batch.append(batches[_unpacked_numbers(row.batch_at, len(per_doc))])
            number.append(_unpacked_numbers(row.docs, len(per_doc)))
        counts = _stacked(counts)
        w = _stacked(words, np.uint64)
        share = np.maximum(_looked_up(w, counts_of, hot, hot_counts), 1) / max(corpus, 1)
        doc = np.repeat(np.arange(len(counts)), counts)
        return _sums(_stacked(batch), _stacked(number), doc, np.log(BACKOFF * share), n, True)

    return run


def backoff_scores(documents: DataFrame, fitted: str | None = None, least: int = LEAST_PAIRS) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_backoff, log_score.

    The model is fitted on all rows, or on those where the boolean column ``fitted`` holds.
    """
    spark = documents.sparkSession
    small_batches(spark)
    texts = documents.select(
        F.col("doc_id"), (F.coalesce(F.col(fitted), F.lit(False)) if fitted else F.lit(True)).alias("fit"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("key", F.xxhash64(F.col("doc_id"), F.col("fit"), F.col("text")))
    counts = written(word_counts(texts.filter("fit")), "lm-words")
    corpus = counts.agg(F.sum("n")).first()[0] or 0
    # Fewer than 1/HOT_SHARE words.
    frequent = counts.filter(F.col("n") > corpus * HOT_SHARE).toPandas()
    hot, hot_counts = frequent["word"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64)
    order = np.argsort(hot)
    hot, hot_counts = hot[order], hot_counts[order]
    pairs_known = hot_pair_counts(texts.filter("fit"), hot, corpus) if len(hot) else (hot, hot_counts)
    all_rows, fit_rows = (texts.agg(F.count("*"), F.count(F.when(F.col("fit"), 1)))).first()
    buckets = max(1, int(corpus * all_rows / max(fit_rows, 1)) // PARTITION_PAIRS + 1)
    # Unsigned remainder of the hash, as in the arrays.
    high, low = F.shiftrightunsigned("word", 32), F.col("word").bitwiseAND(F.lit(0xFFFFFFFF))
    modulus = F.lit(buckets).cast("bigint")
    bucket = F.pmod(F.pmod(high, modulus) * F.lit((1 << 32) % buckets) + F.pmod(low, modulus), modulus).cast("int")
    table = counts.filter(F.col("n") <= corpus * HOT_SHARE).select(bucket.alias("bucket"), "word", "n")
    by_table = table.repartition(buckets, "bucket")
    sent = texts.select("key", "fit", "text").mapInArrow(_send_pairs(hot, pairs_known[0], buckets), PAIRS).repartition(buckets, "bucket")
    # Equal batches of repeated rows share their number; their sums are added up.
    batches = sent.filter("bucket < 0").select("batch", F.col("u").alias("keys"))
    sent = sent.filter("bucket >= 0")
    pairs = sent.groupBy("bucket").cogroup(by_table.groupBy("bucket"))
    scored = pairs.applyInPandas(_score_pairs(hot, hot_counts, least, corpus, *pairs_known), SUMS)
    passed = sent.groupBy("bucket").applyInPandas(_pass_words(hot, buckets, least, *pairs_known), PASSED).repartition(buckets, "bucket")
    words = passed.groupBy("bucket").cogroup(by_table.groupBy("bucket"))
    rest = words.applyInPandas(_score_words(hot, hot_counts, corpus), SUMS)
    # First words have no pair.
    heads = texts.select("key", _first_word(F.col("text")).alias("word")).filter("word IS NOT NULL")
    log_share = F.log(F.greatest(F.coalesce("n", F.lit(1)), F.lit(1)) / F.lit(float(max(corpus, 1))))
    first = heads.join(counts, "word", "left").select(
        "key", log_share.alias("total"), F.lit(1).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("backed")
    )
    folded = scored.unionByName(rest).groupBy("batch").cogroup(batches.groupBy("batch")).applyInPandas(_fold_batch, SCORES)
    per_key = folded.unionByName(first).groupBy("key").agg(*(F.sum(name).alias(name) for name in ("total", "words", "backed")))
    rows = texts.select("doc_id", "key")
    copies = rows.groupBy("key").agg(F.count("*").alias("copies"))
    scores = copies.join(per_key, "key", "left")
    share = lambda name: F.coalesce(F.col(name) / F.col("copies"), F.lit(0)).cast("bigint")
    return rows.join(
        scores.select("key", share("words").alias("n_words"), share("backed").alias("n_backoff"), F.try_divide("total", "words").alias("log_score")),
        "key",
    ).drop("key")


def op9_stupid_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by the counts of all documents."""
    found = backoff_scores(read_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_backoff", F.round("log_score", 6).alias("log_score"))


OP9_SQL = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS w, unnest(list_prepend(NULL, words[:-2])) AS u FROM docs),
uni AS (SELECT w, count(*) AS c FROM tokens GROUP BY w),
bi AS (SELECT u, w, count(*) AS c FROM tokens WHERE u IS NOT NULL GROUP BY u, w HAVING count(*) >= {LEAST_PAIRS}),
total AS (SELECT count(*) AS n FROM tokens),
scored AS (
  SELECT t.doc_id, t.u IS NOT NULL AND bi.c IS NULL AS backed,
         CASE WHEN t.u IS NULL THEN ln(cw.c / total.n)
              WHEN bi.c IS NOT NULL THEN ln(bi.c / cu.c)
              ELSE ln({BACKOFF} * cw.c / total.n) END AS s
  FROM tokens t JOIN uni cw ON t.w = cw.w LEFT JOIN uni cu ON t.u = cu.w LEFT JOIN bi ON t.u = bi.u AND t.w = bi.w, total),
sums AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE backed) AS n_backoff, avg(s) AS log_score FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backoff, 0) AS n_backoff, round(log_score, 6) AS log_score
FROM docs d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""
