"""Stupid-backoff scores against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from edge import SCHEMA, rows

from envlake.llm import lm


def words(text):
    return (text or "").encode().lower().split()


def brute(table, least):
    """(doc_id, words, backed off, mean) per row of (doc_id, text, fitted)."""
    uni, bi = Counter(), Counter()
    for _, text, fitted in table:
        if fitted:
            uni.update(words(text))
            bi.update(zip(words(text), words(text)[1:], strict=False))
    corpus = max(1, sum(uni.values()))
    found = []
    for doc, text, _ in table:
        own = words(text)
        total, backed = 0.0, 0
        for k, w in enumerate(own):
            share = max(uni[w], 1) / corpus
            if not k:
                total += math.log(share)
            elif bi[own[k - 1], w] >= max(least, 1):
                total += math.log(bi[own[k - 1], w] / uni[own[k - 1]])
            else:
                total, backed = total + math.log(lm.BACKOFF * share), backed + 1
        found.append((doc, len(own), backed, round(total / len(own), 6) if own else None))
    return sorted(found, key=repr)


def scores(frame, *options):
    return sorted(((r.doc_id, r.n_words, r.n_backoff, r.log_score and round(r.log_score, 6)) for r in lm.backoff_scores(frame, *options).collect()), key=repr)


@pytest.mark.parametrize("least", [1, 2])
def test_edge_rows(spark, least):
    table = rows()
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    assert scores(frame, None, least) == brute([(row[0], row[1], True) for row in table], least)


def test_words_that_the_model_lacks(spark, monkeypatch):
    monkeypatch.setattr(lm, "PARTITION_PAIRS", 40)
    monkeypatch.setattr(lm, "FLUSH_WORDS", 50)
    table = [(k, " ".join(f"w{(k * j) % 17}" for j in range(k % 9)), k % 3 != 0) for k in range(200)] + [(900, "never seen w1 w2", False)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string, mine boolean").repartition(4)
    assert scores(frame, "mine", 1) == brute(table, 1)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm.backoff_scores(empty).collect() == []
    frame = spark.createDataFrame([(1, "a b", False)], "doc_id bigint, text string, mine boolean")
    assert scores(frame, "mine") == [(1, 2, 1, round((math.log(1) + math.log(0.4)) / 2, 6))]


def test_hot_words_and_pairs_meet_in_no_single_partition(spark, monkeypatch):
    """One word follows a third of all words, and one pair stands in every document."""
    monkeypatch.setattr(lm, "PARTITION_PAIRS", 1000)
    monkeypatch.setattr(lm, "FLUSH_WORDS", 3000)
    text = lambda k: "so it " + " ".join(f"x{k}_{j} hot y{(k * j) % 50}" for j in range(10)) + " so it"
    table = [(k, text(k), True) for k in range(600)]
    corpus, hashes = sum(len(words(t)) for _, t, _ in table), lm._hash([b"hot", b"so", b"it"])
    frame = spark.createDataFrame([row[:2] for row in table], "doc_id bigint, text string").repartition(4)
    assert scores(frame, None, 2) == brute(table, 2)
    # Dealt as they are sent: no partition gets most of a hot pair, and hot words are passed to none.
    pairs, counts = lm.hot_pair_counts(frame.select("text"), hashes, corpus)
    at = lm._mixed(hashes[1:2], hashes[2:3])[0]
    assert counts[list(pairs).index(at)] == 1200
    of = np.arange(600)
    dealt = lm._dealt(np.repeat(hashes[1:2], 600), np.repeat(hashes[2:3], 600), of, hashes, pairs, 8)
    assert np.bincount(dealt, minlength=8).max() < 150
    monkeypatch.setattr(lm, "_pair_rows", lambda rows: rows)
    u = lm._hash([f"x{k}".encode() for k in range(100)])
    rows = (u, np.repeat(hashes[:1], 100), np.arange(100), np.ones(100, np.int64), np.zeros(100, np.int64), np.arange(100), np.ones(100, np.uint8))
    assert lm._pass_words(hashes, 8, 2, pairs, counts)(rows).empty


def test_pairs_of_many_documents_and_words_stay_apart():
    """Beyond the numbers that documents and pairs fit in together, and below them."""
    draw = np.random.default_rng(3)
    for doc_step, size in ((1, 1 << 20), (1 << 30, 1 << 44)):
        doc = np.sort(draw.integers(0, 5, 400)) * doc_step
        pair = draw.integers(0, 6, 400) * (size // 8)
        of, pairs, n = lm.distinct_pairs(doc, pair, size)
        want = Counter(zip(doc.tolist(), pair.tolist(), strict=True))
        assert list(zip(of.tolist(), pairs.tolist(), strict=True)) == sorted(want)
        assert n.tolist() == [want[key] for key in sorted(want)]
    assert len(lm.distinct_pairs(np.zeros(0, np.int64), np.zeros(0, np.int64), 4)[0]) == 0
