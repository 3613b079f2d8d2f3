"""Ranked search against a plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from edge import SCHEMA, rows

from envlake.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, k):
    """item -> [(doc_id, score)], highest first."""
    counted = [(i, Counter(terms(t))) for i, t in documents if terms(t)]
    n_docs, words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    found = {}
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t]
            )
            if score > 0:
                scores.append((i, score))
        found[item] = sorted(scores, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]
    return found


def by_item(found):
    out = {}
    for r in sorted(found, key=lambda r: (str(r.item_id), r.rank)):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


def check(spark, documents, items, k=20):
    frame = spark.createDataFrame(documents, SCHEMA)
    asked = spark.createDataFrame(items, "item_id bigint, text string, rank int, score int")
    found = by_item(ranking.ranked(frame, asked.select("item_id", "text"), k).collect())
    want = brute([r[:2] for r in documents], [i[:2] for i in items], k)
    assert found == {item: own for item, own in want.items() if own}


def test_edge_rows_equal_plain_scoring(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CHUNK", 16)
    documents = rows(3, 60)
    items = [(1, "The stone of the river", 0, 0), (2, "", 0, 0), (3, None, 0, 0), (4, "GRÖSSE größe él 語 😀", 0, 0), (5, "word " * 300, 0, 0), (None, "cloud and x1", 0, 0)]
    check(spark, documents, items)
    check(spark, documents, items, 2)
    # Of items with one id the first text counts.
    twice = [(1, "stone", 0, 0), (1, "the", 0, 0), (1, "stone", 0, 0)]
    frame = spark.createDataFrame(documents, SCHEMA)
    found = ranking.ranked(frame, spark.createDataFrame(twice, "item_id bigint, text string, a int, b int").select("item_id", "text"))
    assert by_item(found.collect()) == {1: brute([r[:2] for r in documents], [(1, "stone")], 20)[1]}


def test_many_ties_blocks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 12)
    draw = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    documents = [(k, " ".join(draw.choices(words, weights, k=draw.choice([5, 5, 30]))), *(None,) * 9) for k in range(400)]
    documents += [(1000 + k, documents[0][1], *(None,) * 9) for k in range(60)]
    items = [(k, " ".join(draw.choices(words, k=8)), 0, 0) for k in range(12)] + [(99, documents[0][1], 0, 0)]
    check(spark, documents, items)
    none = spark.createDataFrame([], SCHEMA)
    asked = spark.createDataFrame(items, "item_id bigint, text string, rank int, score int").select("item_id", "text")
    assert ranking.ranked(none, asked).collect() == []
    assert ranking.ranked(spark.createDataFrame(documents, SCHEMA), asked.limit(0)).collect() == []


def test_walk_leaves_out_documents_that_cannot_count():
    """The walk scores few documents where the highest are known to be high."""
    draw = np.random.default_rng(0)
    count, size = 4096, 400
    terms = [np.sort(draw.choice(np.arange(20, size), 6, replace=False)) for _ in range(count)]
    for k in range(64):
        terms[k * 64] = np.arange(8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    level = ranking.Level(starts, np.concatenate(terms), np.full(starts[-1], 10))
    search = ranking.Search(ranking.ItemTree([(np.r_[np.arange(8), 20], np.full(9, 5))], size), np.array([300]), 20)
    scored = []
    keep = search._keep
    search._keep = lambda item, scores, ids, unnamed: (scored.append(len(scores)), keep(item, scores, ids, unnamed))
    search.add(np.arange(count), np.zeros(count, bool), level)
    assert search.ids[0].tolist() == [64 * k for k in range(20)] and search.scores[0].tolist() == [400] * 20
    assert sum(scored) == 64
