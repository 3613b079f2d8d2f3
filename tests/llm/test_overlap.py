"""Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from edge import SCHEMA, rows

from envlake.llm import overlap


def sets_of(texts):
    found = []
    for text in texts:
        words = (text or "").encode().lower().split()
        found.append(frozenset([tuple(words)] if 0 < len(words) < 5 else zip(*(words[k:] for k in range(5)), strict=False)))
    return found


def brute(documents):
    """(doc_id, n_shingles, component_id) of every row, sorted."""
    sets = sets_of([text for _, text in documents])
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((top(i), top(j)))
                    root[b] = a
    least = {}
    for k, (i, _) in enumerate(documents):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i, len(sets[k]), least.get(top(k))) for k, (i, _) in enumerate(documents)), key=str)


def check(spark, documents):
    frame = documents if not isinstance(documents, list) else spark.createDataFrame(documents, SCHEMA)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in overlap.joined(frame).collect()), key=str)
    assert found == brute([d[:2] for d in documents])


def test_edge_rows(spark):
    documents = rows()
    check(spark, documents)


def family(draw, size, length, changed, words, begin):
    """Texts made of one by changing some of its words."""
    base = draw.choices(words, k=length)
    made = []
    for k in range(size):
        own = list(base)
        for at in draw.sample(range(length), changed):
            own[at] = draw.choice(words)
        made.append((begin + k, " ".join(own), *(None,) * 9))
    return made


@pytest.mark.parametrize("small", [False, True])
def test_families_around_the_limit(spark, monkeypatch, small):
    if small:
        # Several blocks, shards, salts and hubs.
        for name, value in (("BLOCK", 16), ("MERGED", 64), ("LIST_ROWS", 8), ("OFTEN", 1), ("MUCH", 1), ("PER_LIST", 20), ("COUNTED", 500)):
            monkeypatch.setattr(overlap, name, value)
    draw = random.Random(7)
    words = [f"w{k}" for k in range(3000)]
    documents = []
    for length, changed in ((60, 1), (60, 2), (150, 3), (150, 4), (400, 8), (12, 1), (7, 1)):
        documents += family(draw, 40, length, changed, words, 1000 * len(documents))
    # Passages that many texts share, around one of their own.
    passage = " ".join(draw.choices(words, k=60))
    documents += [(9_000_000 + k, " ".join([*draw.choices(words, k=20), passage, *draw.choices(words, k=3 * (k % 5))]), *(None,) * 9) for k in range(60)]
    documents += [(9_500_000 + k, documents[3][1].upper(), *(None,) * 9) for k in range(30)]
    draw.shuffle(documents)
    check(spark, documents)


def test_empty_table(spark):
    assert overlap.joined(spark.createDataFrame([], SCHEMA)).collect() == []


def test_necessary_lists_are_shared():
    """Linked sets share as many short lists as the search asks for."""
    draw = np.random.default_rng(3)
    for _ in range(300):
        size = int(draw.integers(1, 900))
        base = draw.permutation(4000)
        own = base[:size]
        gone = int(draw.integers(0, max(1, size // 8) + 1))
        other = np.concatenate([base[gone:size], base[2000 : 2000 + int(draw.integers(0, max(1, size // 8) + 1))]])
        both = len(np.intersect1d(own, other))
        a, b = len(own), len(other)
        if not b or 100 * both < 80 * (a + b - both):
            continue
        one, two = np.sort(own)[: overlap.short_lists(a)], np.sort(other)[: overlap.short_lists(b)]
        met = [t for t in np.intersect1d(one, two) if overlap.may_link(a, np.searchsorted(np.sort(own), t), b, np.searchsorted(np.sort(other), t))]
        assert len(met) >= overlap.needed(min(a, b))


def test_divide_skip_equals_counting():
    draw = random.Random(2)
    for _ in range(200):
        found = [np.unique(draw.choices(range(30), k=draw.randint(1, 40))) for _ in range(draw.randint(1, 9))]
        least = draw.randint(1, len(found))
        want = [x for x in range(30) if sum(x in own for own in found) >= least]
        assert overlap.divide_skip(found, least) == want


def test_pairs_of_a_family_without_links_do_not_become_rows(spark):
    """Texts that share most words and hold no link leave few occurrences."""
    draw = random.Random(9)
    words = [f"w{k}" for k in range(5000)]
    documents = family(draw, 400, 200, 14, words, 0)
    members = spark.createDataFrame(documents, SCHEMA)
    common = overlap.frequent(overlap.sized(members, 5))
    table = overlap.lists(overlap.postings(members, 5, common))
    grouped = table.withColumn("root", table["node"])
    sizes = grouped.groupBy("shingle").count().withColumnRenamed("count", "n").filter("n > 1")
    sets = overlap.sets_of(members, overlap.sized(members, 5).filter("shingle IS NULL").groupBy("node").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "first_id"), table.select("node").distinct(), 5)
    assert overlap.occurring(overlap.block_rows(grouped, sizes, sets)).count() < 400
