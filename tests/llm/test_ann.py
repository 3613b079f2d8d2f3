"""Collision-counting search: recall and exactness against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from envlake.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def brute(vectors, queries, k):
    """query -> ids and scores of the nearest."""
    ids = np.array([i for i, _ in vectors])
    matrix = np.array([v for _, v in vectors], np.float64)
    found = {}
    for query_id, query in queries:
        scores = (matrix * np.asarray(query, np.float64)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != query_id][:k]
        found[query_id] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_over_a_table(spark, size):
    folder = f"/root/testdata/{size}"
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(vectors, [(i, v) for i, v in vectors if i % 20 == 0], 20)
    found = by_query(ann.op10_collision_counting(spark, folder).collect())
    assert set(found) == set(want)
    hits = 0
    scores = {}
    for query, own in found.items():
        assert len(own) == 20 and own == sorted(own, key=lambda x: (-x[1], x[0]))
        hits += len({i for i, _ in own} & {i for i, _ in want[query]})
        scores |= {(query, i): s for i, s in want[query]}
        assert all(s == scores[query, i] for i, s in own if (query, i) in scores)
    assert hits / (20 * len(want)) >= 0.9


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 7)
    draw = np.random.default_rng(2)
    good = [(k, (draw.standard_normal(8) * (1 + k % 5)).astype(np.float32).tolist()) for k in range(100)]
    good += [(200 + k, good[20][1]) for k in range(60)]  # ties
    bad = [(300, None), (320, [0.0] * 8), (340, [float("nan")] + [1.0] * 7), (360, [float("inf")] * 8), (380, [None] + [1.0] * 7), (400, [1.0] * 3), (None, [1.0] * 8)]
    rows = [(i, v, 1) for i, v in [*good, *bad]]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = by_query(ann.nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"), 20).collect())
    want = brute(good, [(i, v) for i, v in good if i % 20 == 0], 20)
    assert set(found) == set(want)
    assert sum(len(set(found[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)
    # All copies of the query's vector tie; the smallest ids come first.
    assert [i for i, _ in found[20]][:10] == [i for i, _ in want[20]][:10]


def test_fewer_candidates_than_wanted_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (3, [2.0, 1.0], 1)], SCHEMA)
    found = by_query(ann.nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"), 20).collect())
    assert found == {0: [(3, 2.0), (20, 0.0)], 20: [(3, 1.0), (0, 0.0)]}
    one = frame.filter("vec_id = 0")
    assert ann.nearest_neighbours(one, one, 20).collect() == []
    assert ann.nearest_neighbours(frame.limit(0), frame.limit(0), 20).collect() == []
    # A row with the query's id is its own.
    twice = frame.unionByName(one)
    assert by_query(ann.nearest_neighbours(twice, one, 20).collect()) == {0: [(3, 2.0), (20, 0.0)]}


def test_candidates_follow_the_distances(monkeypatch):
    draw = np.random.default_rng(5)
    shares = []
    for n in (1000, 16000):
        vectors = draw.standard_normal((n, 32))
        vectors /= np.sqrt((vectors**2).sum(axis=1))[:, None]
        block = ann.ProjectedBlock(np.arange(n), vectors, 1.0)
        met = []
        plain = np.lexsort
        hits = 0
        for query in range(40):
            scores = vectors @ vectors[query]
            scores[query] = -2
            with monkeypatch.context() as patch:
                patch.setattr(np, "lexsort", lambda keys: met.append(len(keys[0])) or plain(keys))
                ids, _ = block.nearest(query, vectors[query], 20)
            hits += len(set(ids.tolist()) & set(np.argsort(-scores)[:20].tolist()))
        assert hits >= 0.9 * 20 * 40
        shares.append(sum(met) / (40 * n))
    # Sixteen times the rows give far less than sixteen times the candidates.
    assert shares[1] < shares[0] / 2


def test_longest_vector_far_beyond_the_others():
    draw = np.random.default_rng(6)
    vectors = draw.standard_normal((3000, 16))
    vectors[0] *= 1000
    block = ann.ProjectedBlock(np.arange(3000), vectors, float(np.sqrt((vectors**2).sum(axis=1)).max()))
    hits = 0
    for query in range(1, 41):
        ids, _ = block.nearest(query, vectors[query], 20)
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        hits += len(set(ids.tolist()) & set(np.argsort(-scores)[:20].tolist()))
    assert hits >= 0.9 * 20 * 40
