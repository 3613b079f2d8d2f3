"""Vector codes against plain loops over all entries."""

from __future__ import annotations

import hashlib
import math

import numpy as np

from envlake.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, whole int"


def brute(rows, rounds=4, entries=256):
    """(vec_id, code, error, label_error) of every row that can be coded, sorted, and the digest."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1])
    bounds = codes.part_bounds(width)
    start = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    books = [[v[b:e] for _, v in start] for b, e in bounds]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)), at) for at, entry in enumerate(book))

    for _ in range(rounds):
        for p, (b, e) in enumerate(bounds):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(v[b:e], books[p])[1], []).append(v[b:e])
            for at, own in groups.items():
                books[p][at] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = []
    for i, v, label in kept:
        best = [nearest(v[b:e], books[p]) for p, (b, e) in enumerate(bounds)]
        found.append((i, "".join(f"{at:02x}" for _, at in best), sum(d for d, _ in best), label))
    totals = {}
    for _, _, error, label in found:
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, c, e, totals[label]) for i, c, e, label in found), key=str), digest


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1) for i, v, label in rows], SCHEMA)


def compare(spark, rows, **more):
    found = codes.coded(frame(spark, rows)).collect()
    want, digest = brute(rows, **more)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=str) == want
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_codes_equal_plain_loops_on_edge_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(3 * k, draw.standard_normal(8).astype(np.float32).tolist(), int(k % 5)) for k in range(330)]
    rows += [(2000 + k, rows[7][1], None) for k in range(40)]  # ties
    rows += [rows[3], rows[3], (9, rows[4][1], 2), (None, rows[5][1], 1), (5000, [-3.0e4] * 8, 1)]
    bad = [(6000, None, 1), (6001, [float("nan")] * 8, 1), (6002, [float("inf")] + [0.0] * 7, 1), (6003, [None] + [0.0] * 7, 1)]
    compare(spark, rows + bad)


def test_few_vectors_and_none(spark):
    compare(spark, [(1, [0.5, -0.25, 1.0, 2.0, 0.1], 1), (2, [0.5, -0.25, 1.0, 2.0, 0.2], None)])
    assert codes.coded(frame(spark, [])).collect() == []
    assert codes.coded(frame(spark, [(1, None, 1)])).collect() == []
    (row,) = codes.coded(frame(spark, [(None, [1.0] * 4, 1)])).collect()
    assert row.code is None and row.error is None
    # Another length than most has no parts to compare.
    found = codes.coded(frame(spark, [(1, [1.0] * 4, 1), (2, [1.0] * 4, 1), (3, [1.0] * 3, 1)])).collect()
    assert {r.vec_id for r in found} == {1, 2}


def test_huge_components_are_held(spark):
    found = codes.coded(frame(spark, [(1, [3.0e38] * 4, 1), (2, [-3.0e38] * 4, 1), (3, [2.0e38] * 4, 1)])).collect()
    assert [r.code for r in sorted(found, key=lambda r: r.vec_id)] == ["00000000", "01010101", "00000000"]


def test_candidates_hold_the_nearest_and_not_everything():
    draw = np.random.default_rng(1)
    centres = draw.integers(-4000, 4000, (256, 16))
    book = codes.Codebook(centres)
    parts = centres[draw.integers(0, 256, 700)] + draw.integers(-300, 300, (700, 16))
    left = book.candidates(parts)
    nearest, errors = book.nearest(parts)
    distances = ((parts[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (nearest == distances.argmin(axis=1)).all() and (errors == distances.min(axis=1)).all()
    assert left[np.arange(700), nearest].all()
    assert left.mean() < 0.5
