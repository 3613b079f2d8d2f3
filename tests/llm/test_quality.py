"""Quality: held-out accuracy, the discriminant against a direct one, edge rows."""

from __future__ import annotations

import zlib

import numpy as np
from edge import SCHEMA, rows

from envlake.llm import quality

FOLDER = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    found = quality.op6_quality_qda(spark, FOLDER).collect()
    assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == is_held_out(r.doc_id) for r in found)
    held = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    clean = [p for label, p in held if label == 1]
    junk = [p for label, p in held if label == 0]
    assert len(held) > 60 and np.mean(clean) >= 0.98 and np.mean(junk) <= 0.1


def test_density_difference_is_that_of_the_covariances():
    draw = np.random.default_rng(0)
    x = [draw.normal(size=(500, 4)) @ draw.normal(size=(4, 4)), 3 + draw.normal(size=(900, 4)) @ draw.normal(size=(4, 4))]
    counts = np.array([500.0, 900.0])
    model = quality.quality_model(counts, np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x]))
    own = [np.cov(a.T, bias=True) for a in x]
    pooled = (500 * own[0] + 900 * own[1]) / 1400
    points = np.vstack([x[0][:20], x[1][:20]])
    density = []
    for k, a in enumerate(x):
        s = (1 - quality.TO_POOLED) * own[k] + quality.TO_POOLED * pooled
        s = (1 - quality.TO_IDENTITY) * s + quality.TO_IDENTITY * np.diag(np.diag(pooled) + 1e-6)
        d = points - a.mean(0)
        density.append(np.log(counts[k] / 1400) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d))
    assert np.allclose(model.score(points), 1 / (1 + np.exp(density[0] - density[1])), atol=1e-9)


def test_statistics_of_empty_and_long_texts():
    assert quality.text_statistics(None) == quality.text_statistics("")
    assert all(np.isfinite(quality.text_statistics(t)).all() for t in ("", " \n", "x" * 100_000, "語" * 1000, "| | |", "a\n" * 50_000))
    assert len(quality.text_statistics("one two")) == len(quality.STATISTICS)


def test_edge_rows(spark):
    table = rows(n=60)
    frame = spark.createDataFrame(table, SCHEMA)
    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (3, None, 1), (4, 7, 1), (5, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    model = quality.fit_quality(frame, labels)
    found = quality.score_documents(frame, model).collect()
    assert len(found) == len(table) and all(0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    kept = quality.drop_low_quality(frame, labels)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.predicted for r in found)
    assert quality.score_documents(frame.limit(0), model).collect() == []
    unlearned = quality.fit_quality(frame, labels.limit(0))
    assert unlearned is None
    assert {(r.score, r.predicted) for r in quality.score_documents(frame, unlearned).collect()} == {(0.5, 0)}
    assert quality.drop_low_quality(frame, labels.limit(0)).count() == frame.count()


def test_labels_of_the_held_out_fold_are_not_used(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    changed = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 1 - quality, quality) AS quality")
    one, two = quality.fit_quality(frame, labels), quality.fit_quality(frame, changed)
    assert np.allclose(one.means, two.means) and np.allclose(one.factors, two.factors)
