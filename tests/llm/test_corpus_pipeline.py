"""The pipeline's stages over rows of every kind, and its registration."""

from __future__ import annotations

from collections import defaultdict

import pytest
from edge import SCHEMA, rows
from test_line_dedup import brute as lines_left

import __spark_entry__ as contract
import corpus_pipeline
from envlake.llm import registry
from envlake.llm.tables import written

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    assert [name.split("_")[0] for name in registry.queries()] == [f"op{n}" for n in range(1, 14)]
    assert set(registry.queries()) | {"pipeline"} <= set(contract.queries())
    assert set(registry.oracle_sql()) <= set(contract.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "language_id", "line_dedup", "simhash_near_dedup", "packing"
    ]


def test_stages_hand_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], FOLDER), f"test-{name}"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    tables = [[tuple(r) for r in frame.collect()] for frame in kept]
    for before, after in zip(tables[:4], tables[1:5], strict=True):
        assert {r[0] for r in after} <= {r[0] for r in before}
    assert all(frame.columns == columns for frame in kept[:5])
    # Clean documents stay, junk goes.
    stayed = {r[0] for r in tables[1]}
    clean = [d in stayed for d, q in labels.items() if q == 1]
    junk = [d in stayed for d, q in labels.items() if q == 0]
    assert sum(clean) >= 0.98 * len(clean) and sum(junk) <= 0.2 * len(junk)
    assert len(tables[2]) >= 0.99 * len(tables[1])
    # Lines are cut as by brute force.
    left = dict(lines_left([(r[0], r[1], r[3]) for r in tables[2]]))
    assert {r[0]: r[1] for r in tables[3]} == left
    # Of equal texts the smallest id stays; documents unlike all others stay.
    first = {}
    for r in sorted(tables[3]):
        first.setdefault(r[1], r[0])
    survivors = {r[0] for r in tables[4]}
    assert survivors <= set(first.values()) and len(survivors) >= 0.9 * len(first)
    # All that is left is packed whole.
    packed = defaultdict(int)
    for p in kept[5].collect():
        packed[p.doc_id, p.doc_tokens] += p.length
    assert {doc for doc, _ in packed} == survivors and all(n == total for (_, n), total in packed.items())


@pytest.mark.parametrize("stage", [0, 1, 2, 3, 4])
def test_stages_take_edge_rows_and_empty_tables(spark, stage):
    frame = spark.createDataFrame(rows(), SCHEMA)
    name, run = corpus_pipeline.STAGES[stage]
    found = run(spark, frame, FOLDER)
    assert name == "packing" or found.columns == frame.columns
    assert found.count() > 0 or name == "quality_classifier"
    assert run(spark, frame.limit(0), FOLDER).count() == 0
