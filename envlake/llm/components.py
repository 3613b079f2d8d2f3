"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from envlake.llm.tables import written

MAX_ROUNDS = 60
# Edges that a task contracts by itself.
TASK_EDGES = 1 << 20


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: bigint), root the smallest node of its component.

    Alternating star contraction: each round links larger neighbours to the smallest
    neighbour, then smaller ones to it, until nothing changes. A round is joins and
    minima over the edge table, written to the shared folder; no neighbourhood is
    gathered, and joins on a node with many neighbours can be split by the runtime.
    """
    pairs = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "components"
    )
    state = _state(pairs)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        pairs = written(small, "components")
        before, state = state, _state(pairs)
        if state == before:
            break
    else:
        raise RuntimeError(f"No stable components after {MAX_ROUNDS} rounds.")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some edges, and the smallest node that each reaches by them."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return nodes, nodes[label]


def contracted_components(edges: DataFrame) -> DataFrame:
    """``components`` of a written edge table whose tasks first contract their own edges.

    Each task takes ``TASK_EDGES`` edges at most and leaves a star per component of them.
    Where that takes several tasks, the stars go on as edges to the alternating rounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if held:
            nodes, roots = least_reachable(*(np.concatenate(side) for side in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])

    tasks = max(1, -(-edges.count() // TASK_EDGES))
    stars = edges.select("u", "v").coalesce(tasks).mapInArrow(run, "node bigint, root bigint")
    if tasks == 1:
        return stars
    return components(stars.select(F.col("node").alias("u"), F.col("root").alias("v")))
