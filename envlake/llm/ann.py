"""Nearest neighbours by inner product with collision-counting hashing.

Vectors gain a coordinate that makes them equally long, so that the largest inner product
is the smallest distance, and are projected on ``PROJECTIONS`` fixed directions, random
orthogonal bases one after the other. In every block of vectors each projection is kept as
one sorted array. A query opens a window around its own projection in each array and widens
all of them by a common factor (virtual rehashing); a vector collides with the query once
per window that holds it. Vectors that collide in a share ``COLLISIONS`` of the windows are
candidates, and every candidate is verified by its exact inner product in double precision.

Windows widen until they are ``REACH`` times the distance of the last of the wanted verified
vectors to either side: a vector at that distance then misses a window with a probability
of about 0.02, and a nearer one less, so it has the collisions with a probability above 0.9
whatever the number and spread of the vectors are. How many vectors become candidates
follows from the data. The first windows come from the distances to a few rows of the block.
As windows are wide, the vectors outside are counted where they are fewer than those inside.

Blocks and groups of queries have a bounded size; every query meets every block. The
nearest of each block are merged per query. Recall is measured against brute force in
tests/llm.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, nor do rows without id. Rows with the query's id are its own and
no candidates; of repeated ids the smallest vector is the query. Equal products go to the
smaller id. A table without usable vectors gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from envlake.llm.tables import read_table, written

PROJECTIONS = 128
COLLISIONS = 0.96
REACH = 2.3
# Rows whose distances give the first windows, and the factor beyond them.
SAMPLE_ROWS = 1024
WIDEN = 1.1
BLOCK_ROWS = 32768
BLOCK_COMPONENTS = 1 << 22
QUERY_ROWS = 4096
# Groups are no smaller than this for the sake of more tasks.
LEAST_QUERIES = 512
SEED = 7

RESULT = "query_id bigint, vec_id bigint, score double"


def directions(dimension: int) -> np.ndarray:
    """Fixed directions, a column each: random orthogonal bases, as long as to keep the mean square of a component."""
    draw = np.random.default_rng(SEED)
    bases = [np.linalg.qr(draw.standard_normal((dimension, dimension)))[0] for _ in range(-(-PROJECTIONS // dimension))]
    return np.hstack(bases)[:, :PROJECTIONS] * np.sqrt(dimension)


class ProjectedBlock:
    """Vectors of a block with one sorted array per projection."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float) -> None:
        self.ids, self.vectors, self.longest = ids, vectors, longest
        lengths = np.maximum(longest**2 - (vectors**2).sum(axis=1), 0.0)
        self.axes = directions(vectors.shape[1] + 1)
        projected = (np.column_stack([vectors, np.sqrt(lengths)]) @ self.axes).T
        order = np.argsort(projected, axis=1, kind="stable")
        self.order = order.ravel()
        # All arrays in one: each shifted beyond the one before, so that one search serves them all.
        values = np.take_along_axis(projected, order, axis=1)
        self.shift = 4.0 * longest * (np.sqrt(vectors.shape[1] + 1) + 1.0)
        self.values = (values + self.shift * np.arange(PROJECTIONS)[:, None]).ravel()
        # Distances below this are rounding.
        self.least = 1e-6 * longest

    def distances(self, products: np.ndarray, length: float) -> np.ndarray:
        """Distances of the extended vectors, the query being as long as the longest."""
        return np.sqrt(np.maximum(2.0 * self.longest**2 - 2.0 * products * (self.longest / length), 0.0))

    def radii(self, query_id: int, query: np.ndarray, length: float, wanted: int) -> np.ndarray:
        """Half widths of the first windows, ascending: what the distances to a few rows suggest."""
        others = self.ids[:SAMPLE_ROWS] != query_id
        near = np.sort(self.distances((self.vectors[:SAMPLE_ROWS] @ query)[others], length))
        return REACH * np.maximum(near[max(0, wanted * len(near) // len(self.ids) - 1) :], self.least)

    def nearest(self, query_id: int, query: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact products of the nearest candidates, nearest first, ties by id."""
        n = len(self.ids)
        length = float(np.sqrt((query**2).sum()))
        scaled = query * (self.longest / length)
        starts = self.shift * np.arange(PROJECTIONS)
        centre = np.append(scaled, 0.0) @ self.axes + starts
        edges = n * np.arange(PROJECTIONS)
        may_miss = PROJECTIONS - int(np.ceil(COLLISIONS * PROJECTIONS))
        suggested = iter(self.radii(query_id, query, length, wanted))
        radius = next(suggested, self.least)
        misses = low = high = None
        while True:
            wider_low = np.clip(np.searchsorted(self.values, centre - radius, "left"), edges, edges + n)
            wider_high = np.clip(np.searchsorted(self.values, centre + radius, "right"), edges, edges + n)
            if misses is not None:
                misses -= self._counted([wider_low, high], [low, wider_high])
            elif 2 * (wider_high - wider_low).sum() > n * PROJECTIONS:
                misses = self._counted([edges, wider_high], [wider_low, edges + n])
            else:
                misses = PROJECTIONS - self._counted([wider_low], [wider_high])
            low, high = wider_low, wider_high
            candidates = np.flatnonzero(misses <= may_miss)
            rows = candidates[self.ids[candidates] != query_id]
            scores = (self.vectors[rows] * query).sum(axis=1)
            best = np.lexsort((self.ids[rows], -scores))[:wanted]
            wider = max(next(suggested, 0.0), WIDEN * radius)
            if len(best) == wanted:
                reached = REACH * max(float(self.distances(scores[best[-1:]], length)[0]), self.least)
                wider = min(wider, reached)
            if wider <= radius or len(candidates) == n:
                return self.ids[rows][best], scores[best]
            radius = wider

    def _counted(self, begins: list[np.ndarray], ends: list[np.ndarray]) -> np.ndarray:
        """How many of the ranges of the sorted arrays hold each row."""
        ranges = zip(np.concatenate(begins).tolist(), np.concatenate(ends).tolist(), strict=True)
        held = [self.order[begin:end] for begin, end in ranges if begin < end]
        return np.bincount(np.concatenate(held), minlength=len(self.ids)) if held else np.zeros(len(self.ids), np.int64)


def _search(k: int, longest: float):
    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        matrix = np.stack(vectors["embedding"].to_numpy()).astype(np.float64)
        block = ProjectedBlock(vectors["vec_id"].to_numpy(np.int64), matrix, longest)
        found = []
        for query_id, query in zip(queries["query_id"].tolist(), queries["embedding"], strict=True):
            ids, scores = block.nearest(query_id, np.asarray(query, np.float64), k)
            found.append(pd.DataFrame({"query_id": np.full(len(ids), query_id), "vec_id": ids, "score": scores}))
        return pd.concat(found)

    return run


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of vectors (vec_id, embedding) per query (vec_id, embedding)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))

    def usable(rows: DataFrame) -> DataFrame:
        good = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        return good.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).withColumn("length", length).filter("length > 0")

    good = usable(vectors)
    sizes = good.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("rows"), F.max("length").alias("longest"))
    usual = sizes.orderBy(F.desc("rows"), "size").first()
    if usual is None:
        empty = good.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
        return empty
    good = good.filter(F.size("embedding") == usual["size"])
    blocks = -(-usual["rows"] // max(1, min(BLOCK_ROWS, BLOCK_COMPONENTS // usual["size"])))
    # The block of a row is fixed by writing it, whatever is computed again later.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    stored = written(good.select("vec_id", "embedding", dealt.alias("block")), "ann-vectors")
    asked = usable(queries).filter(F.size("embedding") == usual["size"])
    asked = written(asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumnRenamed("vec_id", "query_id"), "ann-queries")
    total = asked.count()
    more = min(-(-good.sparkSession.sparkContext.defaultParallelism // blocks), total // LEAST_QUERIES)
    groups = max(1, -(-total // QUERY_ROWS), more)
    grouped = asked.withColumn("query_group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    left = stored.withColumn("query_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = grouped.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = min(blocks * groups, 1 << 16)
    keys = ["block", "query_group"]
    pairs = left.repartition(tasks, *keys).groupBy(*keys).cogroup(right.repartition(tasks, *keys).groupBy(*keys))
    found = pairs.applyInPandas(_search(k, float(usual["longest"])), RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of all embeddings for those whose id is divisible by 20."""
    vectors = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"))
