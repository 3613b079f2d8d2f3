"""Vector codes of four bytes, with codebooks searched by slices of prefix masks.

A codebook keeps, per dimension, the coordinates of its entries in order, and beside them
prefix masks: bit sets of the entries among the first 0, 1, 2, ... of that order. The
distance to one entry, found near the vector in the order of a few dimensions, is the
initial radius. Per dimension it selects a range of the sorted coordinates, whose entries
are the difference of two prefix masks; the masks of all dimensions are ANDed. What is
left holds every entry within the radius, the nearest one among them, so that exact
distances to the entries left give the nearest, ties going to the lower index.

Codebooks are fitted in rounds over all vectors: a task sums the parts of each entry, and
Spark sums the sums. Only a codebook's size in numbers travels to the driver and back.

Vectors that are null or hold null or non-finite components are dropped, and so are those
of another length than most (the lesser length of two equally frequent), as they have no
parts to compare. Where four does not divide the length, the first parts are one longer.
Integers beyond 2^27 on either side, where squared distances leave 64 bits, are held there.
Rows without vec_id are coded like others and start no codebook; rows of one vec_id are
all kept and start codebooks in the order of their components. Fewer than 256 vectors make
a smaller codebook. An error of a label beyond 64 bits is null. An empty table gives an
empty result. Other columns of whatever name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.llm.tables import read_table, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 1 << 27
# Vectors searched at once, and the dimensions and neighbours that give the initial radius.
CHUNK = 512
GUESS_DIMENSIONS = 4
GUESS_NEIGHBOURS = 4


class Codebook:
    """Entries of one part with sorted coordinates and prefix masks per dimension."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        count, dimensions = entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(entries.T, self.order, axis=1)
        own = np.zeros((count, -(-count // 64)), np.uint64)
        at = np.arange(count)
        own[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        self.masks = np.zeros((dimensions, count + 1, own.shape[1]), np.uint64)
        self.masks[:, 1:] = np.bitwise_or.accumulate(own[self.order], axis=1)
        self.every = np.bitwise_or.reduce(own, axis=0)
        spread = self.sorted[:, -1] - self.sorted[:, 0]
        self.widest = np.argsort(-spread, kind="stable")[:GUESS_DIMENSIONS]

    def _radius(self, parts: np.ndarray) -> np.ndarray:
        """Squared distance to the nearest of a few entries close by in the widest dimensions."""
        count = len(self.entries)
        least = ((parts - self.entries[0]) ** 2).sum(axis=1)
        for dimension in self.widest.tolist():
            place = np.searchsorted(self.sorted[dimension], parts[:, dimension])
            for step in range(-(GUESS_NEIGHBOURS // 2), GUESS_NEIGHBOURS - GUESS_NEIGHBOURS // 2):
                near = self.order[dimension][np.clip(place + step, 0, count - 1)]
                least = np.minimum(least, ((parts - self.entries[near]) ** 2).sum(axis=1))
        return least

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """(rows, entries) of bools: the entries within the initial radius in every dimension."""
        squared = self._radius(parts)
        radius = np.sqrt(squared.astype(np.float64)).astype(np.int64) + 1
        left = np.broadcast_to(self.every, (len(parts), len(self.every)))
        for dimension, (line, masks) in enumerate(zip(self.sorted, self.masks, strict=True)):
            own = parts[:, dimension]
            low = np.searchsorted(line, own - radius, "left")
            high = np.searchsorted(line, own + radius, "right")
            left = left & (masks[high] ^ masks[low])
        bits = np.unpackbits(np.ascontiguousarray(left).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        return bits[:, : len(self.entries)].astype(bool)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry per row."""
        codes, errors = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for begin in range(0, len(parts), CHUNK):
            own = parts[begin : begin + CHUNK]
            rows, entries = np.nonzero(self.candidates(own))
            gaps = own[rows] - self.entries[entries]
            distances = np.einsum("ij,ij->i", gaps, gaps)
            firsts = np.searchsorted(rows, np.arange(len(own)))
            least = np.minimum.reduceat(distances, firsts)
            hits = np.flatnonzero(distances == least[rows])
            _, first_hit = np.unique(rows[hits], return_index=True)
            codes[begin : begin + CHUNK] = entries[hits[first_hit]]
            errors[begin : begin + CHUNK] = least
        return codes, errors


def part_bounds(width: int) -> list[tuple[int, int]]:
    """Begin and end of every part of vectors of a length."""
    sizes = [width // PARTS + (part < width % PARTS) for part in range(PARTS)]
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def integer_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, whole) of the rows that can be coded: components times 1024, rounded down."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(
        vector, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * SCALE))).cast("bigint")
    )
    kept = vectors.filter(F.col(vector).isNotNull() & usable)
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", scaled.alias("whole"))


def _sums(books: list[np.ndarray], width: int):
    bounds = part_bounds(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Codebook(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            matrix = _matrix(batch.column(0), width)
            for part, (begin, end) in enumerate(bounds):
                own = np.ascontiguousarray(matrix[:, begin:end])
                codes, _ = ready[part].nearest(own)
                counts[part] += np.bincount(codes, minlength=len(counts[part]))
                np.add.at(sums[part], codes, own)
        for part, (count, total) in enumerate(zip(counts, sums, strict=True)):
            used = np.flatnonzero(count)
            entry, place = np.repeat(used, total.shape[1]), np.tile(np.arange(total.shape[1]), len(used))
            columns = [np.full(len(entry), part), entry, place, count[entry], total[entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "n", "total"])

    return run


def _codes(books: list[np.ndarray], width: int):
    bounds = part_bounds(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Codebook(book) for book in books]
        for batch in batches:
            matrix = _matrix(batch.column(2), width)
            found = [book.nearest(np.ascontiguousarray(matrix[:, b:e])) for book, (b, e) in zip(ready, bounds, strict=True)]
            code = np.column_stack([codes for codes, _ in found]).astype(np.uint8).reshape(len(matrix), PARTS)
            text = [row.tobytes().hex() for row in code]
            error = np.sum([errors for _, errors in found], axis=0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def fit(stored: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """A codebook per part of vectors (vec_id, whole) of one length."""
    first = stored.filter("vec_id IS NOT NULL").orderBy("vec_id", "whole").limit(ENTRIES).select("whole").collect()
    start = np.array([row.whole for row in first], np.int64).reshape(len(first), width)
    books = [start[:, begin:end].copy() for begin, end in part_bounds(width)]
    if not len(first):
        return books
    for _ in range(rounds):
        sums = stored.select("whole").mapInArrow(_sums(books, width), "part bigint, entry bigint, place bigint, n bigint, total bigint")
        # As many rows as the codebooks have numbers.
        found = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        for row in found.collect():
            books[row.part][row.entry, row.place] = int(row.total) // row.n
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all numbers, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def coded(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the vectors (vec_id, label) that can be coded."""
    schema = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    stored = written(integer_vectors(vectors, vector), "codes-vectors")
    usual = stored.groupBy(F.size("whole").alias("width")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "width").first()
    if usual is None:
        return stored.sparkSession.createDataFrame([], schema)
    width = usual["width"]
    stored = stored.filter(F.size("whole") == width)
    books = fit(stored, width, rounds)
    if not len(books[0]):
        # Without a single vec_id nothing starts a codebook.
        empty = stored.select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
        return empty.select("vec_id", "code", "error", F.lit(None).cast("bigint").alias("label_error"), F.lit(books_digest(books)).alias("codebooks_sha256"))
    kind = stored.schema["label"].dataType.simpleString()
    found = stored.select("vec_id", "label", "whole").mapInArrow(_codes(books, width), f"vec_id bigint, label {kind}, code string, error bigint")
    found = written(found, "codes-found")
    per_label = found.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "same_label")
    whole = found.join(per_label, F.col("label").eqNullSafe(F.col("same_label")))
    return whole.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_slice_masks(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings."""
    return coded(read_table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


def _oracle(rounds: int = ROUNDS) -> str:
    distance = "p.xx - 2 * list_dot_product(p.x, b.c) + b.cc"
    nearest = f"arg_min({{'e': b.e, 'd': {distance}}}, ({distance}) * 256 + b.e)"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, x, list_dot_product(x, x) AS xx
  FROM (SELECT r, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS x
        FROM kept, (SELECT unnest(range({PARTS})) AS p))),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c, xx AS cc FROM parts WHERE r <= {ENTRIES})"""
    ]
    for k in range(rounds):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT p.r, p.p, any_value(p.x) AS x, {nearest} AS n
  FROM parts p JOIN b{k} b USING (p) GROUP BY p.r, p.p),
m{k} AS MATERIALIZED (
  SELECT p, e, list(s ORDER BY i) AS c
  FROM (SELECT p, e, i, floor(sum(x[i]) / count(*)) AS s
        FROM (SELECT p, n.e AS e, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY p, e, i) GROUP BY p, e),
b{k + 1} AS MATERIALIZED (
  SELECT p, e, c, list_dot_product(c, c) AS cc
  FROM (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m USING (p, e)))""")
    steps.append(f"""last AS MATERIALIZED (
  SELECT p.r, p.p, {nearest} AS n
  FROM parts p JOIN b{rounds} b USING (p) GROUP BY p.r, p.p),
codes AS (
  SELECT r, string_agg(printf('%02x', n.e), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM last GROUP BY r),
digest AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda x: x::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY p, e)) AS h
  FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM codes JOIN kept USING (r), digest""")
    return "WITH " + ",\n".join(steps)


OP13_SQL = _oracle()
