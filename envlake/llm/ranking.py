"""Ranked lexical search by a dual-tree walk over items and documents.

Documents become sparse vectors over the terms of the items. In every chunk of them a
hierarchy holds, per node, the largest value of each coordinate among the documents below;
a second hierarchy holds the same over the weighted terms of the items. The product of two
nodes' maxima bounds every score between them. Where it lies below the weakest kth score
of the items of a node, the whole pair is left out: no document below can be among the
highest of any item below. What is left at the bottom is scored exactly, in integers.

Three passes over the documents. The first counts documents, lengths and document
frequencies. The second searches one of ``SEED_SHARE`` documents: its kth scores are lower
bounds of the final ones. The third searches all documents with them. Items are dealt into
blocks of bounded size; a block's terms and hierarchy go to the tasks, and each task
returns at most k documents per item, which Spark merges. A document that ties with a
bound is kept, so that ties are settled by doc_id alone.

Null and empty texts have no term, count in no statistic and are found by no item; items
without terms find nothing. Rows that repeat a doc_id are documents of their own. Of items
with one id the text that sorts first counts. A null item_id is an item like others; a null
doc_id sorts last among ties. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from envlake.llm.tables import read_table, small_batches, written

K = 20
# Distinct (item, term) rows in a block of items, on average: what is broadcast at once.
BLOCK_TERMS = 1 << 18
# Documents in a chunk, and children of a node.
CHUNK = 16384
FAN_OUT = 16
ITEM_FAN_OUT = 8
SEED_SHARE = 32
LARGEST = np.iinfo(np.int64).max

# A-Z lower-cased, other ASCII than letters and digits as space, the rest as it is.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(BYTES).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): how often each term stands in each item."""
    small_batches(items.sparkSession)
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            counted = [Counter(terms_of(text)) for text in batch.column(1).cast(pa.binary()).to_pylist()]
            rows = [(item, term, n) for item, own in zip(ids, counted, strict=True) for term, n in own.items()]
            item, term, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, batch.schema.field(0).type), pa.array(term, pa.binary()), pa.array(n, pa.int64())], ["item_id", "term", "n"]
            )

    first = items.groupBy("item_id").agg(F.min("text").alias("text"))
    return first.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term binary, n bigint")


def term_vectors(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of documents with a term: length, and which terms of the vocabulary (numbered from 1) occur how often."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            ids, lengths, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = terms_of(text)
                if words:
                    known = Counter(filter(None, map(number, words)))
                    ids.append(doc_id)
                    lengths.append(len(words))
                    terms.append(list(known.keys()))
                    counts.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "counts"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def term_weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Weight of every term by the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)


def document_values(lengths: np.ndarray, counts: np.ndarray, rows: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Coordinates: what one occurrence of a term in an item adds for a document, per unit of the term's weight."""
    # Products may leave 64 bits before they are divided.
    factor = np.array([75 + 25 * n * documents // total for n in lengths.tolist()], np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 12 * factor[rows])


class Level:
    """Sparse vectors, one after another: ``terms`` and ``values`` of node i lie from starts[i] to starts[i + 1]."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        self.starts, self.terms, self.values = starts, terms, values

    def __len__(self) -> int:
        return len(self.starts) - 1

    def parents(self, fan_out: int) -> Level:
        """The level above: the largest value of each coordinate among ``fan_out`` neighbours."""
        node = np.repeat(np.arange(len(self)), np.diff(self.starts)) // fan_out
        order = np.lexsort((self.terms, node))
        node, terms, values = node[order], self.terms[order], self.values[order]
        count = -(-len(self) // fan_out)
        first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (terms[1:] != terms[:-1])]) if len(node) else np.empty(0, np.int64)
        values = np.maximum.reduceat(values, first) if len(first) else values
        return Level(np.searchsorted(node[first], np.arange(count + 1)), terms[first], values)

    def products(self, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Product of each of some nodes with a dense vector."""
        begins, sizes = self.starts[nodes], self.starts[nodes + 1] - self.starts[nodes]
        ends = np.cumsum(sizes)
        entries = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)
        sums = np.concatenate([[0], np.cumsum(self.values[entries] * weights[self.terms[entries]])])
        return sums[ends] - sums[ends - sizes]


def hierarchy(bottom: Level, fan_out: int) -> list[Level]:
    """Levels from the bottom to one node."""
    levels = [bottom]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].parents(fan_out))
    return levels


class ItemTree:
    """Items of a block, neighbours by their weightiest terms, and their hierarchy of largest term weights."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], size: int) -> None:
        # An item is its terms and their weights times their repeats.
        self.order = sorted(range(len(items)), key=lambda i: tuple(items[i][0][np.argsort(-items[i][1], kind="stable")[:4]].tolist()))
        own = [items[i] for i in self.order]
        starts = np.concatenate([[0], np.cumsum([len(terms) for terms, _ in own])]).astype(np.int64)
        bottom = Level(starts, np.concatenate([t for t, _ in own]), np.concatenate([w for _, w in own]))
        self.levels = hierarchy(bottom, ITEM_FAN_OUT)
        self.size = size


class Search:
    """The highest scores of every item over the chunks of documents that a task meets."""

    def __init__(self, tree: ItemTree, least: np.ndarray, k: int) -> None:
        self.tree, self.k = tree, k
        count = len(tree.order)
        self.scores = [np.empty(0, np.int64) for _ in range(count)]
        self.ids = [np.empty(0, np.int64) for _ in range(count)]
        self.unnamed = [np.empty(0, bool) for _ in range(count)]
        # The weakest score that can still count, per item in the order of the tree; above zero.
        self.least = np.maximum(least[tree.order], 1)
        self.weights = np.zeros(tree.size, np.int64)

    def add(self, ids: np.ndarray, unnamed: np.ndarray, documents: Level) -> None:
        """Search a chunk of documents."""
        levels = hierarchy(documents, FAN_OUT)
        top = len(self.tree.levels) - 1
        self._walk(top, 0, levels, len(levels) - 1, np.zeros(1, np.int64), ids, unnamed)

    def _walk(self, height: int, node: int, levels: list[Level], depth: int, live: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        items = self.tree.levels[height]
        width = ITEM_FAN_OUT**height
        weakest = int(self.least[node * width : (node + 1) * width].min())
        own = slice(items.starts[node], items.starts[node + 1])
        terms = items.terms[own]
        self.weights[terms] = items.values[own]
        bounds = levels[depth].products(live, self.weights)
        self.weights[terms] = 0
        kept = bounds >= weakest
        live, bounds = live[kept], bounds[kept]
        if not len(live):
            return
        if height == 0 and depth == 0:
            self._keep(node, bounds, ids[live], unnamed[live])
            return
        if depth:
            below = live[:, None] * FAN_OUT + np.arange(FAN_OUT)
            live, depth = below[below < len(levels[depth - 1])], depth - 1
        if height == 0:
            self._walk(0, node, levels, depth, live, ids, unnamed)
            return
        children = range(node * ITEM_FAN_OUT, min((node + 1) * ITEM_FAN_OUT, len(self.tree.levels[height - 1])))
        for child in children:
            self._walk(height - 1, child, levels, depth, live, ids, unnamed)

    def _keep(self, item: int, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        unnamed = np.concatenate([self.unnamed[item], unnamed])
        best = np.lexsort((ids, unnamed, -scores))[: self.k]
        self.scores[item], self.ids[item], self.unnamed[item] = scores[best], ids[best], unnamed[best]
        if len(best) == self.k:
            self.least[item] = max(self.least[item], int(scores[best[-1]]))


def _chunk(table: pa.Table, documents: int, total: int) -> tuple:
    table = table.combine_chunks()
    sizes = table.column(2).combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    terms = table.column(2).combine_chunks().flatten().to_numpy().astype(np.int64)
    counts = table.column(3).combine_chunks().flatten().to_numpy().astype(np.int64)
    lengths = table.column(1).to_numpy().astype(np.int64)
    unnamed = table.column(0).combine_chunks().is_null().to_numpy(zero_copy_only=False)
    ids = table.column(0).combine_chunks().fill_null(0).to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    values = document_values(lengths, counts, rows, documents, total)
    # Documents of a language and a length have maxima alike.
    starts = np.concatenate([[0], np.cumsum(sizes)])
    strongest = np.lexsort((terms, -values, rows))[starts[:-1][sizes > 0]] if len(terms) else np.empty(0, np.int64)
    lead = np.zeros(len(sizes), np.int64)
    lead[sizes > 0] = terms[strongest]
    order = np.lexsort((lead, np.log2(np.maximum(lengths, 1)).astype(np.int64)))
    sizes_now = sizes[order]
    ends = np.cumsum(sizes_now)
    entries = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[order] - (ends - sizes_now), sizes_now)
    return ids[order], unnamed[order], Level(np.concatenate([[0], ends]), terms[entries], values[entries])


def _searched(vectors: DataFrame, shared, documents: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): at most k documents of each task per item (its number in the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, size, least = shared.value
        tree = ItemTree(items, size)
        search = Search(tree, least, k)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) >= CHUNK:
                search.add(*_chunk(pa.Table.from_batches(held), documents, total))
                held = []
        if held:
            search.add(*_chunk(pa.Table.from_batches(held), documents, total))
        sizes = [len(own) for own in search.scores]
        item = np.repeat(np.array(tree.order, np.int64), sizes)
        ids = pa.array(np.concatenate(search.ids), pa.int64(), mask=np.concatenate(search.unnamed))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), ids, pa.array(np.concatenate(search.scores), pa.int64())], ["item", "doc_id", "score"])

    found = vectors.filter(F.size("terms") > 0).mapInArrow(run, "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(documents: DataFrame, rows: list, kind: str, k: int) -> DataFrame:
    """Results of one block of items; rows are its (item_id, term, n)."""
    spark = documents.sparkSession
    names = {item: at for at, item in enumerate(dict.fromkeys(row.item_id for row in rows))}
    vocabulary = {term: at for at, term in enumerate(sorted({bytes(row.term) for row in rows}), 1)}
    vectors = written(term_vectors(documents, vocabulary), "ranking-vectors")
    # Lengths beyond 64 bits in sum are summed as decimals.
    seen = vectors.agg(F.count("*").alias("documents"), F.sum(F.col("n").cast("decimal(38,0)")).alias("total")).first()
    schema = f"item_id {kind}, rank int, doc_id bigint, score bigint"
    if not seen.documents:
        return spark.createDataFrame([], schema)
    count, total = int(seen.documents), int(seen.total)
    frequency = np.zeros(len(vocabulary) + 1, np.int64)
    # One row per term of the block.
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        frequency[row.term] = row.df
    weights = term_weights(frequency, count)
    own: list[tuple[list, list]] = [([], []) for _ in names]
    for row in rows:
        term = vocabulary[bytes(row.term)]
        if frequency[term]:
            own[names[row.item_id]][0].append(term)
            own[names[row.item_id]][1].append(row.n * int(weights[term]))
    items = [(np.array(terms, np.int64), np.array(values, np.int64)) for terms, values in own]
    least = np.zeros(len(items), np.int64)
    context = spark.sparkContext
    seeds = vectors.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_SHARE)) == 0)
    # One row per item of the block.
    for row in _searched(seeds, context.broadcast((items, len(vocabulary) + 1, least)), count, total, k).filter(F.col("rank") == k).collect():
        least[row.item] = row.score
    found = _searched(vectors, context.broadcast((items, len(vocabulary) + 1, least)), count, total, k)
    numbers = spark.createDataFrame([(at, item) for item, at in names.items()], f"item bigint, item_id {kind}")
    return found.join(F.broadcast(numbers), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents (doc_id, text) of each item (item_id, text)."""
    kind = items.schema["item_id"].dataType.simpleString()
    terms = written(item_terms(items), "ranking-items")
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    dealt = terms.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    parts = []
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("item_id", "term", "n").collect()
        if rows:
            found = _block(documents, rows, kind, k)
            parts.append(written(found, "ranking-found") if blocks > 1 else found)
    if not parts:
        return documents.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def op12_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 highest-scoring of all documents for every benchmark item."""
    return ranked(read_table(spark, folder, "documents").select("doc_id", "text"), read_table(spark, folder, "benchmark").select("item_id", "text"))


OP12_SQL = r"""
WITH plain AS (
  SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
split AS MATERIALIZED (
  SELECT r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM plain WHERE t IS NOT NULL),
sizes AS (SELECT r, doc_id, len(w) AS n FROM split WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
counts AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM split) GROUP BY r, term),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
scores AS (
  SELECT item_id, r, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (r), totals GROUP BY item_id, r)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN sizes USING (r) WHERE score > 0) WHERE rank <= 20
"""
