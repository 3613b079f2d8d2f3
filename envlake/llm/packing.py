"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of documents. A round stands for one window of
``sequence_tokens``: it adds to the deficit of each source its share of a window, and a
source whose deficit covers a slot of ``slot_tokens`` sends the slot; what is left of a
deficit is carried to later rounds. So a window holds every source in its target
proportion, to within a slot per source. Documents are cut at slot ends, and slots are
laid one after another into sequences without gaps. The last slots of the sources, which
are not full, follow at the end; only the last sequence of all is padded.

The round of a slot follows from its place in its queue alone: slot j goes in the first
round by which the share of the source adds up to j+1 slots. Places in queues and in the
output are prefix sums over small per-task and per-block totals, so deficits carry over
windows and partitions without a sequential pass, and no queue is gathered in one task.

Null texts count as empty; every document ends with the id 0, so an empty one has one
token. Null sources form a queue with the empty source. Repeated rows are packed each.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from envlake.llm.tables import read_table, small_batches, written
from envlake.llm.tokens import tokenizer_cache

SEQUENCE_TOKENS = 1024
SLOT_TOKENS = 64
END_OF_TEXT = 0
# Rounds per block of the output's prefix sums: about a million tokens.
BLOCK_ROUNDS = 1024
# Last slots are dealt to so many blocks behind all others.
TAIL_BLOCKS = 256
TAIL_FIRST = 1 << 40


def token_table(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Documents in queues: doc_id, queue, task, place (tokens before it in its queue and task), n, width, ids."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, kind = tokenizer_cache(tokenizer_path)
        end = np.array([END_OF_TEXT], kind).tobytes()
        task, sent = TaskContext.get().partitionId(), {}
        for batch in batches:
            queues = [queue or "" for queue in batch.column(2).to_pylist()]
            ids = [b"".join([*found, end]) for found in cache.of([text or "" for text in batch.column(1).to_pylist()])]
            places, sizes = [], [len(one) // kind.itemsize for one in ids]
            for queue, size in zip(queues, sizes, strict=True):
                places.append(sent.get(queue, 0))
                sent[queue] = places[-1] + size
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(queues), pa.array([task] * len(ids), pa.int32()), pa.array(places, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array([kind.itemsize] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                ["doc_id", "queue", "task", "place", "n", "width", "ids"],
            )

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("source").cast("string").alias("source")).mapInArrow(
        run, "doc_id bigint, queue string, task int, place bigint, n bigint, width int, ids binary"
    )


PIECE_SCHEMA = (
    "doc_id bigint, queue string, place bigint, start bigint, length bigint, doc_tokens bigint, "
    "slot bigint, crc bigint, ids binary"
)
# Pieces gathered before they are handed on.
PIECES = 1 << 16


def _cut(slot_tokens: int):
    """Cut documents (doc_id, queue, place, n, total, width, ids) at the ends of slots; ids go along for a slot that is not full."""

    def pieces(batch: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
        """Pieces of the documents at some rows of a batch, from arrays per document."""
        starts, stops, slots, crcs, tails = (list(column) for column in zip(*found, strict=True))
        rows = np.repeat(at, [len(one) for one in starts])
        start, slot = np.concatenate(starts), np.concatenate(slots)
        place, n = (batch.column(name).to_numpy()[rows] for name in ("place", "n"))
        ids = pa.nulls(len(rows), pa.binary())
        if any(tails):
            ids = pa.array([one for own, tail in zip(starts, tails, strict=True) for one in [None] * (len(own) - len(tail)) + tail], pa.binary())
        columns = [
            batch.column("doc_id").take(pa.array(rows)), batch.column("queue").take(pa.array(rows)), pa.array(place + start), pa.array(start),
            pa.array(np.concatenate(stops) - start), pa.array(n), pa.array(slot), pa.array([c for own in crcs for c in own], pa.int64()), ids,
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in PIECE_SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found, gathered = [], [], 0
            names = ("place", "n", "total", "width", "ids")
            for row, (place, n, total, width, ids) in enumerate(zip(*(batch.column(name).to_pylist() for name in names), strict=True)):
                slots = np.arange(place // slot_tokens, (place + n - 1) // slot_tokens + 1)
                starts = np.maximum(slots * slot_tokens - place, 0)
                stops = np.append(starts[1:], n)
                data = memoryview(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                parts = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                full = total // slot_tokens
                found.append((starts, stops, slots, map(zlib.crc32, parts), [bytes(parts[-1])] if slots[-1] >= full else []))
                at.append(row)
                gathered += len(parts)
                if gathered >= PIECES:
                    yield pieces(batch, at, found)
                    at, found, gathered = [], [], 0
            if at:
                yield pieces(batch, at, found)

    return run


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    shares: Mapping[str, float] | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    slot_tokens: int = SLOT_TOKENS,
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``shares`` gives target shares of sources; a source that it does not name gets its
    share of all tokens, and without ``shares`` so does every source. Shares are relative
    to their sum. When a source runs out, the others go on in proportion.
    """
    if sequence_tokens % slot_tokens:
        raise ValueError("sequence_tokens must be a multiple of slot_tokens")
    tokens = written(token_table(documents, tokenizer_path), "packing-tokens")
    per_task = tokens.groupBy("queue", "task").agg(F.sum("n").alias("sent"))
    before = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select(
        "queue",
        "task",
        F.coalesce(F.sum("sent").over(before), F.lit(0)).alias("base"),
        F.sum("sent").over(Window.partitionBy("queue")).alias("total"),
    )
    all_tokens = tokens.agg(F.sum("n")).first()[0] or 0
    bases = written(bases, "packing-queues")
    placed = tokens.join(bases, ["queue", "task"]).select(
        "doc_id", "queue", (F.col("place") + F.col("base")).alias("place"), "n", "total", "width", "ids"
    )
    # Pieces carry the queue's total implicitly: the last slot is known where they are cut.
    pieces = written(placed.mapInArrow(_cut(slot_tokens), PIECE_SCHEMA), "packing-pieces")
    share = F.col("total") / F.lit(float(max(all_tokens, 1)))
    if shares:
        named = F.create_map(*(F.lit(part) for pair in shares.items() for part in pair))
        share = F.coalesce(named[F.col("queue")].cast("double"), share)
    weights = bases.groupBy("queue").agg(F.max("total").alias("total")).withColumn("share", share)
    whole = weights.agg(F.sum("share")).first()[0] or 1.0
    quanta = weights.select("queue", (F.col("share") * sequence_tokens / whole).alias("quantum"))
    rounds = F.ceil((F.col("slot") + 1) * slot_tokens / F.col("quantum")).cast("bigint")
    tail = F.col("ids").isNotNull()
    tail_block = F.lit(TAIL_FIRST) + F.pmod(F.xxhash64("queue"), F.lit(TAIL_BLOCKS))
    dealt = pieces.join(quanta, "queue").select(
        "doc_id", "queue", "place", "start", "length", "doc_tokens", "crc", "ids",
        F.when(tail, F.lit(0)).otherwise(rounds).alias("round"),
        F.when(tail, tail_block).otherwise(F.floor(rounds / BLOCK_ROUNDS)).cast("bigint").alias("block"),
    )
    ahead = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("block").agg(F.sum("length").alias("size"))
    blocks = written(blocks.select("block", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("block_at")), "packing-blocks")
    inside = Window.partitionBy("block").orderBy("round", "queue", "place").rowsBetween(Window.unboundedPreceding, -1)
    laid = dealt.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(blocks, "block")
    laid = laid.withColumn("at", F.col("inside") + F.col("block_at"))
    room = F.lit(sequence_tokens) - F.pmod("at", F.lit(sequence_tokens))
    # Full slots end with their sequence at the latest; a last slot can cross an end and is cut there.
    part = lambda skip, length, crc: F.struct(
        skip.cast("bigint").alias("skip"), length.cast("bigint").alias("length"), crc.cast("bigint").alias("crc")
    )
    head = F.crc32(F.substring("ids", F.lit(1), (4 * room).cast("int")))
    rest = F.crc32(F.substring("ids", (4 * room + 1).cast("int"), (4 * (F.col("length") - room)).cast("int")))
    parts = F.when(
        F.col("length") <= room, F.array(part(F.lit(0), F.col("length"), F.col("crc")))
    ).otherwise(F.array(part(F.lit(0), room, head), part(room, F.col("length") - room, rest)))
    found = laid.select("doc_id", "start", "doc_tokens", "at", F.explode(parts).alias("part"))
    at = F.col("at") + F.col("part.skip")
    return found.select(
        "doc_id",
        (F.col("start") + F.col("part.skip")).alias("start"),
        F.col("part.length").alias("length"),
        F.col("part.crc").alias("ids_crc32"),
        "doc_tokens",
        F.floor(at / sequence_tokens).cast("bigint").alias("sequence_id"),
        F.pmod(at, F.lit(sequence_tokens)).cast("bigint").alias("offset"),
    )


def op2_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens, sources in their shares of the corpus."""
    return pack(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
