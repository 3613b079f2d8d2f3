"""Exact deduplication over a sharded cuckoo-filter index of content digests.

Texts are equal when they are identical after each run of white space became one
space; null counts as empty. The digest is the SHA-256 of the normalised UTF-8 text.
Input tasks first combine their own copies in a small index, so that one text that a
third of all rows carry sends one row per task. Shards of the digest space then hold
disjoint parts of the index. Ids are compared as numbers, null last; of repeated rows
with the same id one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from envlake.llm.cuckoo import CuckooIndex
from envlake.llm.tables import SPACE_CLASS, read_table, written

INDEX_SCHEMA = "digest binary, keep_id bigint, copies bigint"
ARROW_INDEX = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("copies", pa.int64())])
# Entries an input task gathers before it hands them on; bounds its memory.
LOCAL_ENTRIES = 1 << 17


def text_digest(text: Column) -> Column:
    """SHA-256, lowercase hex, of the text with each run of white space replaced by one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ").cast("binary"), 256)


def _batches(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    entries = list(index.items())
    for at in range(0, len(entries), 1 << 16):
        columns = list(zip(*entries[at : at + (1 << 16)], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(columns, ARROW_INDEX, strict=True)],
            schema=ARROW_INDEX,
        )


def _fold(limit: int | None):
    """Fold rows of (digest, keep_id, copies) into an index; negative copies are deletions.

    With a limit, the index is emptied whenever it holds so many digests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, gone = CuckooIndex(), []
        for batch in batches:
            for digest, keep_id, copies in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if copies < 0:
                    gone.append((digest, -copies))
                    continue
                index.insert(digest, keep_id, copies)
                if limit and index.live >= limit:
                    yield from _batches(index)
                    index = CuckooIndex()
        for digest, copies in gone:
            index.delete(digest, copies)
        yield from _batches(index)

    return run


def _combined(rows: DataFrame) -> DataFrame:
    """Index rows in which each task has folded its own copies."""
    return rows.mapInArrow(_fold(LOCAL_ENTRIES), INDEX_SCHEMA)


def update_index(index: DataFrame | None, inserted: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Index after insertions, then deletions.

    ``inserted`` and ``deleted`` have (digest binary, doc_id). The result has one row
    per live digest: digest, keep_id (smallest id inserted while it lived), copies.
    Deleting a digest that is not live has no effect.
    """
    rows = _combined(inserted.select("digest", F.col("doc_id").cast("bigint").alias("keep_id"), F.lit(1).cast("bigint").alias("copies")))
    if index is not None:
        rows = rows.unionByName(index.select("digest", "keep_id", "copies"))
    if deleted is not None:
        less = _combined(deleted.select("digest", F.lit(None).cast("bigint").alias("keep_id"), F.lit(1).cast("bigint").alias("copies")))
        rows = rows.unionByName(less.withColumn("copies", -F.col("copies")))
    return rows.repartition("digest").mapInArrow(_fold(None), INDEX_SCHEMA)


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, keep_id, group_size, kept, text_sha256."""
    digested = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(text_digest(F.col("text"))).alias("digest"))
    rows = written(digested, "exact-dedup-digests")
    groups = update_index(None, rows).filter(F.col("copies") > 1)
    same_row = Window.partitionBy("doc_id", "digest").orderBy("doc_id")
    numbered = rows.withColumn("repeat", F.row_number().over(same_row))
    joined = numbered.join(groups, "digest", "left")
    keep_id = F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("group_size"),
        ((F.col("repeat") == 1) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact duplicates among all documents."""
    return exact_duplicates(read_table(spark, folder, "documents"))


OP3_SQL = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM digests
"""
