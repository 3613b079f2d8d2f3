"""Helpers that the operators share: written tables, folds, unused names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.session import workspace

# White space of the contracts: space and the five ASCII controls from tab on.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows below the shared folder and read them back: a cut in lineage that outlives executors."""
    spark = rows.sparkSession
    path = workspace(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Keep Arrow batches small: whole texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for rows whose crc32(doc_id as text) leaves remainder 2 by 4; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """A column name like ``wanted`` that no given column has, whatever its case."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted
