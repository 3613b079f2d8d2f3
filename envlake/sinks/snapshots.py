"""Versioned snapshots: stage, verify, then switch.

A snapshot is a set of Parquet tables below ``<root>/<name>/versions/<version>``.
It becomes current when one small record naming it is appended to
``<root>/<name>/published``; Spark's commit makes that record appear whole or not
at all. Readers follow the latest record, so a failed build leaves the previous
snapshot untouched, and no directory is ever renamed or appended to.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from envlake.errors import InputError, is_missing_path

PUBLISHED_DDL = "version string, published_at bigint, tables array<string>, manifest string"


@dataclass
class Table:
    """A DataFrame with its layout on disk."""

    rows: DataFrame
    partition_by: Sequence[str] = ()
    order_by: Sequence[str] = ()


@dataclass
class SnapshotStore:
    """Published snapshots below one root folder."""

    spark: SparkSession
    root: str
    compression: str = "snappy"
    _now: object = field(default=time.time_ns, repr=False)

    def publish(self, name: str, tables: Mapping[str, Table], manifest=None, check=None) -> str:
        """Write, read back and compare all tables, then make them current.

        ``check`` receives the staged tables and may raise to refuse them. ``manifest`` is
        text, or makes it of the staged tables, so that nothing is computed again for it.
        """
        version = f"v{self._now():020d}-{uuid.uuid4().hex[:8]}"
        base = f"{self.root}/{name}/versions/{version}"
        counts = {}
        for table_name, table in tables.items():
            counts[table_name] = self._write_verified(f"{base}/{table_name}", table)
        staged = {t: self._read_as(f"{base}/{t}", table.rows) for t, table in tables.items()}
        if check is not None:
            check(staged, counts)
        if callable(manifest):
            manifest = manifest(staged)
        record = self.spark.range(1).select(
            F.lit(version).alias("version"),
            F.lit(self._now()).cast("bigint").alias("published_at"),
            F.array(*map(F.lit, tables)).alias("tables"),
            F.lit(manifest).cast("string").alias("manifest"),
        )
        record.coalesce(1).write.mode("append").json(f"{self.root}/{name}/published")
        return version

    def current_version(self, name: str) -> str | None:
        """Version of the current snapshot, or None before the first one."""
        try:
            records = self.spark.read.schema(PUBLISHED_DDL).json(f"{self.root}/{name}/published")
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return None
        return records.agg(F.max_by("version", F.struct("published_at", "version"))).first()[0]

    def path(self, name: str, table: str) -> str:
        """Folder of a table of the current snapshot."""
        version = self.current_version(name)
        if version is None:
            raise InputError(f"No published snapshot of {name}.")
        return f"{self.root}/{name}/versions/{version}/{table}"

    def read(self, name: str, table: str) -> DataFrame:
        """A table of the current snapshot."""
        return self.spark.read.parquet(self.path(name, table))

    def manifest(self, name: str) -> str | None:
        records = self.spark.read.schema(PUBLISHED_DDL).json(f"{self.root}/{name}/published")
        return records.agg(F.max_by("manifest", F.struct("published_at", "version"))).first()[0]

    def _write_verified(self, path: str, table: Table) -> int:
        columns = table.rows.columns
        rows = table.rows
        if table.partition_by:
            # Rebalancing splits a hot partition and merges small ones at runtime.
            rows = rows.hint("rebalance", *table.partition_by)
        if table.order_by:
            rows = rows.sortWithinPartitions(*table.order_by)
        written = Observation()
        # Observed right before the write, so each task's rows count once.
        rows = rows.observe(written, *_fingerprint(columns))
        writer = rows.write.mode("errorifexists").option("compression", self.compression)
        if table.partition_by:
            writer = writer.partitionBy(*table.partition_by)
        writer.parquet(path)
        expected = written.get
        actual = self._read_as(path, table.rows).agg(*_fingerprint(columns)).first().asDict()
        if expected != actual:
            raise InputError(f"Read-back differs from what was written: {path}")
        return actual["n"]

    def _read_as(self, path: str, like: DataFrame) -> DataFrame:
        """Read back with the written schema; partition columns included."""
        found = self.spark.read.schema(like.schema).parquet(path)
        return found.select(*like.columns)


def _fingerprint(columns: Sequence[str]) -> list[Column]:
    """Count and order-free digests of the content, in one pass.

    Two independent 64-bit digests are summed, so equal content always agrees
    and different content practically never does; copies are counted.
    """
    digest = F.xxhash64(*columns)
    other = F.xxhash64(F.lit(7), *reversed(columns))
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(digest.cast("decimal(20,0)")).alias("digest"),
        F.sum(other.cast("decimal(20,0)")).alias("other_digest"),
    ]
