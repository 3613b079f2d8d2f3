"""Leveled runs: tables that grow by micro-batches and are merged as they age.

Every micro-batch writes its rows as one run of level 0. Where a level holds ``fan_out``
runs, they are merged into one run of the next level. A commit names the live runs after a
batch, so a reader meets a number of runs that grows with the logarithm of the batches,
and a row is rewritten once per level. Names of runs and commits follow from the batch:
running a batch again writes the same names anew, and what a failed batch left behind is
named by no commit. Nothing is renamed or deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from envlake.errors import InputError, is_missing_path

FAN_OUT = 4
DAY = "measurement_date_utc"

# Level and last batch of a run.
Run = tuple[int, int]


@dataclass
class LeveledTable:
    """One table of runs (columns by ``ddl``, partitioned by day), merged by ``merge``."""

    spark: SparkSession
    folder: str
    ddl: str
    merge: Callable[[DataFrame], DataFrame]
    order_by: Sequence[str] = ()
    fan_out: int = FAN_OUT

    def path(self, run: Run) -> str:
        return f"{self.folder}/run_level={run[0]}/run_batch={run[1]}"

    def read(self, runs: Sequence[Run], days: Sequence | None = None) -> DataFrame:
        """Rows of some runs, not merged; with ``days``, of those partitions only."""
        schema = f"{self.ddl}, {DAY} date"
        if not runs:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(f"{schema}, run_level int, run_batch bigint").option("basePath", self.folder)
        rows = reader.parquet(*map(self.path, runs)).drop("run_level", "run_batch")
        return rows if days is None else rows.filter(F.col(DAY).isin(list(days)))

    def add(self, runs: Sequence[Run], rows: DataFrame, batch_id: int) -> list[Run]:
        """Write rows, if there are any, as a run and merge full levels; returns the live runs."""
        if rows.isEmpty():
            return list(runs)
        live = [*runs, (0, batch_id)]
        self._write(rows, (0, batch_id))
        level = 0
        while len(full := [run for run in live if run[0] == level]) >= self.fan_out:
            merged = (level + 1, batch_id)
            self._write(self.merge(self.read(full)), merged)
            live = [run for run in live if run[0] != level] + [merged]
            level += 1
        return live

    def _write(self, rows: DataFrame, run: Run) -> None:
        shaped = rows.select(*StructType.fromDDL(self.ddl).names, DAY).hint("rebalance", DAY)
        if self.order_by:
            shaped = shaped.sortWithinPartitions(DAY, *self.order_by)
        shaped.write.mode("overwrite").partitionBy(DAY).parquet(self.path(run))


@dataclass
class Commits:
    """Live runs of several tables after each batch."""

    spark: SparkSession
    folder: str

    def before(self, batch_id: int) -> dict[str, list[Run]]:
        """State that a batch builds on: one small file, whatever came earlier."""
        return self._read(batch_id - 1) if batch_id else {}

    def newest(self) -> dict[str, list[Run]]:
        """State after the last batch; only names of commits are read to find it."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(self.folder)
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return {}
        number = F.regexp_extract("path", r"/batch-([0-9]+)/[^/]*$", 1).cast("bigint")
        last = files.agg(F.max(number)).first()[0]
        return {} if last is None else self._read(last)

    def write(self, batch_id: int, state: dict[str, list[Run]]) -> None:
        record = self.spark.range(1).select(F.lit(json.dumps(state)).alias("value"))
        record.coalesce(1).write.mode("overwrite").text(f"{self.folder}/batch-{batch_id:012d}")

    def _read(self, batch_id: int) -> dict[str, list[Run]]:
        row = self.spark.read.schema("value string").text(f"{self.folder}/batch-{batch_id:012d}").first()
        if row is None:
            raise InputError(f"No commit of batch {batch_id} in {self.folder}.")
        return {name: [tuple(run) for run in runs] for name, runs in json.loads(row.value).items()}
