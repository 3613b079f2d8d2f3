"""Micro-batch build of processed observations and the daily mart.

Late and overlapping batches are never dropped, so there is no watermark. The processed
set is a table of leveled runs: every micro-batch adds the rows it contributes, and a read
keeps, per identity, the copy that is first in path order. Copies agree in content, so a
batch changes the mart by its new identities alone: their counts, sums and extremes are
added as a run of partial aggregates, and the mart of the touched days is merged of those.
The result equals a full rebuild whatever order the batches arrive in.

A batch reads, of earlier rows, identity, signature and order of the touched days and
hash buckets, and the partial aggregates of the touched days; full levels are merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from envlake.domain import IDENTITY, NANO_COLUMNS, OBSERVATION_COLUMNS, column_type
from envlake.errors import ConflictError
from envlake.operators import dedup, enrichment, models
from envlake.operators.normalize import normalize
from envlake.session import configure
from envlake.sinks.registry import REGISTRY_DDL
from envlake.sources import envelopes
from envlake.streaming.runs import DAY, FAN_OUT, Commits, LeveledTable, Run

LOG_COLUMNS = (*OBSERVATION_COLUMNS, *NANO_COLUMNS, "signature", "source_order")


def read_landed_files(spark: SparkSession, raw_dir: str, files_per_batch: int = 10_000) -> DataFrame:
    """Stream of (path, content), one JSON document per new file."""
    stream = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{raw_dir.rstrip('/')}/{envelopes.RAW_SUBDIR}")
    )
    return stream.select(
        envelopes.relative_path(F.col("_metadata.file_path")).alias("path"),
        F.col("value").alias("content"),
    )


def read_registered(spark: SparkSession, registry_path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of (path, content) from the registry table."""
    stream = (
        spark.readStream.schema(REGISTRY_DDL)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(registry_path)
    )
    return stream.select("path", "content")


# Hash buckets of identities, in whose order rows lie in a run.
BUCKETS = 64
ORDER_DDL = "struct<col1: array<string>, col2: int>"
LOG_DDL = (
    ", ".join(f"{name} {column_type(name)}" for name in (*OBSERVATION_COLUMNS, *NANO_COLUMNS))
    + f", signature string, source_order {ORDER_DDL}, bucket int"
)
PARTIAL_GRAIN = tuple(name for name in models.DAILY_GRAIN if name != DAY)
PARTIAL_DDL = (
    ", ".join(f"{name} {column_type(name)}" for name in PARTIAL_GRAIN)
    + ", n bigint, total double, least double, greatest double, with_weather bigint"
)


def best_copies(log: DataFrame) -> DataFrame:
    """Per identity, the copy that is first in path order."""
    rest = [name for name in log.columns if name not in IDENTITY]
    kept = F.min_by(F.struct(*rest), "source_order")
    return log.groupBy(*IDENTITY).agg(kept.alias("kept")).select(*IDENTITY, "kept.*")


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partial aggregates added up per day and grain."""
    return partials.groupBy(DAY, *PARTIAL_GRAIN).agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.sum("with_weather").alias("with_weather"),
    )


@dataclass
class IncrementalBuild:
    """State of an incremental build below one folder."""

    spark: SparkSession
    folder: str
    locations: DataFrame
    hours: DataFrame | None = None
    fan_out: int = FAN_OUT

    def __post_init__(self) -> None:
        self.log = LeveledTable(self.spark, f"{self.folder}/log", LOG_DDL, best_copies, ("bucket",), self.fan_out)
        self.partials = LeveledTable(self.spark, f"{self.folder}/partials", PARTIAL_DDL, merged_partials, (), self.fan_out)
        self.commits = Commits(self.spark, f"{self.folder}/commits")

    def start(self, landed: DataFrame) -> StreamingQuery:
        """Process everything that has landed, then stop; restartable."""
        configure(self.spark)
        return (
            landed.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def apply(self, files: DataFrame, batch_id: int) -> None:
        """Contribute one micro-batch. Running it again has no further effect."""
        staged = self._stage(files, batch_id)
        dedup.require_publishable(staged)
        state = self.commits.before(batch_id)
        valid = self._dated(staged.filter("reject_reason IS NULL").select(*LOG_COLUMNS))
        # One entry per UTC day and per bucket: bounded by the calendar, not by the data.
        touched = valid.agg(F.collect_set(DAY).alias("days"), F.collect_set("bucket").alias("buckets")).first()
        if touched.days:
            compared = self._compared(valid, state.get("log", []), touched.days, touched.buckets, batch_id)
            state = {
                "log": self.log.add(state.get("log", []), compared.filter("earlier").drop("new", "earlier"), batch_id),
                "partials": self.partials.add(state.get("partials", []), self._partials_of(compared.filter("new")), batch_id),
            }
        self.commits.write(batch_id, state)
        if touched.days:
            self._refresh(state["partials"], touched.days)

    def processed(self, days: list[date] | None = None) -> DataFrame:
        """Observations so far; with ``days``, of those partitions only."""
        best = best_copies(self.log.read(self.commits.newest().get("log", []), days))
        return best.select(*OBSERVATION_COLUMNS, *NANO_COLUMNS, DAY)

    def daily_mart(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.folder}/daily")
        return rows.withColumn(DAY, F.col(DAY).cast("date"))

    # -- steps of a micro-batch ---------------------------------------------------

    def _stage(self, files: DataFrame, batch_id: int) -> DataFrame:
        """Parse and collapse once; everything later reads this table."""
        parsed = envelopes.parse_envelopes(files)
        collapsed = dedup.collapse(normalize(envelopes.split_records(parsed)))
        return self._written(collapsed, f"staged/batch-{batch_id}")

    def _compared(self, valid: DataFrame, runs: list[Run], days: list[date], buckets: list[int], batch_id: int) -> DataFrame:
        """Rows of a batch beside what is known: ``new`` identities, and copies ``earlier`` than the known ones."""
        known = self.log.read(runs, days)
        if len(buckets) < BUCKETS:
            known = known.filter(F.col("bucket").isin(buckets))
        known = known.groupBy(*IDENTITY).agg(
            F.min("signature").alias("known_signature"), F.min("source_order").alias("known_order")
        )
        joined = valid.join(known, list(IDENTITY), "left")
        flags = joined.select(
            *valid.columns,
            F.col("known_order").isNull().alias("new"),
            (F.col("known_order").isNull() | (F.col("source_order") < F.col("known_order"))).alias("earlier"),
            (F.col("known_signature") != F.col("signature")).alias("clash"),
        )
        compared = self._written(flags, f"compared/batch-{batch_id}")
        clash = compared.filter("clash").select(*IDENTITY).first()
        if clash is not None:
            raise ConflictError(f"Conflicting observation: {clash.asDict()}")
        return compared.drop("clash")

    def _partials_of(self, rows: DataFrame) -> DataFrame:
        """Partial aggregates of observations."""
        if self.hours is not None:
            rows = enrichment.join_weather(rows, self.hours)
        else:
            rows = rows.withColumn("weather_source", F.lit(None).cast("string"))
        return rows.groupBy(DAY, *PARTIAL_GRAIN).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("value").alias("total"),
            F.min("value").alias("least"),
            F.max("value").alias("greatest"),
            F.count("weather_source").alias("with_weather"),
        )

    def _refresh(self, runs: list[Run], days: list[date]) -> None:
        """Write the mart of the touched days, merged of partial aggregates."""
        mart = models.daily_mart_of_partials(merged_partials(self.partials.read(runs, days)), self.locations)
        (
            mart.hint("rebalance", DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(f"{self.folder}/daily")
        )

    # -- storage --------------------------------------------------------------------

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @staticmethod
    def _dated(rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*IDENTITY), F.lit(BUCKETS)).cast("int")
        return rows.withColumns({DAY: F.to_date("datetime_to_utc"), "bucket": bucket})
