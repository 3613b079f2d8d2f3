"""Replay of the driver's envelopes as a stream of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from envlake.plans.driver_tables import DriverTables
from envlake.session import workspace
from envlake.streaming.incremental import IncrementalBuild, read_registered

MICRO_BATCHES = 2
LANDED_FILES = 8


def replay_daily_mart(t: DriverTables) -> DataFrame:
    """Land all envelopes in files, stream them in micro-batches, return the mart."""
    folder = workspace(t.spark, "replay")
    landed = f"{folder}/landed"
    # Written a file per group, so the number of files is known and none need be listed.
    arrival = F.pmod(F.xxhash64("path"), F.lit(LANDED_FILES)).cast("int")
    t.envelopes().repartitionByRange(LANDED_FILES, arrival).write.parquet(landed)
    build = IncrementalBuild(t.spark, f"{folder}/state", t.locations)
    stream = read_registered(t.spark, landed, files_per_batch=-(-LANDED_FILES // MICRO_BATCHES))
    query = build.start(stream)
    query.awaitTermination()
    return build.daily_mart().select(
        "measurement_date_utc",
        "location_id",
        "parameter",
        "unit",
        "observation_count",
        "average_value",
        "minimum_value",
        "maximum_value",
    )
