"""Collapse of repeated observations, conflicts, and the quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from envlake.domain import IDENTITY, KEY, NANO_COLUMNS, OBSERVATION_COLUMNS, PARAMETERS
from envlake.errors import ConflictError, InputError
from envlake.functions.text import path_parts
from envlake.operators.normalize import BROKEN_FILE, MARKERS

PAYLOAD = tuple(
    name for name in (*OBSERVATION_COLUMNS, *NANO_COLUMNS) if name not in IDENTITY
)

# Columns of the kept copies that the quality report reads.
REPORTED = ("unit", "value")


def collapse(normalized: DataFrame, payload: Sequence[str] = PAYLOAD) -> DataFrame:
    """One row per identity, plus one row per rejection reason.

    A single aggregation yields the kept rows, the conflicts and every count of
    the quality report. Copies combine before the shuffle, so neither an often
    repeated identity nor a common reason loads one task. The kept copy is the
    first in path order, then in position.

    Wide rows are sorted, so a reader of few columns names them in ``payload``. Rows that
    were normalized without signature are collapsed without telling conflicts.
    """
    signed = "signature" in normalized.columns
    order = F.struct(path_parts(F.col("source_file")), F.coalesce("position", F.lit(-1)))
    signature = ("signature",) if signed else ()
    kept = F.struct(*payload, "envelope_error", *signature, order.alias("source_order"))
    extremes = [F.min("signature").alias("lowest_signature"), F.max("signature").alias("highest_signature")] if signed else []
    conflicting = [(F.col("lowest_signature") != F.col("highest_signature")).alias("conflicting")] if signed else []
    return (
        normalized.groupBy("reject_reason", *IDENTITY)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            # A file shows up once as its record 0 or as its marker row.
            F.count_if(F.coalesce("position", F.lit(0)) == 0).alias("files"),
            *extremes,
            F.min_by(kept, order).alias("kept"),
        )
        .select(
            "reject_reason",
            *IDENTITY,
            "copies",
            "files",
            *conflicting,
            "kept.*",
        )
    )


def processed_rows(collapsed: DataFrame) -> DataFrame:
    """The 19 observation columns and nanosecond remainders of valid rows."""
    valid = collapsed.filter("reject_reason IS NULL")
    return valid.select(*OBSERVATION_COLUMNS, *NANO_COLUMNS)


def conflicts(collapsed: DataFrame) -> DataFrame:
    """Identities whose copies differ in content."""
    broken = collapsed.filter("reject_reason IS NULL AND conflicting")
    return broken.select(*KEY, *NANO_COLUMNS, "copies")


def require_publishable(collapsed: DataFrame) -> None:
    """Refuse broken files and conflicting copies, naming the first of each."""
    first_file = (
        collapsed.filter(F.col("reject_reason") == BROKEN_FILE)
        .select("source_file", "envelope_error")
        .first()
    )
    if first_file is not None:
        raise InputError(f"{first_file.source_file}: {first_file.envelope_error}")
    first = conflicts(collapsed).orderBy(*IDENTITY).first()
    if first is not None:
        raise ConflictError(
            f"Conflicting observation: location={first.location_id}, sensor={first.sensor_id}, "
            f"parameter={first.parameter}, period={first.datetime_from_utc} to {first.datetime_to_utc}"
        )


def quality_report(collapsed: DataFrame) -> DataFrame:
    """One row of counts, with maps by reason and by parameter."""
    reason = F.col("reject_reason")
    valid = reason.isNull()
    marker = F.coalesce(reason.isin(*MARKERS), F.lit(False))
    slim = collapsed.withColumn(
        "group", F.when(~valid & ~marker, F.concat(F.lit("r:"), reason)).when(valid, F.col("parameter"))
    )
    grouped = slim.groupBy("group", F.when(valid, F.col("unit")).alias("unit")).agg(
        F.sum("files").alias("files"),
        F.sum(F.when(~marker, F.col("copies")).otherwise(0)).alias("records"),
        F.sum(F.when(valid, F.col("copies")).otherwise(0)).alias("valid"),
        F.count_if(valid).alias("kept"),
        F.count_if(valid & (F.col("value") < 0)).alias("negative"),
    )
    rejected = F.col("group").startswith("r:")
    reasons = F.collect_list(
        F.when(
            rejected,
            F.struct(F.substring("group", 3, 100).alias("key"), F.col("records").alias("value")),
        )
    )

    def kept_of(parameter: str):
        return F.coalesce(
            F.sum(F.when(F.col("group") == parameter, F.col("kept"))), F.lit(0)
        ).cast("bigint")

    def units_of(parameter: str):
        return F.array_sort(F.collect_set(F.when(F.col("group") == parameter, F.col("unit"))))

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    # From here on there is one row per reason and per (parameter, unit).
    return grouped.agg(
        total("files").alias("raw_files_discovered"),
        total("records").alias("raw_measurement_records_read"),
        total("valid").alias("valid_observations_before_deduplication"),
        (total("records") - total("valid")).alias("invalid_observations_rejected"),
        F.map_from_entries(F.array_sort(reasons)).alias("rejection_counts_by_reason"),
        (total("valid") - total("kept")).alias("identical_duplicates_removed"),
        total("kept").alias("final_processed_row_count"),
        total("negative").alias("negative_measurement_count"),
        F.create_map(
            *(part for name in PARAMETERS for part in (F.lit(name), kept_of(name)))
        ).alias("counts_by_parameter"),
        F.create_map(
            *(part for name in PARAMETERS for part in (F.lit(name), units_of(name)))
        ).alias("observed_units_by_parameter"),
    )


def report_lines(report: DataFrame) -> DataFrame:
    """The counts of the report as (metric, item, n)."""
    plain = [
        "raw_files_discovered",
        "raw_measurement_records_read",
        "valid_observations_before_deduplication",
        "invalid_observations_rejected",
        "identical_duplicates_removed",
        "final_processed_row_count",
        "negative_measurement_count",
    ]
    single = F.array(
        *(
            F.struct(F.lit(name).alias("metric"), F.lit("").alias("item"), F.col(name).alias("n"))
            for name in plain
        )
    )

    def entries(column: str):
        return F.transform(
            F.map_entries(column),
            lambda entry: F.struct(
                F.lit(column).alias("metric"),
                entry["key"].alias("item"),
                entry["value"].alias("n"),
            ),
        )

    lines = F.concat(single, entries("rejection_counts_by_reason"), entries("counts_by_parameter"))
    return report.select(F.inline(lines))
