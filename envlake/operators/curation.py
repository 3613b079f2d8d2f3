"""Curation: contract of processed rows, typed columns, manifest, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import (
    IDENTITY,
    KEY,
    MAX_ID,
    NANO_COLUMNS,
    OBSERVATION_COLUMNS,
    PARAMETERS,
    PARTITIONS,
    REQUIRED_COLUMNS,
    SOURCE,
)
from envlake.functions import instants, rules, text
from envlake.functions.plans import compute_once
from envlake.functions.rules import failed
from envlake.sources.tables import require_columns

IDENTIFIERS = ("location_id", "sensor_id", "parameter_id")
NUMBERS = ("value", "latitude", "longitude")
BOUNDARIES = ("datetime_from_utc", "datetime_to_utc")
# Prefix of typed values beside their text.
TYPED = "typed_"
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _identifier(value: Column) -> Column:
    """Identifier of ASCII digits; the cast refuses what exceeds 64 bits."""
    return F.when(value.rlike("^[0-9]+$"), value.try_cast("bigint"))


def _number(value: Column) -> Column:
    number = F.when(value.rlike(NUMBER_TEXT), value.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def parse_text(rows: DataFrame) -> DataFrame:
    """Text rows beside their typed values, each parsed once."""
    require_columns(rows, set(REQUIRED_COLUMNS), "processed input")
    present = set(rows.columns)
    typed = {name: _identifier(F.col(name)) for name in IDENTIFIERS if name in present}
    typed |= {name: _number(F.col(name)) for name in NUMBERS if name in present}
    for name, nanos in zip(BOUNDARIES, NANO_COLUMNS, strict=True):
        typed[name] = instants.parse_instant(F.col(name))
        typed[nanos] = instants.nanosecond_remainder(F.col(name))
    texts = {name: F.col(name) for name in rows.columns}
    return compute_once(rows, texts | {f"{TYPED}{name}": value for name, value in typed.items()})


def text_rules(columns: list[str]) -> dict[str, Column]:
    """Contract of processed text rows, over the columns of ``parse_text``."""
    typed = {name: F.col(TYPED + name) for name in (*IDENTIFIERS, *NUMBERS, *BOUNDARIES)}
    checks = {
        "source": failed(F.col("source") == SOURCE),
        "parameter": failed(F.col("parameter").isin(*PARAMETERS)),
        "unit": text.is_blank(F.col("unit")),
    }
    for name in IDENTIFIERS:
        if name in columns:
            broken = failed(typed[name].between(1, MAX_ID))
            optional = name == "parameter_id"
            checks[name] = broken & F.col(name).isNotNull() if optional else broken
    for name in NUMBERS:
        if name in columns:
            broken = typed[name].isNull()
            checks[name] = broken if name == "value" else broken & F.col(name).isNotNull()
    for name in BOUNDARIES:
        checks[name] = typed[name].isNull()
    start, end = (F.struct(TYPED + b, TYPED + n) for b, n in zip(BOUNDARIES, NANO_COLUMNS, strict=True))
    both = ~checks["datetime_from_utc"] & ~checks["datetime_to_utc"]
    checks["period"] = both & failed(end > start)
    if "measurement_date_utc" in columns:
        day = F.date_format(F.to_date(typed["datetime_to_utc"]), "yyyy-MM-dd")
        checks["measurement_date_utc"] = ~checks["datetime_to_utc"] & failed(
            F.col("measurement_date_utc") == day
        )
    return checks


def text_violations(rows: DataFrame) -> DataFrame:
    """(rule, violations) over all rules, from one pass over the text rows."""
    return rules.violation_report(parse_text(rows), text_rules(rows.columns))


def clean_text_rows(rows: DataFrame) -> DataFrame:
    """Typed curated rows of the text rows that keep the whole contract."""
    parsed = parse_text(rows)
    return restore_types(parsed.filter(rules.first_violation(text_rules(rows.columns)).isNull()))


def restore_types(parsed: DataFrame) -> DataFrame:
    """Typed curated rows of parsed text rows."""
    names = [name for name in parsed.columns if not name.startswith(TYPED)]
    typed = [name.removeprefix(TYPED) for name in parsed.columns if name.startswith(TYPED)]
    plain = [F.col(name) for name in names if name not in typed]
    return curated_columns(
        parsed.select(*plain, *(F.col(TYPED + name).alias(name) for name in typed))
    )


def curated_columns(rows: DataFrame) -> DataFrame:
    """Model columns first, further columns by name, UTC date of period end last."""
    known = [name for name in OBSERVATION_COLUMNS if name in rows.columns]
    derived = {"measurement_date_utc"}
    further = sorted(set(rows.columns) - set(known) - derived)
    return rows.select(
        *known, *further, F.to_date("datetime_to_utc").alias("measurement_date_utc")
    )


def typed_rules() -> dict[str, Column]:
    """Contract of typed processed rows, for input that never was text."""
    finite = {name: ~F.isnan(name) & (F.abs(name) < F.lit(float("inf"))) for name in NUMBERS}
    start = F.struct("datetime_from_utc", "datetime_from_ns")
    end = F.struct("datetime_to_utc", "datetime_to_ns")
    return {
        "source": failed(F.col("source") == SOURCE),
        "parameter": failed(F.col("parameter").isin(*PARAMETERS)),
        "unit": text.is_blank(F.col("unit")),
        "location_id": failed(F.col("location_id") > 0),
        "sensor_id": failed(F.col("sensor_id") > 0),
        "parameter_id": F.col("parameter_id").isNotNull() & failed(F.col("parameter_id") > 0),
        "value": failed(finite["value"]),
        "latitude": F.col("latitude").isNotNull() & failed(finite["latitude"]),
        "longitude": F.col("longitude").isNotNull() & failed(finite["longitude"]),
        "datetime_from_utc": F.col("datetime_from_utc").isNull(),
        "datetime_to_utc": F.col("datetime_to_utc").isNull(),
        "period": failed(end > start),
    }


def curate(processed: DataFrame) -> DataFrame:
    """Gate typed processed rows and derive the curated columns."""
    require_columns(processed, set(REQUIRED_COLUMNS), "processed input")
    rules.require_clean(processed, typed_rules(), "processed input")
    rules.require_unique(processed, IDENTITY, "processed input")
    return curated_columns(processed)


def curate_text(rows: DataFrame) -> DataFrame:
    """Gate text rows and return them typed."""
    parsed = parse_text(rows)
    rules.require_clean(parsed, text_rules(rows.columns), "processed input")
    typed = restore_types(parsed)
    rules.require_unique(typed, IDENTITY, "processed input")
    return typed


def curated_manifest(curated: DataFrame) -> DataFrame:
    """One row of totals.

    Rows collapse to (partition, location, sensor) first: the exact distinct
    counts then run over sensor-days instead of observations.
    """
    days = curated.groupBy(*PARTITIONS, "location_id", "sensor_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("datetime_from_utc").alias("first"),
        F.max("datetime_to_utc").alias("last"),
    )
    sensors = days.groupBy("location_id", "sensor_id").agg(
        *(
            F.sum(F.when(F.col("parameter") == name, F.col("n")).otherwise(0)).alias(name)
            for name in PARAMETERS
        ),
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    totals = sensors.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(f"{name}_rows") for name in PARAMETERS),
        F.count_distinct("location_id").alias("location_count"),
        F.count_distinct("sensor_id").alias("sensor_count"),
        F.min("first").alias("earliest_measurement_start_utc"),
        F.max("last").alias("latest_measurement_end_utc"),
    )
    partitions = days.select(*PARTITIONS).distinct().agg(F.count(F.lit(1)).alias("c"))
    return totals.withColumn("partition_count", partitions.scalar())


def content_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus of ``actual``.

    One aggregation over both sides; copies combine before the shuffle.
    """
    if set(expected.columns) != set(actual.columns):
        raise ValueError("Columns differ.")
    columns = expected.columns
    signed = expected.withColumn("side", F.lit(-1).cast("bigint")).unionByName(
        actual.withColumn("side", F.lit(1).cast("bigint"))
    )
    return (
        signed.groupBy(*columns)
        .agg(F.sum("side").alias("surplus"))
        .filter("surplus <> 0")
    )


def enrichment_input_rules() -> dict[str, Column]:
    """Contract of curated rows before the weather join."""
    return {
        "source": failed(F.col("source") == SOURCE),
        "parameter": failed(F.col("parameter").isin(*PARAMETERS)),
        "location_id": failed(F.col("location_id") > 0),
        "sensor_id": failed(F.col("sensor_id") > 0),
        "null_key": F.greatest(*(F.col(name).isNull() for name in KEY)),
        "period": failed(F.col("datetime_to_utc") > F.col("datetime_from_utc")),
        "measurement_date_utc": failed(
            F.col("measurement_date_utc") == F.to_date("datetime_to_utc")
        ),
    }


