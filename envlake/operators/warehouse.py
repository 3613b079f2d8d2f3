"""Warehouse tables: row rules, the location dimension, load checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import (
    KEY,
    LOCATION_COLUMNS,
    MAX_ID,
    PARAMETERS,
    SOURCE,
    WAREHOUSE_COLUMNS,
    WAREHOUSE_NOT_NULL,
    WEATHER_METRICS,
    WEATHER_SOURCE,
)
from envlake.errors import InputError
from envlake.functions import rules, text
from envlake.functions.rules import failed
from envlake.operators.geography import MAX_LATITUDE, MAX_LONGITUDE, in_bounds

DOUBLES = ("value", "latitude", "longitude", *WEATHER_METRICS, "weather_latitude", "weather_longitude")
ATTRIBUTES = tuple(name for name in LOCATION_COLUMNS if name != "location_id")


def row_rules(columns: list[str]) -> dict[str, Column]:
    """Row contract of the warehouse as named rules; true means broken."""
    col = F.col
    checks = {f"null_{name}": col(name).isNull() for name in WAREHOUSE_NOT_NULL}
    for name in ("location_id", "sensor_id", "parameter_id"):
        checks[f"id_{name}"] = col(name).isNotNull() & failed(col(name).between(1, MAX_ID))
    for name in DOUBLES:
        finite = ~F.isnan(name) & (F.abs(name) < F.lit(float("inf")))
        checks[f"not_finite_{name}"] = col(name).isNotNull() & failed(finite)
    for name in ("datetime_from_ns", "datetime_to_ns"):
        if name in columns:
            checks[f"precision_{name}"] = F.coalesce(col(name) != 0, F.lit(False))
    has_source = col("weather_source").isNotNull()
    hour = col("weather_hour_utc")
    other_weather = F.coalesce(*WEATHER_METRICS, "weather_latitude", "weather_longitude")
    checks |= {
        "source": col("source").isNotNull() & failed(col("source") == SOURCE),
        "parameter": col("parameter").isNotNull() & failed(col("parameter").isin(*PARAMETERS)),
        "unit": col("unit").isNotNull() & text.is_blank(col("unit")),
        "period": col("datetime_from_utc").isNotNull()
        & col("datetime_to_utc").isNotNull()
        & failed(col("datetime_to_utc") > col("datetime_from_utc")),
        "weather_source": has_source & failed(col("weather_source") == WEATHER_SOURCE),
        "weather_hour_missing": has_source & hour.isNull(),
        "weather_without_source": ~has_source & other_weather.isNotNull(),
        "measurement_date_utc": col("measurement_date_utc").isNotNull()
        & failed(col("measurement_date_utc") == F.to_date("datetime_to_utc")),
        "weather_hour_utc": hour.isNotNull()
        & failed(hour == F.date_trunc("HOUR", col("datetime_to_utc"))),
        "latitude": col("latitude").isNotNull()
        & failed(col("latitude").between(-MAX_LATITUDE, MAX_LATITUDE)),
        "longitude": col("longitude").isNotNull()
        & failed(col("longitude").between(-MAX_LONGITUDE, MAX_LONGITUDE)),
    }
    return checks


def violations(enriched: DataFrame) -> DataFrame:
    """Broken rows with the first rule each of them breaks."""
    checks = row_rules(enriched.columns)
    return enriched.withColumn("violation", rules.first_violation(checks)).filter(
        "violation IS NOT NULL"
    )


def location_attributes(enriched: DataFrame) -> DataFrame:
    """Distinct attribute combinations per location.

    A hash aggregation with the attributes as keys: however many rows a
    location has, each task passes on one row per combination.
    """
    return enriched.select(*LOCATION_COLUMNS).distinct()


def dimension_conflicts(enriched: DataFrame) -> DataFrame:
    """(location_id, column) pairs with two different non-null values."""
    spread = location_attributes(enriched).groupBy("location_id").agg(
        *((F.min(name) != F.max(name)).alias(name) for name in ATTRIBUTES)
    )
    names = F.filter(
        F.array(*(F.when(F.col(name), F.lit(name)) for name in ATTRIBUTES)),
        lambda name: name.isNotNull(),
    )
    return spread.select("location_id", F.explode(names).alias("column_name"))


def build_locations(enriched: DataFrame, configured: DataFrame) -> DataFrame:
    """One row per location; the pair comes whole from one origin or is null.

    Assumes that ``dimension_conflicts`` is empty: every attribute then has at
    most one value per location.
    """
    source_pair = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    single = location_attributes(enriched).groupBy("location_id").agg(
        F.max("location_name").alias("location_name"),
        F.max(F.when(source_pair, F.struct("latitude", "longitude"))).alias("pair"),
        F.max("weather_latitude").alias("weather_latitude"),
        F.max("weather_longitude").alias("weather_longitude"),
    )
    complete = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    fallback = configured.filter(complete).select(
        F.col("id").alias("location_id"), F.struct("latitude", "longitude").alias("configured")
    )
    pair = F.coalesce("pair", "configured")
    return single.join(fallback, "location_id", "left").select(
        "location_id",
        "location_name",
        pair["latitude"].alias("latitude"),
        pair["longitude"].alias("longitude"),
        "weather_latitude",
        "weather_longitude",
    )


def prepare_load(enriched: DataFrame, configured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gate enriched rows; return the location and observation tables."""
    rules.require_clean(enriched, row_rules(enriched.columns), "warehouse input")
    rules.require_unique(enriched, KEY, "warehouse input")
    conflict = dimension_conflicts(enriched).first()
    if conflict is not None:
        raise InputError(
            f"warehouse input: conflicting {conflict.column_name} for location {conflict.location_id}"
        )
    locations = build_locations(enriched, configured)
    off_map = locations.filter(
        F.col("latitude").isNotNull() & ~in_bounds(F.col("latitude"), F.col("longitude"))
    ).first()
    if off_map is not None:
        raise InputError(f"warehouse input: invalid coordinates for location {off_map.location_id}")
    return locations, enriched.select(*WAREHOUSE_COLUMNS)


def load_checks(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """One row: rows, locations, duplicate keys, bad parameters, orphans."""
    return observations.agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_if(failed(F.col("parameter").isin(*PARAMETERS))).alias("bad_parameters"),
    ).select(
        "observations",
        locations.agg(F.count(F.lit(1)).alias("n")).scalar().alias("locations"),
        rules.duplicate_keys(observations, KEY).agg(F.count(F.lit(1)).alias("n")).scalar().alias(
            "duplicate_keys"
        ),
        "bad_parameters",
        orphan_count(observations, locations).scalar().alias("orphans"),
    )


def orphan_count(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Number of observations without a location.

    Rows collapse to one count per location before the anti join.
    """
    per_location = observations.groupBy("location_id").agg(F.count(F.lit(1)).alias("n"))
    return per_location.join(locations, "location_id", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    )


def load_summary(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """One row describing a load."""
    return observations.agg(
        F.count(F.lit(1)).alias("input_observations"),
        F.count(F.lit(1)).alias("observations_loaded"),
        *(F.count_if(F.col("parameter") == name).alias(f"{name}_rows") for name in PARAMETERS),
        F.count("weather_source").alias("weather_matched_rows"),
        (F.count(F.lit(1)) - F.count("weather_source")).alias("weather_unmatched_rows"),
        F.min("datetime_from_utc").alias("earliest_observation"),
        F.max("datetime_to_utc").alias("latest_observation"),
    ).withColumn("locations_loaded", locations.agg(F.count(F.lit(1)).alias("n")).scalar())


def check_loaded(observations: DataFrame, locations: DataFrame, rows: int, sites: int) -> None:
    """Compare the staged tables with what was meant to be loaded."""
    found = load_checks(observations, locations).first()
    expected = (rows, sites, 0, 0, 0)
    actual = (
        found.observations,
        found.locations,
        found.duplicate_keys,
        found.bad_parameters,
        found.orphans,
    )
    if actual != expected:
        raise InputError(f"warehouse load: expected {expected}, found {actual}")
