"""Model layer: staging, the joined fact, and the three marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import LOCATION_COLUMNS, WAREHOUSE_COLUMNS
from envlake.functions.skew import lookup_join

DAILY_GRAIN = ("measurement_date_utc", "location_id", "parameter", "unit")
LOCATION_GRAIN = ("location_id", "parameter", "unit")


def staged_observations(observations: DataFrame) -> DataFrame:
    return observations.select(*WAREHOUSE_COLUMNS)


def staged_locations(locations: DataFrame) -> DataFrame:
    return locations.select(*LOCATION_COLUMNS)


def fact(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Every observation with the canonical location beside its own values."""
    canonical = staged_locations(locations).select(
        "location_id",
        F.col("location_name").alias("canonical_location_name"),
        F.col("latitude").alias("canonical_latitude"),
        F.col("longitude").alias("canonical_longitude"),
    )
    joined = lookup_join(staged_observations(observations), canonical, "location_id")
    return joined.select(
        *WAREHOUSE_COLUMNS,
        "canonical_location_name",
        "canonical_latitude",
        "canonical_longitude",
        F.col("weather_source").isNotNull().alias("has_weather_context"),
    )


def _statistics() -> list[Column]:
    # weather_source is null exactly where there is no weather context.
    return [
        F.count(F.lit(1)).alias("observation_count"),
        F.avg("value").alias("average_value"),
        F.min("value").alias("minimum_value"),
        F.max("value").alias("maximum_value"),
        F.count("weather_source").alias("weather_context_count"),
        (F.lit(100.0) * F.count("weather_source") / F.count(F.lit(1))).alias(
            "weather_context_percentage"
        ),
    ]


def _named(mart: DataFrame, locations: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """Add the location name after the aggregation, where rows are few.

    A location has one name, so this equals the greatest name per group; the
    aggregation itself then holds numbers only and runs as a hash aggregation.
    """
    names = locations.select("location_id", "location_name")
    others = [name for name in mart.columns if name not in grain]
    return mart.join(names, "location_id", "left").select(*grain, "location_name", *others)


def daily_mart(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Per UTC day, location, parameter and unit."""
    mart = observations.groupBy(*DAILY_GRAIN).agg(*_statistics())
    return _named(mart, locations, DAILY_GRAIN)


def daily_mart_of_partials(partials: DataFrame, locations: DataFrame) -> DataFrame:
    """The daily mart from counts, sums and extremes per grain (n, total, least, greatest, with_weather)."""
    mart = partials.select(
        *DAILY_GRAIN,
        F.col("n").alias("observation_count"),
        (F.col("total") / F.col("n")).alias("average_value"),
        F.col("least").alias("minimum_value"),
        F.col("greatest").alias("maximum_value"),
        F.col("with_weather").alias("weather_context_count"),
        (F.lit(100.0) * F.col("with_weather") / F.col("n")).alias("weather_context_percentage"),
    )
    return _named(mart, locations, DAILY_GRAIN)


def location_mart(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Per location, parameter and unit, with the observed span."""
    mart = observations.groupBy(*LOCATION_GRAIN).agg(
        *_statistics(),
        F.min("datetime_to_utc").alias("earliest_observation_utc"),
        F.max("datetime_to_utc").alias("latest_observation_utc"),
    )
    return _named(mart, locations, LOCATION_GRAIN)


def weather_mart(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Daily grain over matched rows; weather averages use non-null values."""
    averages = {
        "value": "average_pollution_value",
        "temperature_2m_c": "average_temperature_2m_c",
        "relative_humidity_2m_pct": "average_relative_humidity_2m_pct",
        "precipitation_mm": "average_precipitation_mm",
        "wind_speed_10m_kmh": "average_wind_speed_10m_kmh",
    }
    counts = {
        "temperature_2m_c": "temperature_observation_count",
        "relative_humidity_2m_pct": "humidity_observation_count",
        "precipitation_mm": "precipitation_observation_count",
        "wind_speed_10m_kmh": "wind_observation_count",
    }
    matched = observations.filter(F.col("weather_source").isNotNull())
    mart = matched.groupBy(*DAILY_GRAIN).agg(
        F.count(F.lit(1)).alias("observation_count"),
        *(F.avg(column).alias(name) for column, name in averages.items()),
        *(F.count(column).alias(name) for column, name in counts.items()),
    )
    return _named(mart, locations, DAILY_GRAIN)
