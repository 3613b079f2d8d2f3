"""Weather requests, the hour join, and its manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from envlake.domain import (
    IDENTITY,
    PARAMETERS,
    WEATHER_COLUMNS,
    WEATHER_METRICS,
    WEATHER_REQUEST_SETTINGS,
    WEATHER_VARIABLES,
)
from envlake.errors import InputError
from envlake.functions import rules
from envlake.operators.curation import enrichment_input_rules
from envlake.operators.geography import resolve_coordinates


def request_plan(observations: DataFrame, configured: DataFrame) -> DataFrame:
    """One weather request per location: pair, first name, inclusive dates."""
    spans = (
        # Names collapse as grouping keys, so that the wide first step stays a
        # hash aggregation and a hot location costs one row per task.
        observations.groupBy("location_id", "location_name")
        .agg(F.min("datetime_to_utc").alias("first"), F.max("datetime_to_utc").alias("last"))
        .groupBy("location_id")
        .agg(
            F.min("location_name").alias("location_name"),
            F.to_date(F.min("first")).alias("start_date"),
            F.to_date(F.max("last")).alias("end_date"),
        )
    )
    pairs = resolve_coordinates(observations, configured)
    return spans.join(pairs, "location_id").select(
        "location_id",
        "location_name",
        "latitude",
        "longitude",
        F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.date_format("end_date", "yyyy-MM-dd").alias("end_date"),
        "coordinate_error",
    )


def request_identity(plan: DataFrame) -> DataFrame:
    """Add the cache identity: digest of the request as sorted compact JSON."""
    settings = {name: F.lit(value) for name, value in WEATHER_REQUEST_SETTINGS.items()}
    fields = {
        "location_id": F.col("location_id"),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
        "start_date": F.col("start_date"),
        "end_date": F.col("end_date"),
        "hourly": F.lit(",".join(WEATHER_VARIABLES)),
        **settings,
    }
    text = F.to_json(F.struct(*(fields[name].alias(name) for name in sorted(fields))))
    return plan.withColumn("request_key", F.sha2(text, 256))


def split_cached(plan: DataFrame, cached_keys: DataFrame) -> DataFrame:
    """Mark each request as a cache hit or as one still to be fetched."""
    known = cached_keys.select("request_key").distinct().withColumn("cache_hit", F.lit(True))
    return plan.join(known, "request_key", "left").withColumn(
        "cache_hit", F.coalesce("cache_hit", F.lit(False))
    )


def available_hours(hours: DataFrame) -> DataFrame:
    """Hours with at least one metric; partial hours keep their other nulls."""
    return hours.filter(F.coalesce(*WEATHER_METRICS).isNotNull())


def check_enrichment_input(observations: DataFrame, hours: DataFrame) -> None:
    """Gate both sides before the join."""
    clash = set(WEATHER_COLUMNS) & set(observations.columns)
    if clash:
        raise InputError(f"enrichment input: weather columns already present: {sorted(clash)}")
    rules.require_clean(observations, enrichment_input_rules(), "enrichment input")
    key = tuple(name for name in IDENTITY if name in observations.columns)
    rules.require_unique(observations, key, "enrichment input")
    rules.require_unique(available_hours(hours), ("location_id", "weather_hour_utc"), "weather hours")


def join_weather(observations: DataFrame, hours: DataFrame) -> DataFrame:
    """Left join on location and the hour of the period end; never the nearest.

    Hours are unique per location, so no row is added; a hot location spreads
    over its hours because the hour is part of the join key.
    """
    stamped = observations.withColumn(
        "weather_hour_utc", F.date_trunc("HOUR", F.col("datetime_to_utc"))
    )
    joined = stamped.join(
        available_hours(hours).select("location_id", *WEATHER_COLUMNS),
        ["location_id", "weather_hour_utc"],
        "left",
    )
    return joined.select(*observations.columns, *WEATHER_COLUMNS)


def enrichment_manifest(enriched: DataFrame, hours: DataFrame) -> DataFrame:
    """One row: matches, match percentage, distinct locations and sensors, span."""
    sensors = enriched.groupBy("location_id", "sensor_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("weather_source").alias("matched"),
        *(F.count_if(F.col("parameter") == name).alias(name) for name in PARAMETERS),
        F.min("datetime_from_utc").alias("first"),
        F.max("datetime_to_utc").alias("last"),
    )
    totals = sensors.agg(
        F.sum("n").alias("air_quality_rows"),
        F.sum("matched").alias("weather_matched_rows"),
        (F.sum("n") - F.sum("matched")).alias("weather_unmatched_rows"),
        (F.lit(100.0) * F.sum("matched") / F.nullif(F.sum("n"), F.lit(0))).alias(
            "weather_match_percentage"
        ),
        F.count_distinct("location_id").alias("location_count"),
        F.count_distinct("sensor_id").alias("sensor_count"),
        *(F.sum(name).alias(f"{name}_rows") for name in PARAMETERS),
        F.min("first").alias("earliest_measurement"),
        F.max("last").alias("latest_measurement"),
    )
    available = available_hours(hours).agg(F.count(F.lit(1)).alias("c"))
    return totals.withColumn("weather_rows_available", available.scalar())
