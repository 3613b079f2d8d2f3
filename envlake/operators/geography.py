"""Coordinate bounds and the resolution of one pair per location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bounds and the variation accepted within one location.
MAX_LATITUDE = 90.0
MAX_LONGITUDE = 180.0
TOLERANCE_DEGREES = 1e-5


def in_bounds(latitude: Column, longitude: Column) -> Column:
    """True for a finite pair inside the geographic bounds; never null."""
    ok = (
        ~F.isnan(latitude)
        & ~F.isnan(longitude)
        & latitude.between(-MAX_LATITUDE, MAX_LATITUDE)
        & longitude.between(-MAX_LONGITUDE, MAX_LONGITUDE)
    )
    return F.coalesce(ok, F.lit(False))


def resolve_coordinates(observations: DataFrame, configured: DataFrame) -> DataFrame:
    """One coordinate pair per observed location, or the reason there is none.

    Complete source pairs win if they agree within the tolerance; the smallest
    pair is taken. Otherwise the configured pair applies. Halves never mix.

    Distinct pairs are collapsed first, so a location with very many rows costs
    one row per pair and map task.
    """
    complete = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    pairs = observations.select(
        "location_id",
        F.when(complete, F.col("latitude")).alias("latitude"),
        F.when(complete, F.col("longitude")).alias("longitude"),
    ).distinct()
    valid = in_bounds(F.col("latitude"), F.col("longitude"))
    has_pair = F.col("latitude").isNotNull()
    found = pairs.groupBy("location_id").agg(
        F.min(F.when(has_pair, F.struct("latitude", "longitude"))).alias("pair"),
        F.coalesce(F.bool_or(has_pair & ~valid), F.lit(False)).alias("out_of_bounds"),
        (F.max("latitude") - F.min("latitude")).alias("latitude_spread"),
        (F.max("longitude") - F.min("longitude")).alias("longitude_spread"),
    )
    fallback = configured.select(
        F.col("id").alias("location_id"),
        F.col("latitude").alias("c_lat"),
        F.col("longitude").alias("c_lon"),
    )
    conflict = (F.col("latitude_spread") > TOLERANCE_DEGREES) | (
        F.col("longitude_spread") > TOLERANCE_DEGREES
    )
    no_configured = F.col("c_lat").isNull() | F.col("c_lon").isNull()
    error = (
        F.when(F.col("out_of_bounds"), "coordinates out of bounds")
        .when(F.col("pair").isNotNull() & conflict, "conflicting coordinates")
        .when(F.col("pair").isNull() & no_configured, "no confirmed coordinates")
        .when(
            F.col("pair").isNull() & ~in_bounds(F.col("c_lat"), F.col("c_lon")),
            "coordinates out of bounds",
        )
    )
    origin = F.when(F.col("pair").isNotNull(), "observations").otherwise("configuration")
    return found.join(fallback, "location_id", "left").select(
        "location_id",
        F.when(error.isNull(), F.coalesce(F.col("pair.latitude"), F.col("c_lat"))).alias("latitude"),
        F.when(error.isNull(), F.coalesce(F.col("pair.longitude"), F.col("c_lon"))).alias("longitude"),
        F.when(error.isNull(), origin).alias("origin"),
        error.alias("coordinate_error"),
    )


def map_extent(locations: DataFrame) -> DataFrame:
    """Bounds of all valid pairs, and how many locations have one."""
    valid = in_bounds(F.col("latitude"), F.col("longitude"))
    return locations.agg(
        F.min(F.when(valid, F.col("latitude"))).alias("south"),
        F.max(F.when(valid, F.col("latitude"))).alias("north"),
        F.min(F.when(valid, F.col("longitude"))).alias("west"),
        F.max(F.when(valid, F.col("longitude"))).alias("east"),
        F.count_if(valid).alias("mapped"),
        F.count_if(~valid).alias("without_coordinates"),
    )
