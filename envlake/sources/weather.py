"""Weather envelopes: parallel hourly arrays and the response contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.domain import (
    SCHEMA_VERSION,
    WEATHER_METRICS,
    WEATHER_SOURCE,
    WEATHER_UNITS,
    WEATHER_VARIABLES,
    WEATHER_ZONES,
)
from envlake.errors import InputError
from envlake.functions import rules, variants
from envlake.functions.plans import compute_once
from envlake.operators.geography import in_bounds
from envlake.sources.bundles import read_documents

WEATHER_SUBDIR = "open_meteo/hourly"
WEATHER_BUNDLES = "open_meteo/bundles"

HOUR_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:00(:00(\.0+)?)?(Z|[+-]00:?00)?$"


def read_weather_files(spark: SparkSession, weather_dir: str) -> DataFrame:
    """(path, content) of every cached weather response, in files of its own or in bundles."""
    root = weather_dir.rstrip("/")
    path = F.col("_metadata.file_path")
    files = read_documents(spark, f"{root}/{WEATHER_SUBDIR}", f"{root}/{WEATHER_BUNDLES}", path)
    if files is None:
        raise InputError(f"No weather responses found below {WEATHER_SUBDIR}.")
    return files


def parse_weather(files: DataFrame) -> DataFrame:
    """Envelope parts per file; arrays stay one row until the contract holds."""
    document = files.select("path", F.try_parse_json("content").alias("d"))
    request = variants.member(F.col("d"), "$.request")
    response = variants.member(F.col("d"), "$.response")

    def series(name: str) -> Column:
        value = variants.member(response, f"$.hourly.{name}")
        return F.when(variants.is_array(value), F.try_variant_get(value, "$", "array<variant>"))

    columns = {
        "path": F.col("path"),
        "document": F.col("d"),
        "response": response,
        "location_id": variants.integer_of(variants.member(request, "$.location_id")),
        "start_date": variants.text_of(variants.member(request, "$.start_date")),
        "end_date": variants.text_of(variants.member(request, "$.end_date")),
        "weather_latitude": variants.number_of(variants.member(request, "$.latitude")),
        "weather_longitude": variants.number_of(variants.member(request, "$.longitude")),
        "time": series("time"),
        **{name: series(name) for name in WEATHER_VARIABLES},
    }
    parsed = compute_once(document, columns)
    everything = {name: F.col(name) for name in parsed.columns}
    return compute_once(parsed, everything | {"hours": F.transform("time", hour_of)})


def hour_of(value: Column) -> Column:
    """UTC hour of one array entry; null unless it is a whole hour at offset 0."""
    stamp = variants.text_of(value)
    whole = F.regexp_extract(stamp, r"^(\d{4}-\d{2}-\d{2}T\d{2}:00)", 1)
    return F.when(stamp.rlike(HOUR_TEXT), F.concat(whole, F.lit(":00Z")).try_cast("timestamp"))


def weather_rules() -> dict[str, Column]:
    """Response contract as named rules; a true flag is a violation."""
    response = F.col("response")

    def part(path: str) -> Column:
        return variants.member(response, path)

    # An error member counts when it is true, non-zero or non-empty.
    error = F.to_json(part("$.error"))
    zone = variants.text_of(part("$.timezone"))
    offset = F.when(variants.is_number(part("$.utc_offset_seconds")), part("$.utc_offset_seconds"))
    arrays = [F.col("time"), *(F.col(name) for name in WEATHER_VARIABLES)]
    arrays_present = F.lit(True)
    for array in arrays:
        arrays_present = arrays_present & array.isNotNull()
    same_length = F.lit(True)
    for array in arrays[1:]:
        same_length = same_length & (F.size(array) == F.size("time"))
    units_match = variants.text_of(part("$.hourly_units.time")) == "iso8601"
    for name, unit in zip(WEATHER_VARIABLES, WEATHER_UNITS, strict=True):
        units_match = units_match & F.coalesce(
            variants.text_of(part(f"$.hourly_units.{name}")) == unit, F.lit(False)
        )
    hours = F.col("hours")
    day = lambda hour: F.date_format(hour, "yyyy-MM-dd")
    hours_in_window = F.forall(
        hours, lambda hour: hour.isNotNull() & day(hour).between(F.col("start_date"), F.col("end_date"))
    )
    position = {name: F.try_variant_get(part(f"$.{name}"), "$", "double") for name in ("latitude", "longitude")}
    has_position = ~variants.is_missing(part("$.latitude")) & ~variants.is_missing(part("$.longitude"))
    numeric_position = variants.is_number(part("$.latitude")) & variants.is_number(part("$.longitude"))
    document = F.col("document")
    return {
        "unreadable": rules.failed(
            (variants.integer_of(variants.member(document, "$.schema_version")) == SCHEMA_VERSION)
            & (variants.text_of(variants.member(document, "$.source")) == WEATHER_SOURCE)
            & variants.is_object(variants.member(document, "$.request"))
            & variants.is_object(response)
            & F.col("location_id").isNotNull()
            & F.col("start_date").isNotNull()
            & F.col("end_date").isNotNull()
        ),
        "provider_error": ~F.coalesce(
            error.isin("false", "null", "0", "0.0", '""', "[]", "{}"), F.lit(True)
        ),
        "not_utc": rules.failed(
            (F.try_variant_get(offset, "$", "double") == 0) & zone.isin(*WEATHER_ZONES)
        ),
        "missing_array": ~arrays_present,
        "unequal_arrays": arrays_present & ~same_length,
        "wrong_units": rules.failed(units_match),
        "bad_hour": arrays_present & rules.failed(hours_in_window),
        "duplicate_hour": arrays_present
        & F.coalesce(F.size(F.array_distinct(hours)) < F.size("time"), F.lit(False))
        & F.coalesce(hours_in_window, F.lit(False)),
        "bad_temperature": _bad_values("temperature_2m"),
        "bad_humidity": _bad_values("relative_humidity_2m", 0.0, 100.0),
        "bad_precipitation": _bad_values("precipitation", 0.0),
        "bad_wind": _bad_values("wind_speed_10m", 0.0),
        "bad_position": has_position
        & rules.failed(numeric_position & in_bounds(position["latitude"], position["longitude"])),
    }


def _bad_values(name: str, low: float | None = None, high: float | None = None) -> Column:
    def bad(value: Column) -> Column:
        number = F.try_variant_get(value, "$", "double")
        ok = variants.is_number(value)
        if low is not None:
            ok = ok & (number >= low)
        if high is not None:
            ok = ok & (number <= high)
        return ~variants.is_missing(value) & rules.failed(ok)

    return F.coalesce(F.exists(name, bad), F.lit(False))


def weather_hours(weather: DataFrame) -> DataFrame:
    """One row per location and hour with the four metrics."""
    zipped = F.arrays_zip("hours", *WEATHER_VARIABLES)
    rows = weather.select(
        "location_id", "weather_latitude", "weather_longitude", F.explode(zipped).alias("h")
    )
    return rows.select(
        "location_id",
        F.col("h.hours").alias("weather_hour_utc"),
        *(
            variants.number_of(F.col(f"h.{name}")).alias(metric)
            for name, metric in zip(WEATHER_VARIABLES, WEATHER_METRICS, strict=True)
        ),
        F.lit(WEATHER_SOURCE).alias("weather_source"),
        "weather_latitude",
        "weather_longitude",
    )
