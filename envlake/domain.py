"""Column lists, keys and value domains of the observation model."""

# Names, orders and domains that results must equal. -----------

SOURCE = "openaq"
WEATHER_SOURCE = "open_meteo"
PARAMETERS = ("pm25", "pm10")
SCHEMA_VERSION = 1

OBSERVATION_COLUMNS = (
    "source",
    "location_id",
    "location_name",
    "sensor_id",
    "parameter",
    "parameter_id",
    "unit",
    "value",
    "period_label",
    "period_interval",
    "datetime_from_utc",
    "datetime_to_utc",
    "datetime_from_local",
    "datetime_to_local",
    "latitude",
    "longitude",
    "source_file",
    "retrieval_datetime_from",
    "retrieval_datetime_to",
)
KEY = ("location_id", "sensor_id", "parameter", "datetime_from_utc", "datetime_to_utc")
PROCESSED_ORDER = (
    "datetime_from_utc",
    "datetime_to_utc",
    "location_id",
    "sensor_id",
    "parameter",
)
REQUIRED_COLUMNS = (
    "source",
    "location_id",
    "location_name",
    "sensor_id",
    "parameter",
    "unit",
    "value",
    "datetime_from_utc",
    "datetime_to_utc",
)
PARTITIONS = ("parameter", "measurement_date_utc")
CURATED_ORDER = (
    "parameter",
    "measurement_date_utc",
    "datetime_to_utc",
    "location_id",
    "sensor_id",
    "datetime_from_utc",
)

WEATHER_METRICS = (
    "temperature_2m_c",
    "relative_humidity_2m_pct",
    "precipitation_mm",
    "wind_speed_10m_kmh",
)
WEATHER_VARIABLES = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
)
WEATHER_UNITS = ("°C", "%", "mm", "km/h")
WEATHER_ZONES = ("GMT", "UTC", "Etc/UTC", "Etc/GMT")
WEATHER_REQUEST_SETTINGS = {
    "timezone": "UTC",
    "temperature_unit": "celsius",
    "precipitation_unit": "mm",
    "wind_speed_unit": "kmh",
}
WEATHER_COLUMNS = (
    "weather_hour_utc",
    "temperature_2m_c",
    "relative_humidity_2m_pct",
    "precipitation_mm",
    "wind_speed_10m_kmh",
    "weather_source",
    "weather_latitude",
    "weather_longitude",
)

LOCATION_COLUMNS = (
    "location_id",
    "location_name",
    "latitude",
    "longitude",
    "weather_latitude",
    "weather_longitude",
)
WAREHOUSE_COLUMNS = (
    "location_id",
    "location_name",
    "sensor_id",
    "parameter",
    "parameter_id",
    "unit",
    "value",
    "period_label",
    "period_interval",
    "datetime_from_utc",
    "datetime_to_utc",
    "datetime_from_local",
    "datetime_to_local",
    "measurement_date_utc",
    "latitude",
    "longitude",
    "source",
    "source_file",
    "retrieval_datetime_from",
    "retrieval_datetime_to",
    "weather_hour_utc",
    "temperature_2m_c",
    "relative_humidity_2m_pct",
    "precipitation_mm",
    "wind_speed_10m_kmh",
    "weather_source",
    "weather_latitude",
    "weather_longitude",
)
WAREHOUSE_NOT_NULL = (
    "location_id",
    "sensor_id",
    "parameter",
    "unit",
    "value",
    "datetime_from_utc",
    "datetime_to_utc",
    "measurement_date_utc",
    "source",
)

RUN_STAGES = (
    "validate_run_config",
    "acquire_air_quality",
    "process_air_quality",
    "build_curated_air_quality",
    "enrich_air_quality_weather",
    "load_postgres_warehouse",
    "build_dbt_analytics",
)
FIRST_STAGE = "validate_run_config"
COUNT_KEEPING_STAGE = "build_dbt_analytics"
FAILURE_SUMMARY = "Pipeline failed; inspect Airflow task and callback logs."

# Largest accepted identifier.
MAX_ID = 2**63 - 1

# End of fixed values. --------------------------------------------------------

# Timestamps hold microseconds; sources may carry nanoseconds. The remainder
# (0-999) travels beside each boundary and is part of the observation identity.
NANO_COLUMNS = ("datetime_from_ns", "datetime_to_ns")
IDENTITY = (*KEY, *NANO_COLUMNS)

# DDL types of every observation and weather column.
COLUMN_TYPES = {
    "location_id": "bigint",
    "sensor_id": "bigint",
    "parameter_id": "bigint",
    "value": "double",
    "latitude": "double",
    "longitude": "double",
    "datetime_from_utc": "timestamp",
    "datetime_to_utc": "timestamp",
    "datetime_from_ns": "smallint",
    "datetime_to_ns": "smallint",
    "measurement_date_utc": "date",
    "weather_hour_utc": "timestamp",
    "weather_latitude": "double",
    "weather_longitude": "double",
    **dict.fromkeys(WEATHER_METRICS, "double"),
}


def column_type(name: str) -> str:
    """DDL type of a model column; anything unlisted is text."""
    return COLUMN_TYPES.get(name, "string")
