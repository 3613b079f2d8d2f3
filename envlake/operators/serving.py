"""The analytical queries: summaries, latest and recent rows, series, comparisons."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from envlake.domain import MAX_ID, PARAMETERS
from envlake.errors import QueryArgumentError
from envlake.functions.skew import lookup_join
from envlake.operators.models import DAILY_GRAIN, LOCATION_GRAIN

# Limits, windows and projections of the served queries.
RECENT_LIMIT = 100
RECENT_PER_LOCATION = 20
SERIES_DEFAULT_LIMIT = 1000
SERIES_MAX_LIMIT = 2000
SERIES_DAYS = 90
TAIL_ROWS = 12
OBSERVATION_FIELDS = (
    "sensor_id",
    "parameter",
    "unit",
    "value",
    "datetime_from_utc",
    "datetime_to_utc",
    "has_weather_context",
    "weather_hour_utc",
    "temperature_2m_c",
    "relative_humidity_2m_pct",
    "precipitation_mm",
    "wind_speed_10m_kmh",
    "weather_source",
)
SERIES_FIELDS = {
    "trends": (
        "average_value",
        "minimum_value",
        "maximum_value",
        "weather_context_count",
        "weather_context_percentage",
    ),
    "weather": (
        "average_pollution_value",
        "average_temperature_2m_c",
        "average_relative_humidity_2m_pct",
        "average_precipitation_mm",
        "average_wind_speed_10m_kmh",
        "temperature_observation_count",
        "humidity_observation_count",
        "precipitation_observation_count",
        "wind_observation_count",
    ),
}
POLLUTANT_LABELS = {"pm25": "PM2.5", "pm10": "PM10"}


# -- arguments -----------------------------------------------------------------


def check_parameter(parameter: str) -> str:
    if parameter not in PARAMETERS:
        raise QueryArgumentError("parameter must be pm25 or pm10")
    return parameter


def check_location(location_id: int | None) -> int | None:
    if location_id is not None and (type(location_id) is not int or not 1 <= location_id <= MAX_ID):
        raise QueryArgumentError("location_id must be a positive identifier")
    return location_id


def check_date(value: str | date | None) -> date | None:
    if value is None or isinstance(value, date):
        return value
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise QueryArgumentError("dates must be YYYY-MM-DD")
    try:
        return date.fromisoformat(value)
    except ValueError as error:
        raise QueryArgumentError("dates must be YYYY-MM-DD") from error


def check_limit(limit: int) -> int:
    if type(limit) is not int or not 1 <= limit <= SERIES_MAX_LIMIT:
        raise QueryArgumentError(f"limit must be 1 to {SERIES_MAX_LIMIT}")
    return limit


# -- summaries -----------------------------------------------------------------


def summary_totals(location_mart: DataFrame) -> DataFrame:
    """One row over the location mart; empty input gives zero counts."""
    n, matched = F.sum("observation_count"), F.sum("weather_context_count")
    return location_mart.agg(
        F.count_distinct("location_id").alias("monitored_locations"),
        F.coalesce(n, F.lit(0)).alias("observation_count"),
        (F.lit(100.0) * matched / F.nullif(n, F.lit(0))).alias("weather_coverage"),
        F.min("earliest_observation_utc").alias("earliest_observation"),
        F.max("latest_observation_utc").alias("latest_observation"),
    )


def summary_averages(location_mart: DataFrame) -> DataFrame:
    """Averages per parameter and unit, weighted by observation count."""
    n = F.sum("observation_count")
    weighted = F.sum(F.col("average_value") * F.col("observation_count"))
    return (
        location_mart.groupBy("parameter", "unit")
        .agg((weighted / F.nullif(n, F.lit(0))).alias("average_value"), n.alias("observation_count"))
        .orderBy("parameter", "unit")
    )


def metric_card(location_mart: DataFrame, parameter: str) -> DataFrame:
    """The averages of one pollutant, one row per unit."""
    return summary_averages(location_mart).filter(F.col("parameter") == check_parameter(parameter))


# -- locations -----------------------------------------------------------------


def locations_with_parameters(locations: DataFrame, location_mart: DataFrame) -> DataFrame:
    """Every location with its sorted parameters; none gives an empty array."""
    # At most one entry per known parameter is collected.
    present = location_mart.groupBy("location_id").agg(
        F.array_sort(F.collect_set("parameter")).alias("parameters")
    )
    return (
        locations.join(present, "location_id", "left")
        .select(
            "location_id",
            "location_name",
            "latitude",
            "longitude",
            F.coalesce("parameters", F.array().cast("array<string>")).alias("parameters"),
        )
        .orderBy(F.asc_nulls_last("location_name"), "location_id")
    )


def location_header(locations: DataFrame, location_id: int) -> DataFrame:
    """One row, or none for an unknown location."""
    wanted = F.col("location_id") == check_location(location_id)
    return locations.filter(wanted).select("location_id", "location_name", "latitude", "longitude")


def latest_per_group(fact: DataFrame, fields: tuple[str, ...], keys: tuple[str, ...] = LOCATION_GRAIN) -> DataFrame:
    """Latest row per group: newest end, then newest start, then lowest sensor.

    An aggregation instead of a window: map tasks reduce a hot group to one row.
    """
    rest = [name for name in fields if name not in keys]
    newest = F.struct("datetime_to_utc", "datetime_from_utc", (-F.col("sensor_id")).alias("s"))
    best = fact.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("row"))
    return best.select(*keys, "row.*").select(*dict.fromkeys((*keys, *fields)))


def latest_in_location(fact: DataFrame, location_id: int) -> DataFrame:
    """Latest row per parameter and unit of one location."""
    rows = fact.filter(F.col("location_id") == check_location(location_id))
    return latest_per_group(rows, OBSERVATION_FIELDS, ("parameter", "unit"))


def _recency() -> list[Column]:
    return [
        F.desc("datetime_to_utc"),
        F.asc("parameter"),
        F.asc("unit"),
        F.asc("sensor_id"),
        F.desc("datetime_from_utc"),
    ]


def recent_in_location(fact: DataFrame, location_id: int) -> DataFrame:
    """The 20 most recent rows of one location."""
    rows = fact.filter(F.col("location_id") == check_location(location_id))
    return rows.orderBy(*_recency()).limit(RECENT_PER_LOCATION).select(*OBSERVATION_FIELDS)


def recent_per_location(fact: DataFrame) -> DataFrame:
    """The 20 most recent rows of every location, with their rank.

    The rank filter is applied per map task before the shuffle, so a hot
    location sends at most 20 rows from each task.
    """
    ranked = Window.partitionBy("location_id").orderBy(*_recency())
    return (
        fact.select("location_id", *OBSERVATION_FIELDS)
        .withColumn("recency", F.row_number().over(ranked))
        .filter(F.col("recency") <= RECENT_PER_LOCATION)
    )


def latest_matched_in_recent(fact: DataFrame) -> DataFrame:
    """Per location, the newest of its 20 recent rows that has weather."""
    matched = recent_per_location(fact).filter("has_weather_context")
    row = F.min_by(F.struct("recency", *OBSERVATION_FIELDS), "recency")
    return matched.groupBy("location_id").agg(row.alias("row")).select("location_id", "row.*")


def location_detail(fact: DataFrame, locations: DataFrame, location_id: int) -> dict[str, DataFrame]:
    """Header, latest and recent rows of one location."""
    return {
        "header": location_header(locations, location_id),
        "latest": latest_in_location(fact, location_id),
        "recent": recent_in_location(fact, location_id),
    }


# -- series and comparison -----------------------------------------------------


def series(
    kind: str,
    fact: DataFrame,
    mart: DataFrame,
    parameter: str,
    location_id: int | None = None,
    date_from: str | date | None = None,
    date_to: str | date | None = None,
    limit: int = SERIES_DEFAULT_LIMIT,
) -> DataFrame:
    """Bounded daily series of a mart with a ``truncated`` flag on each row.

    Without bounds the window is the 90 days up to the latest stored day of the
    parameter and location in the fact. ``limit + 1`` rows are taken from the
    ordered mart; the surplus row only tells whether there are more.
    """
    if kind not in SERIES_FIELDS:
        raise QueryArgumentError("kind must be trends or weather")
    check_parameter(parameter), check_location(location_id), check_limit(limit)
    start, end = check_date(date_from), check_date(date_to)
    if start and end and start > end:
        raise QueryArgumentError("start date must be on or before end date")

    def chosen(rows: DataFrame) -> DataFrame:
        rows = rows.filter(F.col("parameter") == parameter)
        return rows if location_id is None else rows.filter(F.col("location_id") == location_id)

    day = F.col("measurement_date_utc")
    if end is None:
        last_day = chosen(fact).agg(F.max("measurement_date_utc").alias("d")).scalar()
    else:
        last_day = F.lit(end)
    first_day = F.date_sub(last_day, SERIES_DAYS - 1) if start is None else F.lit(start)
    columns = ("measurement_date_utc", "location_id", "location_name", "parameter", "unit")
    page = (
        chosen(mart)
        .filter((day >= first_day) & (day <= last_day))
        .orderBy(*DAILY_GRAIN)
        .limit(limit + 1)
        .select(*columns, "observation_count", *SERIES_FIELDS[kind])
    )
    # At most limit + 1 rows remain, so one unpartitioned window is cheap.
    numbered = page.select(
        "*",
        F.row_number().over(Window.orderBy(*DAILY_GRAIN)).alias("position"),
        (F.count(F.lit(1)).over(Window.partitionBy()) > limit).alias("truncated"),
    )
    return numbered.filter(F.col("position") <= limit)


def series_tail(series_rows: DataFrame) -> DataFrame:
    """The last 12 rows of a series, with its row count and flag."""
    total = F.count(F.lit(1)).over(Window.partitionBy())
    counted = series_rows.withColumn("returned_row_count", total)
    return counted.filter(F.col("position") > F.col("returned_row_count") - TAIL_ROWS)


def split_by_unit(series_rows: DataFrame) -> DataFrame:
    """One row per unit, units sorted, with the rows of a bounded series."""
    others = [name for name in series_rows.columns if name not in ("unit", "truncated")]
    item = F.struct("position", *(name for name in others if name != "position"))
    return (
        series_rows.groupBy("unit")
        .agg(F.array_sort(F.collect_list(item)).alias("rows"))
        .orderBy("unit")
    )


def comparison(location_mart: DataFrame, parameter: str) -> DataFrame:
    """Locations side by side for one parameter, units apart."""
    return (
        location_mart.filter(F.col("parameter") == check_parameter(parameter))
        .select(
            "location_id",
            "location_name",
            "parameter",
            "unit",
            "observation_count",
            "average_value",
            "minimum_value",
            "maximum_value",
            "earliest_observation_utc",
            "latest_observation_utc",
            "weather_context_count",
            "weather_context_percentage",
        )
        .orderBy("unit", F.asc_nulls_last("location_name"), "location_id")
    )


def latest_run(runs: DataFrame, dag_id: str) -> DataFrame:
    """The latest run of a pipeline, without error text; none gives no row."""
    return (
        runs.filter(F.col("dag_id") == dag_id)
        .orderBy(F.desc_nulls_first("started_at"), F.desc("run_id"))
        .limit(1)
        .select(
            "run_id",
            "run_mode",
            "requested_start",
            "requested_end",
            "location_id",
            "status",
            "current_stage",
            "failed_stage",
            "started_at",
            "finished_at",
            "observations_loaded",
        )
    )


def data_health(runs: DataFrame, location_mart: DataFrame, dag_id: str) -> dict[str, DataFrame]:
    return {
        "latest_run": latest_run(runs, dag_id),
        "totals": summary_totals(location_mart),
        "averages": summary_averages(location_mart),
    }


# -- listings ------------------------------------------------------------------


def recent_with_location(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """The 100 most recent observations with location name and weather."""
    names = locations.select("location_id", "location_name")
    order = (F.desc("datetime_to_utc"), "location_id", "sensor_id", "parameter")
    # Rows of unknown locations do not count, so they go before the limit; names come after it.
    known = lookup_join(observations.drop("location_name"), names.select("location_id"), "location_id", "left_semi")
    recent = known.orderBy(*order).limit(RECENT_LIMIT)
    return (
        recent.join(names, "location_id")
        .orderBy(*order)
        .select(
            "datetime_to_utc",
            "location_id",
            "location_name",
            "parameter",
            "unit",
            "value",
            "temperature_2m_c",
            "relative_humidity_2m_pct",
            "precipitation_mm",
            "wind_speed_10m_kmh",
        )
    )


def average_by_location(observations: DataFrame) -> DataFrame:
    return (
        observations.groupBy(*LOCATION_GRAIN)
        .agg(F.count(F.lit(1)).alias("observations"), F.avg("value").alias("average_concentration"))
        .orderBy(*LOCATION_GRAIN)
    )


def average_with_weather(observations: DataFrame) -> DataFrame:
    """Averages beside weather averages over their own non-null samples."""
    return (
        observations.groupBy(*LOCATION_GRAIN)
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.avg("value").alias("average_concentration"),
            F.count("temperature_2m_c").alias("temperature_samples"),
            F.count("relative_humidity_2m_pct").alias("humidity_samples"),
            F.count("wind_speed_10m_kmh").alias("wind_samples"),
            F.avg("temperature_2m_c").alias("average_temperature_c"),
            F.avg("relative_humidity_2m_pct").alias("average_humidity_pct"),
            F.avg("wind_speed_10m_kmh").alias("average_wind_kmh"),
        )
        .orderBy(*LOCATION_GRAIN)
    )


def daily_average(observations: DataFrame) -> DataFrame:
    return (
        observations.groupBy(*DAILY_GRAIN)
        .agg(F.count(F.lit(1)).alias("observations"), F.avg("value").alias("average_concentration"))
        .orderBy(*DAILY_GRAIN)
    )


def daily_pm25(daily_mart: DataFrame) -> DataFrame:
    return (
        daily_mart.filter("parameter = 'pm25'")
        .select(
            "measurement_date_utc",
            "location_id",
            "location_name",
            "parameter",
            "unit",
            "observation_count",
            "average_value",
            "weather_context_percentage",
        )
        .orderBy("measurement_date_utc", "location_id", "unit")
    )


def pm10_by_location(location_mart: DataFrame) -> DataFrame:
    return (
        location_mart.filter("parameter = 'pm10'")
        .select(
            "location_id",
            "location_name",
            "parameter",
            "unit",
            "observation_count",
            "average_value",
            "earliest_observation_utc",
            "latest_observation_utc",
        )
        .orderBy("location_id", "unit")
    )


def weather_listing(weather_mart: DataFrame) -> DataFrame:
    return weather_mart.select(
        *DAILY_GRAIN,
        "observation_count",
        "average_pollution_value",
        "average_temperature_2m_c",
        "average_relative_humidity_2m_pct",
        "average_precipitation_mm",
        "average_wind_speed_10m_kmh",
    ).orderBy(*DAILY_GRAIN)


def latest_listing(fact: DataFrame) -> DataFrame:
    """Latest observation per location, parameter and unit."""
    fields = (
        "location_id",
        "canonical_location_name",
        "sensor_id",
        "parameter",
        "unit",
        "value",
        "datetime_from_utc",
        "datetime_to_utc",
        "has_weather_context",
    )
    return latest_per_group(fact, fields).select(*fields).orderBy(*LOCATION_GRAIN)


# -- display -------------------------------------------------------------------


def pollutant_label(parameter: Column) -> Column:
    label = F.coalesce(*(F.when(parameter == k, v) for k, v in POLLUTANT_LABELS.items()), parameter)
    return label


def location_label(name: Column, location_id: Column) -> Column:
    fallback = F.concat(F.lit("Location "), location_id.cast("string"))
    return F.coalesce(F.nullif(name, F.lit("")), fallback)


def number_label(value: Column, decimal_mark: str = ",", group_mark: str = "\xa0") -> Column:
    """At most one decimal, half away from zero; null becomes a dash."""
    shown = F.format_number(F.abs(F.round(value, 1)), 1)
    plain = F.regexp_replace(shown, r"\.0$", "")
    marked = F.translate(plain, ",.", f"{group_mark}{decimal_mark}")
    sign = F.when((F.round(value, 1) < 0), "-").otherwise("")
    return F.when(value.isNull(), "—").otherwise(F.concat(sign, marked))
