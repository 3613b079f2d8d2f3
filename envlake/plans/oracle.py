"""Equivalent SQL of the registered queries, for DuckDB over the driver tables.

Written from the rules of the inputs, not from the Spark plans: rejection
reasons, for example, are a CASE over ``event_id`` and never touch JSON.
"""

from __future__ import annotations

from envlake.domain import OBSERVATION_COLUMNS, WAREHOUSE_COLUMNS, WEATHER_COLUMNS
from envlake.operators import routing
from envlake.plans.driver_tables import REQUESTS

TS = "'%Y-%m-%d %H:%M:%S.%f'"
DAY = "'%Y-%m-%d'"

PARTS = {
    "ev": """
    SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k,
        user_id % 25 + 1 AS location_id, user_id + 1 AS sensor_id,
        CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'pm25' ELSE 'pm10' END AS parameter,
        event_id // 20000 AS block
    FROM events""",
    "obs": f"""
    SELECT event_id, k, event_type, block, 'openaq' AS source, location_id,
        CASE WHEN k % 7 <> 0 THEN 'NATION_' || (location_id - 1) END AS location_name,
        sensor_id, parameter,
        CASE WHEN k % 10 <> 0 THEN 2::BIGINT END AS parameter_id,
        CASE WHEN event_type = 'error' THEN 'mg/m3' ELSE 'ug/m3' END AS unit,
        CASE WHEN event_type = 'error' THEN -value ELSE value END AS value,
        'hour' AS period_label, '01:00:00' AS period_interval,
        ts - INTERVAL 1 HOUR AS datetime_from_utc, ts AS datetime_to_utc,
        strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS datetime_from_local,
        strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS datetime_to_local,
        CASE WHEN k % 3 <> 0 AND location_id % 4 <> 0
            THEN -35.0::DOUBLE + location_id * 0.25::DOUBLE END AS latitude,
        CASE WHEN k % 3 <> 0 AND location_id % 4 <> 0
            THEN 16.0::DOUBLE + location_id * 0.5::DOUBLE END AS longitude,
        {{path0}} AS source_file,
        {{w0}} AS retrieval_datetime_from, {{w1}} AS retrieval_datetime_to,
        ts::DATE AS measurement_date_utc
    FROM ev""",
    "wx": """
    SELECT location_id, weather_hour_utc,
        CASE WHEN h % 11 <> 0 THEN ((location_id * 7 + h) % 30)::DOUBLE END AS temperature_2m_c,
        CASE WHEN h % 11 <> 0 THEN ((location_id * 3 + h) % 100)::DOUBLE END AS relative_humidity_2m_pct,
        CASE WHEN h % 11 <> 0 AND h % 5 <> 0 THEN (h % 4)::DOUBLE END AS precipitation_mm,
        CASE WHEN h % 11 <> 0 THEN (h % 20)::DOUBLE END AS wind_speed_10m_kmh,
        'open_meteo' AS weather_source,
        -35.0::DOUBLE + location_id * 0.25::DOUBLE AS weather_latitude,
        16.0::DOUBLE + location_id * 0.5::DOUBLE AS weather_longitude
    FROM (SELECT DISTINCT location_id, date_trunc('hour', ts) AS weather_hour_utc,
            hour(ts) AS h FROM ev WHERE event_type IN ('view', 'click'))""",
    "avail": """
    SELECT * FROM wx WHERE temperature_2m_c IS NOT NULL OR relative_humidity_2m_pct IS NOT NULL
        OR precipitation_mm IS NOT NULL OR wind_speed_10m_kmh IS NOT NULL""",
    "enr": """
    SELECT o.*, date_trunc('hour', o.datetime_to_utc) AS weather_hour_utc,
        a.temperature_2m_c, a.relative_humidity_2m_pct, a.precipitation_mm, a.wind_speed_10m_kmh,
        a.weather_source, a.weather_latitude, a.weather_longitude
    FROM obs o LEFT JOIN avail a ON a.location_id = o.location_id
        AND a.weather_hour_utc = date_trunc('hour', o.datetime_to_utc)""",
    "conf": """
    SELECT n_nationkey + 1 AS id, n_name AS name,
        CASE WHEN (n_nationkey + 1) % 5 <> 0 THEN -35.0::DOUBLE + (n_nationkey + 1) * 0.25::DOUBLE END AS latitude,
        CASE WHEN (n_nationkey + 1) % 5 <> 0 THEN 16.0::DOUBLE + (n_nationkey + 1) * 0.5::DOUBLE END AS longitude
    FROM nation""",
    "loc": """
    SELECT id::BIGINT AS location_id, CASE WHEN id % 9 <> 0 THEN name END AS location_name, latitude, longitude,
        -35.0::DOUBLE + id * 0.25::DOUBLE AS weather_latitude, 16.0::DOUBLE + id * 0.5::DOUBLE AS weather_longitude
    FROM conf""",
    "fct": """
    SELECT e.*, l.location_name AS canonical_location_name, l.latitude AS canonical_latitude,
        l.longitude AS canonical_longitude, e.weather_source IS NOT NULL AS has_weather_context
    FROM enr e LEFT JOIN loc l ON l.location_id = e.location_id""",
    "daily": """
    SELECT measurement_date_utc, location_id, parameter, unit, max(canonical_location_name) AS location_name,
        count(*) AS observation_count, avg(value) AS average_value, min(value) AS minimum_value,
        max(value) AS maximum_value, count(*) FILTER (WHERE has_weather_context) AS weather_context_count,
        100.0::DOUBLE * count(*) FILTER (WHERE has_weather_context) / count(*) AS weather_context_percentage
    FROM fct GROUP BY measurement_date_utc, location_id, parameter, unit""",
    "byloc": """
    SELECT location_id, parameter, unit, max(canonical_location_name) AS location_name,
        count(*) AS observation_count, avg(value) AS average_value, min(value) AS minimum_value,
        max(value) AS maximum_value, count(*) FILTER (WHERE has_weather_context) AS weather_context_count,
        100.0::DOUBLE * count(*) FILTER (WHERE has_weather_context) / count(*) AS weather_context_percentage,
        min(datetime_to_utc) AS earliest_observation_utc, max(datetime_to_utc) AS latest_observation_utc
    FROM fct GROUP BY location_id, parameter, unit""",
    "wmart": """
    SELECT measurement_date_utc, location_id, parameter, unit, max(canonical_location_name) AS location_name,
        count(*) AS observation_count, avg(value) AS average_pollution_value,
        avg(temperature_2m_c) AS average_temperature_2m_c,
        avg(relative_humidity_2m_pct) AS average_relative_humidity_2m_pct,
        avg(precipitation_mm) AS average_precipitation_mm, avg(wind_speed_10m_kmh) AS average_wind_speed_10m_kmh,
        count(temperature_2m_c) AS temperature_observation_count,
        count(relative_humidity_2m_pct) AS humidity_observation_count,
        count(precipitation_mm) AS precipitation_observation_count,
        count(wind_speed_10m_kmh) AS wind_observation_count
    FROM fct WHERE has_weather_context GROUP BY measurement_date_utc, location_id, parameter, unit""",
    # Records of all landed batches with the reason each is rejected for.
    "rec": """
    SELECT o.*, b.batch,
        CASE WHEN event_id % 83 = 0 THEN 'invalid_parameter'
            WHEN event_id % 61 = 0 THEN 'parameter_mismatch'
            WHEN event_id % 59 = 0 THEN 'invalid_identifier'
            WHEN event_id % 89 = 0 THEN 'missing_unit'
            WHEN event_id % 97 = 0 THEN 'invalid_value'
            WHEN event_id % 79 = 0 THEN 'invalid_timestamp'
            WHEN event_id % 73 = 0 THEN 'invalid_period'
            WHEN event_id % 71 = 0 THEN 'missing_required_field'
            WHEN event_id % 47 = 0 THEN 'invalid_value'
            WHEN event_id % 53 = 0 THEN 'missing_required_field' END AS reason,
        CASE WHEN event_id % 11 = 0 THEN 123 ELSE 0 END AS ns
    FROM obs o JOIN (SELECT 0 AS batch UNION ALL SELECT 1 UNION ALL SELECT 2) b
        ON b.batch = 0 OR (b.batch = 1 AND o.event_id % 50 = 0) OR (b.batch = 2 AND o.event_id % 67 = 0)""",
}

# Which parts each part needs, nearest first.
NEEDS = {
    "ev": (),
    "obs": ("ev",),
    "wx": ("ev",),
    "avail": ("wx",),
    "enr": ("obs", "avail"),
    "conf": (),
    "loc": ("conf",),
    "fct": ("enr", "loc"),
    "daily": ("fct",),
    "byloc": ("fct",),
    "wmart": ("fct",),
    "rec": ("obs",),
}


def _window(minute: str) -> str:
    return f"strftime(TIMESTAMP '2020-01-01 00:00:00' + to_minutes({minute}), '%Y-%m-%dT%H:%M:%SZ')"


def _path(batch: str) -> str:
    label = "replace(replace({}, '-', ''), ':', '')".format
    return (
        "'openaq/measurements/location_id=' || location_id || '/parameter=' || parameter || '/sensor_id=' "
        f"|| sensor_id || '/' || {label(_window('block'))} || '__' || {label(_window(f'block + 1 + {batch}'))} || '.json'"
    )


def _with(parts: str, body: str) -> str:
    """Body with the named parts, and what they need, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in parts.split():
        add(name)
    ctes = []
    for name in ordered:
        text = PARTS[name]
        if name == "obs":
            text = text.format(path0=_path("0"), w0=_window("block"), w1=_window("block + 1"))
        ctes.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _t(column: str) -> str:
    return f"strftime({column}, {TS}) AS {column.split('.')[-1]}"


def _d(column: str) -> str:
    return f"strftime({column}, {DAY}) AS {column.split('.')[-1]}"


def _r(column: str) -> str:
    return f"round({column}, 9) AS {column.split('.')[-1]}"


KEY = f"location_id, sensor_id, parameter, {_t('datetime_from_utc')}, {_t('datetime_to_utc')}"
WAREHOUSE = f"""location_id, location_name, sensor_id, parameter, parameter_id, unit, value, period_label,
    period_interval, {_t('datetime_from_utc')}, {_t('datetime_to_utc')}, datetime_from_local, datetime_to_local,
    {_d('measurement_date_utc')}, latitude, longitude, source, source_file, retrieval_datetime_from,
    retrieval_datetime_to, {_t('weather_hour_utc')}, temperature_2m_c, relative_humidity_2m_pct, precipitation_mm,
    wind_speed_10m_kmh, weather_source, weather_latitude, weather_longitude"""
GRAIN = f"{_d('measurement_date_utc')}, location_id, parameter, unit"
STATS = f"observation_count, {_r('average_value')}, minimum_value, maximum_value, weather_context_count, {_r('weather_context_percentage')}"
SPAN = f"{_t('earliest_observation_utc')}, {_t('latest_observation_utc')}"
WEATHER_STATS = (
    f"observation_count, {_r('average_pollution_value')}, {_r('average_temperature_2m_c')}, "
    f"{_r('average_relative_humidity_2m_pct')}, {_r('average_precipitation_mm')}, {_r('average_wind_speed_10m_kmh')}"
)
WEATHER_COUNTS = (
    "temperature_observation_count, humidity_observation_count, precipitation_observation_count, wind_observation_count"
)
FIELDS = f"""sensor_id, parameter, unit, value, {_t('datetime_from_utc')}, {_t('datetime_to_utc')},
    has_weather_context, {_t('weather_hour_utc')}, temperature_2m_c, relative_humidity_2m_pct, precipitation_mm,
    wind_speed_10m_kmh, weather_source"""
RECENCY = "datetime_to_utc DESC, parameter, unit, sensor_id, datetime_from_utc DESC"
PROCESSED = f"""source, location_id, {{name}} AS location_name, sensor_id, parameter, parameter_id, unit, value,
    period_label, period_interval, {_t('datetime_from_utc')}, {_t('datetime_to_utc')}, datetime_from_local,
    datetime_to_local, latitude, longitude, {{path}} AS source_file, retrieval_datetime_from,
    {_window('block + 1 + batch')} AS retrieval_datetime_to, ns AS datetime_from_ns, ns AS datetime_to_ns"""
NAME = "'NATION_' || (location_id - 1)"


def _series(mart: str, where: str, fields: str, lower: str, upper: str, limit: int, chosen: str) -> str:
    return f"""
    , bounds AS (SELECT {upper} AS last_day FROM fct WHERE {where}),
    page AS (SELECT m.*, row_number() OVER (ORDER BY measurement_date_utc, location_id, parameter, unit) AS position,
            count(*) OVER () > {limit} AS truncated, count(*) OVER () AS n
        FROM {mart} m, bounds WHERE {where} AND measurement_date_utc >= {lower} AND measurement_date_utc <= last_day)
    SELECT {chosen.format(fields=fields)} FROM page WHERE position <= {limit}"""


SERIES_COLUMNS = f"{_d('measurement_date_utc')}, location_id, location_name, parameter, unit, {{fields}}, position, truncated"


def _faulty(columns: str) -> str:
    return f"SELECT {columns} FROM enr"


SQL: dict[str, str] = {}

SQL["fct_observations"] = _with(
    "fct",
    f"SELECT {WAREHOUSE}, canonical_location_name, canonical_latitude, canonical_longitude, has_weather_context FROM fct",
)
SQL["has_weather_join"] = _with(
    "enr",
    f"SELECT {KEY}, {_t('weather_hour_utc')}, (weather_source IS NOT NULL)::BIGINT AS has_weather, temperature_2m_c FROM enr",
)
SQL["agg_daily"] = _with("daily", f"SELECT {GRAIN}, location_name, {STATS} FROM daily")
SQL["agg_location"] = _with(
    "byloc", f"SELECT location_id, parameter, unit, location_name, {STATS}, {SPAN} FROM byloc"
)
SQL["agg_pollution_weather"] = _with(
    "wmart", f"SELECT {GRAIN}, location_name, {WEATHER_STATS}, {WEATHER_COUNTS} FROM wmart"
)
SQL["recent_with_location"] = _with(
    "enr loc",
    f"""SELECT {_t('o.datetime_to_utc')}, o.location_id, l.location_name, o.parameter, o.unit, o.value,
    o.temperature_2m_c, o.relative_humidity_2m_pct, o.precipitation_mm, o.wind_speed_10m_kmh
    FROM enr o JOIN loc l ON l.location_id = o.location_id
    ORDER BY o.datetime_to_utc DESC, o.location_id, o.sensor_id, o.parameter LIMIT 100""",
)
SQL["avg_by_location"] = _with(
    "obs",
    """SELECT location_id, parameter, unit, count(*) AS observations, round(avg(value), 9) AS average_concentration
    FROM obs GROUP BY ALL""",
)
SQL["avg_with_weather"] = _with(
    "enr",
    """SELECT location_id, parameter, unit, count(*) AS observations, round(avg(value), 9) AS average_concentration,
    count(temperature_2m_c) AS temperature_samples, count(relative_humidity_2m_pct) AS humidity_samples,
    count(wind_speed_10m_kmh) AS wind_samples, round(avg(temperature_2m_c), 9) AS average_temperature_c,
    round(avg(relative_humidity_2m_pct), 9) AS average_humidity_pct,
    round(avg(wind_speed_10m_kmh), 9) AS average_wind_kmh FROM enr GROUP BY location_id, parameter, unit""",
)
SQL["daily_avg"] = _with(
    "obs",
    f"""SELECT {GRAIN}, observations, average_concentration FROM (
    SELECT measurement_date_utc, location_id, parameter, unit, count(*) AS observations,
    round(avg(value), 9) AS average_concentration FROM obs GROUP BY ALL)""",
)
SQL["mart_daily_pm25"] = _with(
    "daily",
    f"""SELECT {GRAIN}, location_name, observation_count, {_r('average_value')}, {_r('weather_context_percentage')}
    FROM daily WHERE parameter = 'pm25'""",
)
SQL["mart_location_pm10"] = _with(
    "byloc",
    f"""SELECT location_id, location_name, parameter, unit, observation_count, {_r('average_value')}, {SPAN}
    FROM byloc WHERE parameter = 'pm10'""",
)
SQL["mart_weather"] = _with("wmart", f"SELECT {GRAIN}, {WEATHER_STATS} FROM wmart")
SQL["latest_per_group"] = _with(
    "fct",
    f"""SELECT location_id, canonical_location_name, sensor_id, parameter, unit, value, {_t('datetime_from_utc')},
    {_t('datetime_to_utc')}, has_weather_context FROM fct
    QUALIFY row_number() OVER (PARTITION BY location_id, parameter, unit
        ORDER BY fct.datetime_to_utc DESC, fct.datetime_from_utc DESC, sensor_id) = 1""",
)
SQL["summary_totals"] = _with(
    "byloc",
    """SELECT count(DISTINCT location_id) AS monitored_locations,
    coalesce(sum(observation_count), 0)::BIGINT AS observation_count,
    round(100.0::DOUBLE * sum(weather_context_count) / nullif(sum(observation_count), 0), 9) AS weather_coverage,
    strftime(min(earliest_observation_utc), '%Y-%m-%d %H:%M:%S.%f') AS earliest_observation,
    strftime(max(latest_observation_utc), '%Y-%m-%d %H:%M:%S.%f') AS latest_observation FROM byloc""",
)
_AVERAGES = """SELECT parameter, unit,
    round(sum(average_value * observation_count) / nullif(sum(observation_count), 0), 9) AS average_value,
    sum(observation_count)::BIGINT AS observation_count FROM byloc {} GROUP BY parameter, unit"""
SQL["summary_averages"] = _with("byloc", _AVERAGES.format(""))
SQL["metric_card"] = _with("byloc", _AVERAGES.format("WHERE parameter = 'pm10'"))
SQL["locations_with_parameters"] = _with(
    "byloc",
    """SELECT l.location_id, l.location_name, l.latitude, l.longitude, coalesce(p.parameters, '') AS parameters
    FROM (SELECT location_id, location_name, latitude, longitude FROM loc UNION ALL
        SELECT 99, location_name, latitude, longitude FROM loc WHERE location_id = 25) l
    LEFT JOIN (SELECT location_id, string_agg(parameter, ',' ORDER BY parameter) AS parameters
        FROM (SELECT DISTINCT location_id, parameter FROM byloc) GROUP BY location_id) p
    ON p.location_id = l.location_id""",
)
SQL["station_catalogue"] = _with(
    "byloc",
    """SELECT l.location_id, l.location_name, coalesce(p.parameters, '') AS parameters
    FROM loc l LEFT JOIN (SELECT location_id, string_agg(parameter, ',' ORDER BY parameter) AS parameters
        FROM (SELECT DISTINCT location_id, parameter FROM byloc) GROUP BY location_id) p
    ON p.location_id = l.location_id""",
)
SQL["location_header"] = _with(
    "loc", "SELECT location_id, location_name, latitude, longitude FROM loc WHERE location_id = 7"
)
SQL["location_latest"] = _with(
    "fct",
    f"""SELECT {FIELDS} FROM fct WHERE location_id = 7 QUALIFY row_number() OVER (PARTITION BY parameter, unit
    ORDER BY fct.datetime_to_utc DESC, fct.datetime_from_utc DESC, sensor_id) = 1""",
)
SQL["location_recent"] = _with(
    "fct", f"SELECT {FIELDS} FROM (SELECT * FROM fct WHERE location_id = 7 ORDER BY {RECENCY} LIMIT 20)"
)
_RECENT = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY {RECENCY}) AS recency FROM fct)"""
SQL["location_recent20"] = _with(
    "fct", f", {_RECENT} SELECT location_id, {FIELDS}, recency FROM ranked WHERE recency <= 20"
)
SQL["latest_matched_in_recent"] = _with(
    "fct",
    f""", {_RECENT}, matched AS (SELECT * FROM ranked WHERE recency <= 20 AND has_weather_context)
    SELECT location_id, recency, {FIELDS} FROM matched
    QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY recency) = 1""",
)
SQL["series_trends"] = _with(
    "daily",
    _series("daily", "parameter = 'pm25'", STATS, "last_day - 89", "max(measurement_date_utc)", 1000, SERIES_COLUMNS),
)
SQL["series_weather"] = _with(
    "wmart",
    _series(
        "wmart",
        "parameter = 'pm10' AND location_id = 3",
        f"{WEATHER_STATS}, {WEATHER_COUNTS}",
        "DATE '2024-01-05'",
        "max(measurement_date_utc)",
        1000,
        SERIES_COLUMNS,
    ),
)
SQL["series_bounded"] = _with(
    "daily",
    _series(
        "daily", "parameter = 'pm10'", STATS, "DATE '2024-01-10'", "max(DATE '2024-01-12')", 20, SERIES_COLUMNS
    ),
)
SQL["series_tail"] = _with(
    "daily",
    _series(
        "daily",
        "parameter = 'pm10' AND location_id = 5",
        "",
        "last_day - 89",
        "max(measurement_date_utc)",
        120,
        f"{_d('measurement_date_utc')}, unit, observation_count, least(n, 120) AS returned_row_count, truncated",
    )
    + " AND position > least(n, 120) - 12",
)
SQL["comparison"] = _with(
    "byloc",
    f"SELECT location_id, location_name, parameter, unit, {STATS}, {SPAN} FROM byloc WHERE parameter = 'pm10'",
)
SQL["units_split"] = _with(
    "daily",
    """, d AS (SELECT * FROM daily WHERE parameter = 'pm10' AND location_id = 5
        AND measurement_date_utc >= (SELECT max(measurement_date_utc) - 89 FROM fct
            WHERE parameter = 'pm10' AND location_id = 5))
    SELECT unit, count(*) AS row_count, string_agg(strftime(measurement_date_utc, '%Y-%m-%d'), ','
        ORDER BY measurement_date_utc) AS days FROM d GROUP BY unit""",
)
SQL["map_extent"] = _with(
    "loc",
    """SELECT min(latitude) AS south, max(latitude) AS north, min(longitude) AS west, max(longitude) AS east,
    count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS mapped,
    count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS without_coordinates FROM loc""",
)
_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sept','Oct','Nov','Dec']"
_SHOWN = (
    "day({t}) || ' ' || " + _MONTHS + "[month({t})] || ' ' || year({t}) || ', ' || strftime({t}, '%H:%M') || ' SAST'"
)
SQL["display_labels"] = _with(
    "obs",
    f"""SELECT sensor_id, strftime(datetime_to_utc, {TS}) AS at,
    {_SHOWN.format(t='(datetime_to_utc + INTERVAL 2 HOUR)')} AS shown,
    {_SHOWN.format(t="(date_trunc('day', datetime_to_utc) + INTERVAL 2 HOUR)")} AS bucket,
    day(datetime_to_utc) || ' ' || {_MONTHS}[month(datetime_to_utc)] AS short_date,
    CASE parameter WHEN 'pm25' THEN 'PM2.5' ELSE 'PM10' END AS pollutant,
    coalesce(location_name, 'Location ' || location_id) AS place,
    regexp_replace(replace(replace(replace(CASE WHEN round(value::DECIMAL(18, 2), 1) < 0 THEN '-' ELSE '' END
        || format('{{:,}}', trunc(abs(round(value::DECIMAL(18, 2), 1)))::BIGINT) || '.'
        || ((abs(round(value::DECIMAL(18, 2), 1)) * 10)::BIGINT % 10), ',', chr(160)), '.', ','), '~', ''), ',0$', '')
        AS number FROM obs""",
)
SQL["reject_reasons"] = _with(
    "rec",
    "SELECT reason AS reject_reason, count(*) AS records FROM rec WHERE batch < 2 AND reason IS NOT NULL GROUP BY reason",
)
SQL["normalized_rows"] = _with(
    "rec",
    f"""SELECT {PROCESSED.format(name=NAME, path=_path('batch'))} FROM rec WHERE batch < 2 AND reason IS NULL""",
)
SQL["dedup_rows"] = _with(
    "rec", f"SELECT {PROCESSED.format(name=NAME, path=_path('batch'))} FROM rec WHERE batch = 0 AND reason IS NULL"
)
SQL["conflict_keys"] = _with(
    "rec",
    f"""SELECT {KEY}, ns AS datetime_from_ns, ns AS datetime_to_ns, 2 + (event_id % 50 = 0)::BIGINT AS copies
    FROM rec WHERE batch = 2 AND reason IS NULL""",
)
SQL["quality_report"] = _with(
    "rec",
    f""", r AS (SELECT * FROM rec WHERE batch < 2), kept AS (SELECT * FROM r WHERE batch = 0 AND reason IS NULL)
    SELECT 'raw_files_discovered' AS metric, '' AS item, count(DISTINCT {_path('batch')}) AS n FROM r
    UNION ALL SELECT 'raw_measurement_records_read', '', count(*) FROM r
    UNION ALL SELECT 'valid_observations_before_deduplication', '', count(*) FROM r WHERE reason IS NULL
    UNION ALL SELECT 'invalid_observations_rejected', '', count(*) FROM r WHERE reason IS NOT NULL
    UNION ALL SELECT 'identical_duplicates_removed', '', count(*) FROM r WHERE batch = 1 AND reason IS NULL
    UNION ALL SELECT 'final_processed_row_count', '', count(*) FROM kept
    UNION ALL SELECT 'negative_measurement_count', '', count(*) FROM kept WHERE value < 0
    UNION ALL SELECT 'rejection_counts_by_reason', reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'counts_by_parameter', 'pm25', count(*) FROM kept WHERE parameter = 'pm25'
    UNION ALL SELECT 'counts_by_parameter', 'pm10', count(*) FROM kept WHERE parameter = 'pm10'""",
)
SQL["envelope_checks"] = _with(
    "rec",
    f""", f AS (SELECT DISTINCT {_path('batch')} AS path, sensor_id, batch FROM rec WHERE batch < 2),
    judged AS (SELECT *, CASE WHEN sensor_id % 11 IN (0, 1, 2, 4, 7) THEN 'invalid raw envelope/provenance'
        WHEN sensor_id % 11 IN (3, 5, 6, 9) THEN 'unreadable or invalid JSON' ELSE 'valid' END AS outcome FROM f)
    SELECT outcome, count(*) AS files, arg_min(path, string_split(path, '/')) AS first_path FROM judged GROUP BY outcome""",
)


def _rule_counts(source: str, rules: dict[str, str]) -> str:
    counters = ", ".join(f"count(*) FILTER (WHERE {c}) AS {name}" for name, c in rules.items())
    return f"""SELECT rule, violations FROM (SELECT {counters} FROM {source})
    UNPIVOT (violations FOR rule IN ({', '.join(rules)}))"""


_TEXT_RULES = {
    "source": "event_id % 89 = 0",
    "parameter": "event_id % 83 = 0",
    "unit": "event_id % 97 = 0",
    "location_id": "event_id % 79 = 0",
    "sensor_id": "event_id % 73 = 0",
    "parameter_id": "event_id % 71 = 0",
    "value": "event_id % 67 = 0",
    "latitude": "event_id % 61 = 0",
    "longitude": "event_id % 59 = 0",
    "datetime_from_utc": "event_id % 53 = 0",
    "datetime_to_utc": "event_id % 47 = 0",
    "period": "event_id % 43 = 0 AND event_id % 53 <> 0 AND event_id % 47 <> 0",
    "measurement_date_utc": "event_id % 41 = 0 AND event_id % 47 <> 0",
}
SQL["curation_violations"] = _with("obs", _rule_counts("obs", _TEXT_RULES))
_ANY_TEXT_FAULT = " OR ".join(f"({c})" for c in _TEXT_RULES.values())
SQL["curated_rows"] = _with(
    "obs",
    f"""SELECT source, location_id, location_name, sensor_id, parameter, parameter_id, unit, value, period_label,
    period_interval, {_t('datetime_from_utc')}, {_t('datetime_to_utc')}, datetime_from_local, datetime_to_local,
    latitude, longitude, source_file, retrieval_datetime_from, retrieval_datetime_to, 0 AS datetime_from_ns,
    0 AS datetime_to_ns, {_d('measurement_date_utc')} FROM obs WHERE NOT ({_ANY_TEXT_FAULT})""",
)
SQL["curated_manifest"] = _with(
    "obs",
    f"""SELECT count(*) AS row_count, count(*) FILTER (WHERE parameter = 'pm25') AS pm25_rows,
    count(*) FILTER (WHERE parameter = 'pm10') AS pm10_rows, count(DISTINCT location_id) AS location_count,
    count(DISTINCT sensor_id) AS sensor_count, strftime(min(datetime_from_utc), {TS}) AS earliest_measurement_start_utc,
    strftime(max(datetime_to_utc), {TS}) AS latest_measurement_end_utc,
    count(DISTINCT (parameter, measurement_date_utc)) AS partition_count FROM obs""",
)
SQL["readback_diff"] = _with(
    "obs",
    f""", copied AS (
        SELECT *, event_id % 83 = 0 OR event_id % 79 = 0 AS changed,
            CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 89 = 0 THEN 2 ELSE 1 END AS copies FROM obs),
    lost AS (SELECT *, -1 AS s FROM copied WHERE changed OR copies = 0),
    more AS (SELECT * REPLACE (CASE WHEN event_id % 83 = 0 THEN value + 1 ELSE value END AS value,
            CASE WHEN event_id % 79 = 0 THEN source_file || '~' ELSE source_file END AS source_file),
            CASE WHEN changed THEN copies ELSE copies - 1 END AS s FROM copied
        WHERE (changed AND copies > 0) OR copies = 2)
    SELECT source, location_id, location_name, sensor_id, parameter, parameter_id, unit, value, period_label,
    period_interval, {_t('datetime_from_utc')}, {_t('datetime_to_utc')}, datetime_from_local, datetime_to_local,
    latitude, longitude, source_file, retrieval_datetime_from, retrieval_datetime_to, {_d('measurement_date_utc')},
    s::BIGINT AS surplus FROM (SELECT * FROM lost UNION ALL SELECT * FROM more)""",
)
_WEATHER_FILES = """, f AS (SELECT *, (day(d) + location_id) % 23 AS fault FROM (
    SELECT location_id, weather_hour_utc::DATE AS d, count(*) AS hours,
        count(temperature_2m_c) AS known FROM wx GROUP BY ALL)) """
_WEATHER_RULES = {
    "unreadable": "fault = 11",
    "provider_error": "fault = 12",
    "not_utc": "fault IN (1, 11)",
    "missing_array": "fault IN (11, 13)",
    "unequal_arrays": "fault = 9",
    "wrong_units": "fault IN (2, 11)",
    "bad_hour": "fault = 4",
    "duplicate_hour": "fault = 3",
    "bad_temperature": "fault = 5",
    "bad_humidity": "fault = 6",
    "bad_precipitation": "fault = 7",
    "bad_wind": "fault = 8",
    "bad_position": "fault = 10",
}
SQL["weather_violations"] = _with("wx", _WEATHER_FILES + _rule_counts("f", _WEATHER_RULES))
_METRICS = "temperature_2m_c, relative_humidity_2m_pct, precipitation_mm, wind_speed_10m_kmh, weather_source, weather_latitude, weather_longitude"
SQL["weather_hours"] = _with(
    "wx",
    f"""SELECT location_id, {_t('weather_hour_utc')}, {_METRICS} FROM wx
    WHERE (day(wx.weather_hour_utc) + location_id) % 23 NOT BETWEEN 1 AND 13""",
)
SQL["available_hours"] = _with("avail", f"SELECT location_id, {_t('weather_hour_utc')}, {_METRICS} FROM avail")
SQL["coordinates_resolved"] = _with(
    "obs conf",
    """, p AS (SELECT location_id, latitude + CASE WHEN location_id % 6 = 0 THEN (k % 2) * 0.000005::DOUBLE
            WHEN location_id % 7 = 0 THEN (k % 2) * 0.5::DOUBLE ELSE 0.0::DOUBLE END AS lat, longitude AS lon FROM obs),
    g AS (SELECT location_id, min(lat) AS lat, arg_min(lon, lat) AS lon, max(lat) - min(lat) > 1e-5 AS clash
        FROM p GROUP BY location_id),
    j AS (SELECT g.*, c.latitude AS c_lat, c.longitude AS c_lon, CASE
        WHEN lat IS NOT NULL AND clash THEN 'conflicting coordinates'
        WHEN lat IS NULL AND (c.latitude IS NULL OR c.longitude IS NULL) THEN 'no confirmed coordinates' END AS err
        FROM g LEFT JOIN conf c ON c.id = g.location_id)
    SELECT location_id, CASE WHEN err IS NULL THEN round(coalesce(lat, c_lat), 9) END AS latitude,
        CASE WHEN err IS NULL THEN coalesce(lon, c_lon) END AS longitude,
        CASE WHEN err IS NULL THEN CASE WHEN lat IS NULL THEN 'configuration' ELSE 'observations' END END AS origin,
        err AS coordinate_error FROM j""",
)
_REQUESTS = """, g AS (SELECT location_id, min(location_name) AS location_name, min(latitude) AS lat, min(longitude) AS lon,
        strftime(min(datetime_to_utc), '%Y-%m-%d') AS start_date, strftime(max(datetime_to_utc), '%Y-%m-%d') AS end_date
        FROM obs GROUP BY location_id),
    q AS (SELECT g.location_id, g.location_name, coalesce(lat, c.latitude) AS latitude, coalesce(lon, c.longitude) AS longitude,
        start_date, end_date, CASE WHEN coalesce(lat, c.latitude) IS NULL THEN 'no confirmed coordinates' END AS coordinate_error
        FROM g LEFT JOIN conf c ON c.id = g.location_id) """
SQL["request_plan"] = _with("obs conf", _REQUESTS + "SELECT * FROM q")
SQL["request_cache"] = _with(
    "obs conf",
    _REQUESTS
    + """SELECT location_id, start_date, end_date, (location_id % 2 = 0)::BIGINT AS cache_hit,
    sha256('{"end_date":"' || end_date || '","hourly":"temperature_2m,relative_humidity_2m,precipitation,wind_speed_10m"'
        || ',"latitude":' || latitude || ',"location_id":' || location_id || ',"longitude":' || longitude
        || ',"precipitation_unit":"mm","start_date":"' || start_date
        || '","temperature_unit":"celsius","timezone":"UTC","wind_speed_unit":"kmh"}') AS request_key FROM q
    WHERE coordinate_error IS NULL""",
)
SQL["enrichment_manifest"] = _with(
    "enr",
    f"""SELECT count(*) AS air_quality_rows, count(weather_source) AS weather_matched_rows,
    count(*) - count(weather_source) AS weather_unmatched_rows,
    round(100.0::DOUBLE * count(weather_source) / count(*), 9) AS weather_match_percentage,
    count(DISTINCT location_id) AS location_count, count(DISTINCT sensor_id) AS sensor_count,
    count(*) FILTER (WHERE parameter = 'pm25') AS pm25_rows, count(*) FILTER (WHERE parameter = 'pm10') AS pm10_rows,
    strftime(min(datetime_from_utc), {TS}) AS earliest_measurement,
    strftime(max(datetime_to_utc), {TS}) AS latest_measurement,
    (SELECT count(*) FROM avail) AS weather_rows_available FROM enr""",
)
SQL["dim_locations"] = _with(
    "enr conf",
    """, g AS (SELECT location_id, max(location_name) AS location_name, max(latitude) AS lat, max(longitude) AS lon,
        max(weather_latitude) AS weather_latitude, max(weather_longitude) AS weather_longitude FROM enr GROUP BY location_id)
    SELECT g.location_id, g.location_name, coalesce(lat, c.latitude) AS latitude, coalesce(lon, c.longitude) AS longitude,
    weather_latitude, weather_longitude FROM g LEFT JOIN conf c ON c.id = g.location_id""",
)
SQL["dimension_conflicts"] = _with(
    "enr",
    """, f AS (SELECT location_id, CASE WHEN event_id % 43 = 0 THEN 'RENAMED' ELSE location_name END AS n,
        CASE WHEN event_id % 79 = 0 THEN 95.0 ELSE latitude END AS lat FROM enr)
    SELECT location_id, 'location_name' AS column_name FROM f GROUP BY location_id HAVING min(n) <> max(n)
    UNION ALL SELECT location_id, 'latitude' FROM f GROUP BY location_id HAVING min(lat) <> max(lat)""",
)
SQL["warehouse_violations"] = _with(
    "enr",
    """, f AS (SELECT event_id, CASE
        WHEN event_id % 59 = 0 THEN 'null_source'
        WHEN event_id % 47 = 0 THEN 'not_finite_value'
        WHEN event_id % 83 = 0 THEN 'parameter'
        WHEN event_id % 89 = 0 THEN 'unit'
        WHEN event_id % 73 = 0 THEN 'period'
        WHEN event_id % 61 = 0 AND weather_source IS NOT NULL THEN 'weather_source'
        WHEN event_id % 53 = 0 AND weather_source IS NULL THEN 'weather_without_source'
        WHEN event_id % 71 = 0 THEN 'measurement_date_utc'
        WHEN event_id % 67 = 0 THEN 'weather_hour_utc'
        WHEN event_id % 79 = 0 THEN 'latitude' END AS violation FROM enr)
    SELECT event_id, violation FROM f WHERE violation IS NOT NULL""",
)
_DRIFT = {
    "location_id": 61, "parameter_id": 47, "unit": 43, "datetime_to_utc": 71, "measurement_date_utc": 41,
    "latitude": 67, "weather_hour_utc": 59, "temperature_2m_c": 53,
}
_DRIFT_ERROR = " ".join(f"WHEN event_id % {divisor} = 0 THEN '{name}'" for name, divisor in _DRIFT.items())
SQL["scan_by_name"] = _with(
    "enr",
    f""", f AS (SELECT *, event_id % 3 AS third FROM enr)
    SELECT event_id, CASE WHEN third = 1 THEN CASE {_DRIFT_ERROR} END END AS cast_error,
        CASE WHEN third <> 1 THEN location_id END AS location_id, sensor_id, parameter,
        CASE WHEN third = 2 THEN parameter_id END AS parameter_id, CASE WHEN third <> 1 THEN unit END AS unit, value,
        CASE WHEN third <> 0 THEN period_label END AS period_label,
        CASE WHEN third <> 1 THEN strftime(datetime_to_utc, {TS}) END AS datetime_to_utc,
        CASE WHEN third <> 1 OR event_id % 41 <> 0 THEN strftime(measurement_date_utc, {DAY}) END AS measurement_date_utc,
        CASE WHEN third <> 1 THEN latitude END AS latitude,
        CASE WHEN third <> 1 THEN strftime(weather_hour_utc, {TS}) END AS weather_hour_utc,
        CASE WHEN third <> 1 THEN temperature_2m_c END AS temperature_2m_c
    FROM f""",
)
_EXPORTED = "strftime({0}, '%Y-%m-%d %H:%M:%S') || CASE WHEN strftime({0}, '%f') <> '000000' THEN '.' || strftime({0}, '%f') ELSE '' END || '+00:00' AS {0}"
SQL["export_order"] = _with(
    "obs",
    f"""SELECT row_number() OVER (ORDER BY obs.datetime_from_utc, obs.datetime_to_utc, location_id, sensor_id, parameter) - 1 AS place,
        location_id, sensor_id, parameter, unit, value, source_file,
        {_EXPORTED.format("datetime_from_utc")}, {_EXPORTED.format("datetime_to_utc")} FROM obs""",
)
SQL["warehouse_checks"] = _with(
    "obs loc",
    """, r AS (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE event_id % 97 = 0)
    SELECT count(*) AS observations, (SELECT count(*) FROM loc) AS locations,
    count(*) FILTER (WHERE event_id % 97 = 0) // 2 AS duplicate_keys,
    count(*) FILTER (WHERE event_id % 83 = 0) AS bad_parameters,
    count(*) FILTER (WHERE location_id % 5 = 0) AS orphans FROM r""",
)
SQL["load_summary"] = _with(
    "enr loc",
    f"""SELECT count(*) AS input_observations, count(*) AS observations_loaded,
    count(*) FILTER (WHERE parameter = 'pm25') AS pm25_rows, count(*) FILTER (WHERE parameter = 'pm10') AS pm10_rows,
    count(weather_source) AS weather_matched_rows, count(*) - count(weather_source) AS weather_unmatched_rows,
    strftime(min(datetime_from_utc), {TS}) AS earliest_observation,
    strftime(max(datetime_to_utc), {TS}) AS latest_observation,
    (SELECT count(*) FROM loc) AS locations_loaded FROM enr""",
)

# Observations and locations with the faults the model tests look for.
_QT = """, base AS (SELECT event_id, CASE WHEN location_id % 5 = 0 THEN location_id + 1000 ELSE location_id END AS location_id, sensor_id, datetime_from_utc, datetime_to_utc, measurement_date_utc, value,
        CASE WHEN event_id % 97 <> 0 THEN unit END AS unit,
        CASE WHEN event_id % 89 = 0 THEN 'no2' ELSE parameter END AS parameter,
        CASE WHEN event_id % 83 <> 0 THEN source END AS source, weather_source IS NOT NULL AS matched FROM enr),
    qt AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE event_id % 79 = 0),
    site AS (SELECT * FROM loc),
    sites AS (SELECT * FROM site UNION ALL SELECT * FROM site WHERE location_id % 8 = 0),
    qd AS (SELECT DISTINCT measurement_date_utc, location_id, parameter, unit FROM qt),
    ql AS (SELECT DISTINCT location_id, parameter, unit FROM qt),
    qw AS (SELECT DISTINCT measurement_date_utc, location_id, parameter, unit FROM qt WHERE matched)"""


def _generic() -> str:
    """Zero everywhere except for the tests that the planted faults break."""
    from envlake.operators import expectations as e

    broken_rows = {
        "unit": "unit IS NULL",
        "source": "source IS NULL",
    }
    relation = {
        "locations": "sites",
        "stg_locations": "site",
        "agg_daily_air_quality": "qd",
        "agg_location_air_quality": "ql",
        "agg_pollution_weather": "qw",
    }
    lines = []
    for model, columns in e.NOT_NULL.items():
        table = relation.get(model, "qt")
        for column in columns:
            condition = broken_rows.get(column, "false")
            lines.append(
                f"SELECT '{model}' AS model, 'not_null' AS test, '{column}' AS column_name, "
                f"count(*) FILTER (WHERE {condition}) AS failures FROM {table}"
            )
    for model in e.ACCEPTED_PARAMETERS:
        lines.append(
            f"SELECT '{model}', 'accepted_values', 'parameter', count(*) FILTER (WHERE parameter = 'no2') "
            f"FROM {relation.get(model, 'qt')}"
        )
    for model in e.UNIQUE:
        lines.append(
            f"SELECT '{model}', 'unique', 'location_id', count(*) FROM (SELECT location_id FROM {relation[model]} "
            "GROUP BY location_id HAVING count(*) > 1)"
        )
    for model in e.RELATIONSHIPS:
        lines.append(
            f"SELECT '{model}', 'relationships', 'location_id', count(*) FILTER (WHERE location_id % 5 = 0) FROM qt"
        )
    return "\nUNION ALL ".join(lines)


SQL["qt_generic"] = _with("enr loc", f"{_QT} {_generic()}")
SQL["qt_not_null"] = _with("enr loc", f"{_QT} SELECT {KEY} FROM qt WHERE unit IS NULL")
SQL["qt_unique"] = _with(
    "enr loc",
    f"{_QT} SELECT location_id, count(*) AS record_count FROM sites GROUP BY location_id HAVING count(*) > 1",
)
SQL["qt_accepted"] = _with(
    "enr loc",
    f"{_QT} SELECT parameter, count(*) AS record_count FROM qt WHERE parameter = 'no2' GROUP BY parameter",
)
SQL["qt_relationships"] = _with(
    "enr loc",
    f"""{_QT} SELECT location_id, count(*) AS record_count FROM qt
    WHERE location_id NOT IN (SELECT location_id FROM site) GROUP BY location_id""",
)
SQL["qt_natural_key"] = _with(
    "enr loc",
    f"""{_QT}, rel AS (SELECT unnest(['warehouse', 'intermediate', 'fact']) AS relation_name)
    SELECT relation_name, {KEY}, 2 AS record_count FROM base, rel WHERE event_id % 79 = 0""",
)
SQL["qt_row_counts"] = _with(
    "enr loc",
    f"""{_QT} SELECT count(*) AS warehouse_rows, count(*) AS staging_rows, count(*) AS intermediate_rows,
    count(unit) AS fact_rows FROM qt HAVING count(*) <> count(unit)""",
)
SQL["qt_grain"] = _with(
    "daily byloc",
    f"""SELECT 'daily' AS mart, {GRAIN}, 2 AS record_count FROM daily WHERE observation_count % 5 = 0
    UNION ALL SELECT 'location', NULL, location_id, parameter, unit, 2 FROM byloc WHERE location_id % 4 = 0""",
)
SQL["qt_invariants"] = _with(
    "daily byloc",
    """SELECT 'daily' AS mart, location_id, parameter, unit FROM daily WHERE observation_count % 5 = 0
    UNION ALL SELECT 'location', location_id, parameter, unit FROM byloc WHERE location_id % 4 = 0""",
)
SQL["qt_weather_matches"] = _with(
    "wmart",
    """SELECT location_id, parameter, unit FROM wmart WHERE location_id % 4 = 0 OR location_id % 5 = 0
    UNION ALL SELECT location_id + 1000, parameter, unit FROM wmart WHERE location_id % 5 = 0""",
)

SQL["location_selection"] = _with(
    "conf",
    """SELECT 'all' AS scope, id::BIGINT AS id, name, latitude, longitude FROM conf
    UNION ALL SELECT 'one', id, name, latitude, longitude FROM conf WHERE id = 7
    UNION ALL SELECT 'unknown', 999, 'location_id must belong to the approved configuration.', latitude, longitude
    FROM conf WHERE id = 7""",
)
_SENSORS = """, s AS (SELECT DISTINCT location_id, sensor_id, CASE WHEN location_id % 6 = 0 THEN 'no2'
    WHEN location_id % 4 = 0 THEN 'pm25' ELSE parameter END AS parameter FROM ev) """
SQL["sensor_selection"] = _with("ev", _SENSORS + "SELECT * FROM s WHERE parameter IN ('pm25', 'pm10')")
SQL["missing_parameters"] = _with(
    "ev conf",
    _SENSORS
    + """, g AS (SELECT location_id, count(*) AS n, bool_or(parameter = 'pm25') AS a, bool_or(parameter = 'pm10') AS b
        FROM s WHERE parameter <> 'no2' GROUP BY location_id)
    SELECT c.id::BIGINT AS location_id, c.name AS location_name, coalesce(n, 0) AS matching_sensors,
    concat_ws(',', CASE WHEN a THEN NULL ELSE 'pm25' END, CASE WHEN b THEN NULL ELSE 'pm10' END) AS missing_parameters
    FROM conf c LEFT JOIN g ON g.location_id = c.id""",
)
SQL["completeness"] = """SELECT o_orderkey AS response_id, CASE WHEN o_custkey % 5 = 0 THEN 'false'
    WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_custkey % 60 > o_custkey % 50 THEN 'true' ELSE 'false' END
    WHEN o_orderkey % 4 = 3 THEN CASE WHEN 25 > o_custkey % 50 THEN 'true' ELSE 'false' END
    ELSE 'unknown' END AS incomplete FROM orders"""
SQL["window_bounds"] = """WITH r AS (SELECT o_orderkey AS key, o_orderdate AS d, o_custkey % 4 - 1 AS shift,
        o_orderkey % 2 = 0 AS hist FROM orders),
    j AS (SELECT *, CASE WHEN key % 41 = 0 THEN 'unknown run mode'
        WHEN key % 7 = 0 AND key % 3 - 1 <= 0 THEN 'location_id must be positive'
        WHEN NOT hist AND key % 37 = 0 THEN 'incremental mode uses timestamps only'
        WHEN hist AND key % 13 = 0 THEN 'dates must be YYYY-MM-DD'
        WHEN hist AND shift <= 0 THEN 'end must be later than start'
        WHEN NOT hist AND key % 11 = 0 THEN 'timestamps must name a zone'
        WHEN NOT hist AND shift <= 0 THEN 'end must be later than start' END AS window_error,
        CASE WHEN hist THEN strftime(d, '%Y-%m-%d')
            ELSE strftime(d - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS f,
        CASE WHEN hist THEN strftime(d + to_days(shift::INT), '%Y-%m-%d')
            ELSE strftime(d - INTERVAL 2 HOUR + to_hours(shift), '%Y-%m-%dT%H:%M:%SZ') END AS t FROM r)
    SELECT key AS request_id, window_error, CASE WHEN window_error IS NULL THEN f END AS window_from,
    CASE WHEN window_error IS NULL THEN t END AS window_to,
    CASE WHEN window_error IS NULL THEN replace(replace(f || '__' || t, '-', ''), ':', '') END AS window_label FROM j"""
_REASONS = """WITH reasons AS (
    SELECT o_custkey AS run_id, 'Location ' || o_orderkey || ' is missing required sensors.' AS reason,
        0 AS kind, o_orderkey AS id, 0 AS part
    FROM orders WHERE o_orderkey % 11 = 0
    UNION ALL SELECT o_custkey, 'Location ' || o_orderkey || ' sensor discovery is incomplete or unknown.', 0, o_orderkey, 1
    FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0
    UNION ALL SELECT o_custkey, 'Sensor ' || o_orderkey * 10 || ' measurement completeness is incomplete or unknown.', 1, o_orderkey, 0
    FROM orders WHERE o_orderkey % 19 = 0 OR o_orderkey % 23 = 0
    UNION ALL SELECT c_custkey, 'No configured locations were processed.', -1, 0, 0 FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) """
SQL["checkpoint_reasons"] = _REASONS + "SELECT run_id, reason FROM reasons"
SQL["checkpoint_safety"] = (
    _REASONS
    + """, r AS (SELECT run_id, count(*) AS n, arg_min(reason, (kind, id, part)) AS first_reason FROM reasons GROUP BY run_id),
    s AS (SELECT o_custkey AS run_id, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS run_id, '2024-01-01T00:00:00Z' AS datetime_to,
    '2024-01-01T00:00:00Z' AS next_checkpoint_candidate, (r.n IS NULL)::BIGINT AS checkpoint_safe,
    CASE WHEN r.n IS NULL THEN 'complete' ELSE 'not_complete' END AS status, coalesce(r.n, 0) AS reason_count,
    r.first_reason, coalesce(s.n, 0) AS location_count
    FROM customer c LEFT JOIN r ON r.run_id = c_custkey LEFT JOIN s ON s.run_id = c_custkey"""
)
# The first fault or the completion by page; runs have pages 1 to 5, some of them with other numbers.
SQL["page_audit"] = """WITH a AS (SELECT o_orderkey // 5 AS run_id, o_orderkey % 5 + 1 AS page FROM orders),
    odd AS (SELECT run_id, bool_or((run_id % 41 = 0 AND page = 1) OR (run_id % 47 = 0 AND page = 2)) AS bad,
        bool_or(run_id % 43 = 0 AND page = 5 AND NOT (run_id % 41 = 0 AND page = 1)) AS beyond FROM a GROUP BY run_id),
    p AS (SELECT * FROM a WHERE NOT (run_id % 43 = 0 AND page = 5)),
    j AS (SELECT *, run_id % 1000 AS tail, run_id % 3 <> 0 AS known,
        CASE WHEN page = 5 THEN run_id % 1000 ELSE 1000 END AS returned,
        run_id % 1000 + CASE WHEN run_id % 17 = 0 THEN 4001 ELSE 4000 END AS total FROM p),
    k AS (SELECT *, sum(returned) OVER (PARTITION BY run_id ORDER BY page) AS running FROM j),
    o AS (SELECT *, CASE WHEN run_id % 19 = 0 AND page = 3 THEN 'invalid_page'
        WHEN run_id % 23 = 0 AND page = 2 THEN 'inconsistent_page_number'
        WHEN run_id % 29 = 0 AND page = 4 THEN 'inconsistent_page_size'
        WHEN known AND run_id % 31 = 0 AND page = 3 THEN 'changed_total'
        WHEN run_id % 37 = 0 AND page = 3 THEN 'repeated_page'
        WHEN known AND (running > total OR (returned = 0 AND running < total)) THEN 'inconsistent_total'
        WHEN CASE WHEN known THEN running >= total ELSE returned < 1000 END THEN 'complete' END AS outcome FROM k),
    l AS (SELECT run_id, min(page) FILTER (WHERE outcome IS NOT NULL) AS last_page, max(page) AS pages,
        max(running) AS everything FROM o GROUP BY run_id)
    SELECT 'measurements' AS resource, odd.run_id, CASE WHEN bad THEN 'inconsistent_page_number'
        ELSE coalesce(o.outcome, CASE WHEN beyond THEN 'page_limit_exceeded' ELSE 'incomplete' END) END AS status,
    CASE WHEN bad THEN 0 ELSE coalesce(last_page, pages, 0) END AS pages_fetched,
    CASE WHEN bad THEN 0 ELSE coalesce(o.running, everything, 0) END::BIGINT AS returned
    FROM odd LEFT JOIN l ON l.run_id = odd.run_id LEFT JOIN o ON o.run_id = l.run_id AND o.page = l.last_page"""
SQL["acquisition_summary"] = """WITH r AS (SELECT l_suppkey AS run_id, l_linenumber AS line,
        CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity END::BIGINT AS returned FROM lineitem)
    SELECT run_id, count(*) AS sensors_queried, sum(returned)::BIGINT AS total_measurements,
    coalesce(sum(returned) FILTER (WHERE line % 2 = 0), 0)::BIGINT AS pm25_measurements,
    coalesce(sum(returned) FILTER (WHERE line % 2 = 1), 0)::BIGINT AS pm10_measurements,
    count(*) FILTER (WHERE returned = 0) AS empty_responses,
    count(*) FILTER (WHERE line % 3 = 0) AS incomplete_responses,
    count(*) FILTER (WHERE line % 3 = 2) AS unknown_completeness_responses FROM r GROUP BY run_id"""
SQL["catalogue_flatten"] = """SELECT s_suppkey AS id, s_name AS name,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'AREA_' || s_nationkey END AS locality, 'ZA' AS country_code,
    CASE WHEN s_suppkey % 4 <> 0 THEN -35.0::DOUBLE + s_nationkey * 0.25::DOUBLE END AS latitude,
    CASE WHEN s_suppkey % 4 <> 0 THEN 16.0::DOUBLE + s_nationkey * 0.5::DOUBLE END AS longitude,
    NULL::VARCHAR AS timezone, CASE WHEN s_suppkey % 5 <> 0 THEN 'agency' END AS provider,
    'OWNER_' || s_nationkey AS owner, (s_suppkey % 2 = 0)::BIGINT AS is_mobile, 1 AS is_monitor,
    CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE CASE s_suppkey % 4
        WHEN 0 THEN 'pm25,pm10' WHEN 1 THEN 'pm10,no2,pm25' WHEN 2 THEN 'no2,pm10' ELSE 'pm25,no2' END END AS parameters
    FROM supplier"""
SQL["catalogue_totals"] = """WITH s AS (SELECT count(*) AS returned FROM supplier)
    SELECT 'text' AS stated, returned, NULL::VARCHAR AS found, 'unknown' AS incomplete FROM s
    UNION ALL SELECT 'more', returned, '100000', 'true' FROM s
    UNION ALL SELECT 'reached', returned, '5', CASE WHEN 5 > returned THEN 'true' ELSE 'false' END FROM s
    UNION ALL SELECT 'spelled', returned, '999', CASE WHEN 999 > returned THEN 'true' ELSE 'false' END FROM s
    UNION ALL SELECT 'differing', returned, NULL, 'true' FROM s"""
_REGISTERED = """WITH i AS (SELECT o_orderkey // 2 AS pair, o_orderkey % 2 AS half, o_custkey % 100 AS returned,
        CASE WHEN o_orderkey % 2 = 1 AND (o_orderkey // 2) % 13 = 0 THEN 1 ELSE 0 END AS shift FROM orders),
    g AS (SELECT pair, count(*) AS copies, min(shift) AS lo, max(shift) AS hi, sum(returned)::BIGINT AS measurements,
        bool_or(half = 0) AND (pair % 3 = 0 OR pair % 5 = 0) AS known, CASE WHEN pair % 11 = 0 THEN 9 ELSE 0 END AS stored
        FROM i GROUP BY pair),
    s AS (SELECT 'batch/' || pair AS path,
        CASE WHEN lo <> hi OR (known AND (stored <> lo OR (pair % 5 = 0 AND pair % 15 <> 0))) THEN 'conflict'
        WHEN known THEN 'reused' ELSE 'written' END AS status, copies, measurements FROM g),
    reg AS (SELECT path, status, CASE WHEN status = 'written' THEN 1 ELSE 0 END AS batches_written,
        CASE status WHEN 'written' THEN copies - 1 WHEN 'reused' THEN copies ELSE 0 END AS batches_reused,
        measurements FROM s) """
SQL["batch_registry"] = _REGISTERED + "SELECT * FROM reg"
SQL["registry_summary"] = (
    _REGISTERED
    + """SELECT sum(batches_written)::BIGINT AS batches_written, sum(batches_reused)::BIGINT AS batches_reused,
    sum(measurements)::BIGINT AS measurements_represented, count(*) FILTER (WHERE status = 'conflict') AS conflicts
    FROM reg"""
)
SQL["registry_runs"] = """WITH b AS (SELECT *, o_orderkey % 4 AS returned, CASE WHEN o_orderkey % 3 <> 2 THEN 'run-0' ELSE 'run-1' END AS run_id FROM orders)
    SELECT 'openaq/measurements/location_id=' || (o_custkey % 25 + 1) || '/parameter=pm25/sensor_id=' || (o_orderkey + 1)
        || '/20240101__20240102.json' AS path, returned, run_id, count(*) OVER (PARTITION BY run_id) AS batches_written,
        CASE run_id WHEN 'run-0' THEN 0 ELSE count(*) FILTER (WHERE o_orderkey % 3 = 1) OVER () END AS batches_reused,
        CASE run_id WHEN 'run-0' THEN sum(returned) FILTER (WHERE o_orderkey % 3 <> 2) OVER ()
            ELSE sum(returned) FILTER (WHERE o_orderkey % 3 <> 0) OVER () END::BIGINT AS measurements_represented
    FROM b"""
SQL["batch_violations"] = _rule_counts(
    "orders",
    {
        "incomplete": "o_orderkey % 13 = 0 OR o_orderkey % 11 = 0",
        "pagination": "o_orderkey % 2 = 0 AND o_orderkey % 7 = 0",
        "location_id": "o_orderkey % 31 = 0",
        "sensor_id": "o_orderkey % 29 = 0",
        "parameter": "o_orderkey % 23 = 0",
        "returned": "o_orderkey % 17 = 0",
        "window_order": "o_orderkey % 19 = 0",
    },
)

# Request number, whole text, and the location whose name comes first among those contained.
_REQUEST_LIST = ", ".join("'" + text.replace("'", "''") + "'" for text in REQUESTS)
_QUESTIONS = f"""raw AS (SELECT conv_id * 1000 + turn AS question_id, text || ' '
        || [{_REQUEST_LIST}][(conv_id * 3 + turn) % {len(REQUESTS)} + 1]
        || CASE WHEN conv_id % 3 <> 0 THEN ' at Nation_' || (conv_id % 40)
            || CASE WHEN conv_id % 2 = 0 THEN ' STRASSE' WHEN conv_id % 5 = 0 THEN ' AFFIX' ELSE '' END ELSE '' END AS asked
        FROM conversations WHERE role = 'user'),
    q AS (SELECT question_id, replace(lower(asked), 'ß', 'ss') AS asked FROM raw),
    places AS (SELECT location_id, location_name
        || CASE location_id % 3 WHEN 0 THEN ' Straße' WHEN 1 THEN ' Aﬃx' ELSE '' END AS location_name FROM loc),
    named AS (SELECT question_id, min({{'location_name': location_name, 'location_id': location_id}}) AS p
        FROM q JOIN places ON contains(asked, replace(replace(lower(location_name), 'ß', 'ss'), 'ﬃ', 'ffi')) GROUP BY question_id)"""


def _intents() -> str:
    flags = []
    for name, terms in routing.INTENTS.items():
        hit = " OR ".join(f"contains(asked, '{term}')" for term in terms)
        flags.append(f"({hit})::BIGINT AS {name}")
    squeezed = "regexp_replace(asked, '[.\\s]', '', 'g')"
    names = ", ".join(f"CASE WHEN contains({squeezed}, '{p}') THEN '{p}' END" for p in ("pm25", "pm10"))
    return f"intents AS (SELECT question_id, {', '.join(flags)}, concat_ws(',', {names}) AS parameters FROM q)"


SQL["question_intents"] = _with("loc", f", {_QUESTIONS}, {_intents()} SELECT * FROM intents")
SQL["question_locations"] = _with(
    "loc",
    f", {_QUESTIONS} SELECT question_id, p.location_id AS location_id, p.location_name AS location_name FROM named",
)
SQL["question_plan"] = _with(
    "loc",
    f""", {_QUESTIONS}, {_intents()}, w AS (SELECT i.*, n.p.location_id AS place_id,
        (needs_trends = 1 OR needs_weather = 1) AS series_intent FROM intents i
        LEFT JOIN named n ON n.question_id = i.question_id),
    x AS (SELECT *, series_intent AND parameters <> '' AND place_id IS NOT NULL AS s FROM w)
    SELECT question_id, needs_health AS uses_data_health, needs_summary * (1 - needs_health) AS uses_summary,
    ((needs_locations = 1 AND needs_comparison = 0) OR series_intent)::INT AS uses_catalogue,
    CASE WHEN needs_comparison = 1 THEN CASE WHEN parameters <> '' THEN parameters ELSE 'pm25,pm10' END ELSE '' END
        AS compared_parameters,
    CASE WHEN s THEN CASE WHEN needs_weather = 1 THEN 'weather' ELSE 'trends' END END AS series_kind,
    CASE WHEN s THEN place_id END AS series_location_id, CASE WHEN s THEN parameters ELSE '' END AS series_parameters
    FROM x""",
)
SQL["conversation_bounds"] = r"""WITH m AS (SELECT conv_id, turn, role, length(text) AS raw,
        length(trim(text, E' \t\n\r')) AS net, turn = max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
    g AS (SELECT conv_id, count(*) - 1 AS history_messages,
        coalesce(sum(net) FILTER (WHERE NOT last), 0)::BIGINT AS history_characters,
        max(raw) FILTER (WHERE last) AS q_raw, max(net) FILTER (WHERE last) AS q_net,
        count(*) FILTER (WHERE NOT last AND raw > 600) AS too_long,
        count(*) FILTER (WHERE NOT last AND net = 0) AS blank,
        count(*) FILTER (WHERE NOT last AND role NOT IN ('user', 'assistant')) AS bad_role FROM m GROUP BY conv_id)
    SELECT conv_id, history_messages, history_characters, concat_ws(',',
        CASE WHEN q_net = 0 THEN 'question_blank' END, CASE WHEN q_raw > 1200 THEN 'question_too_long' END,
        CASE WHEN history_messages > 6 THEN 'too_many_messages' END, CASE WHEN blank > 0 THEN 'message_blank' END,
        CASE WHEN too_long > 0 THEN 'message_too_long' END, CASE WHEN bad_role > 0 THEN 'unknown_role' END,
        CASE WHEN history_characters > 3000 THEN 'history_too_long' END) AS violations FROM g"""

_STAGES = (
    "['validate_run_config','acquire_air_quality','process_air_quality','build_curated_air_quality',"
    "'enrich_air_quality_weather','load_postgres_warehouse','build_dbt_analytics']"
)
_AUDIT_EVENTS = f""", e AS (SELECT 'run-' || user_id AS run_id, event_id AS seq, ts AS happened, k, location_id,
        CASE event_type WHEN 'signup' THEN 'start' WHEN 'view' THEN 'stage' WHEN 'click' THEN 'count'
            WHEN 'purchase' THEN 'succeed' ELSE 'fail' END AS kind, {_STAGES}[k % 7 + 1] AS any_stage FROM ev)"""
# Whole-run windows: the state before an event is the last stage and what ended it.
_AUDIT = (
    _AUDIT_EVENTS
    + """, a AS (SELECT *, min(seq) FILTER (WHERE kind = 'start') OVER (PARTITION BY run_id) AS born FROM e),
    b AS (SELECT *, CASE WHEN kind = 'stage' THEN any_stage WHEN kind = 'fail' AND k % 3 = 0 THEN any_stage END AS stage,
        coalesce(max(seq) FILTER (WHERE kind = 'stage' AND seq > born)
            OVER (PARTITION BY run_id ORDER BY seq), -1) AS segment FROM a WHERE born IS NOT NULL AND seq >= born),
    c AS (SELECT *, min(seq) FILTER (WHERE kind IN ('succeed', 'fail')) OVER (PARTITION BY run_id, segment) AS end_seq,
        max(segment) OVER (PARTITION BY run_id) AS last_segment FROM b),
    d AS (SELECT *, max(kind) FILTER (WHERE seq = end_seq) OVER (PARTITION BY run_id, segment) AS end_kind FROM c),
    x AS (SELECT *, kind = 'count' AND (end_seq IS NULL OR seq < end_seq) AS counts,
        kind = 'stage' AND stage <> 'build_dbt_analytics' AS forgets,
        (kind = 'count' AND end_seq < seq) OR (kind IN ('succeed', 'fail') AND kind <> end_kind) AS refused FROM d),
    runs AS (SELECT 'daily' AS dag_id, run_id,
        max(CASE WHEN k % 2 = 0 THEN 'historical' ELSE 'incremental' END) FILTER (WHERE seq = born) AS run_mode,
        max(CASE WHEN k % 2 = 0 THEN '2024-01-01 00:00:00.000000' ELSE '2024-01-01 04:00:00.000000' END)
            FILTER (WHERE seq = born) AS requested_start,
        max(CASE WHEN k % 2 = 0 THEN '2024-01-02 00:00:00.000000' ELSE '2024-01-01 06:00:00.000000' END)
            FILTER (WHERE seq = born) AS requested_end,
        max(CASE WHEN k % 5 = 0 THEN location_id END) FILTER (WHERE seq = born) AS location_id,
        coalesce(max(CASE end_kind WHEN 'succeed' THEN 'succeeded' WHEN 'fail' THEN 'failed' END)
            FILTER (WHERE segment = last_segment), 'running') AS status,
        coalesce(max(stage) FILTER (WHERE seq = last_segment), 'validate_run_config') AS current_stage,
        arg_max({'s': stage}, seq) FILTER (WHERE segment = last_segment AND kind = 'fail') AS last_fail,
        max(happened) FILTER (WHERE seq = born) AS started, max(happened) FILTER (WHERE segment = last_segment AND seq = end_seq) AS finished,
        arg_max({'n': CASE WHEN kind = 'count' THEN k END}, seq) FILTER (WHERE counts OR forgets) AS loaded,
        count(*) FILTER (WHERE refused) AS refused FROM x GROUP BY run_id),
    early AS (SELECT run_id, count(*) AS n FROM a WHERE seq < born AND kind <> 'start' GROUP BY run_id) """
)
_RUN_COLUMNS = f"""runs.run_id, run_mode, requested_start, requested_end, location_id, status, current_stage,
    CASE WHEN status = 'failed' THEN coalesce(last_fail.s, current_stage) END AS failed_stage,
    strftime(started, {TS}) AS started_at, strftime(finished, {TS}) AS finished_at, loaded.n::BIGINT AS observations_loaded"""
SQL["run_audit_fold"] = _with(
    "ev",
    _AUDIT
    + f"""SELECT dag_id, {_RUN_COLUMNS},
    CASE WHEN status = 'failed' THEN 'Pipeline failed; inspect Airflow task and callback logs.' END AS error_summary,
    refused + coalesce(early.n, 0) AS refused_events FROM runs LEFT JOIN early ON early.run_id = runs.run_id""",
)
SQL["latest_run"] = _with(
    "ev", _AUDIT + f"SELECT {_RUN_COLUMNS} FROM runs ORDER BY started DESC, runs.run_id DESC LIMIT 1"
)
SQL["run_audit_errors"] = _with(
    "ev",
    _AUDIT_EVENTS
    + """SELECT kind, CASE WHEN kind IN ('stage', 'fail') AND seq % 13 = 0 THEN 'unknown stage'
        WHEN kind = 'count' AND seq % 11 = 0 THEN 'bad count' ELSE 'valid' END AS outcome, count(*) AS events
    FROM e GROUP BY ALL""",
)
# The stream must end where a full rebuild ends.
SQL["stream_incremental"] = _with(
    "rec",
    f"""SELECT {GRAIN}, observation_count, average_value, minimum_value, maximum_value FROM (
    SELECT measurement_date_utc, location_id, parameter, unit, count(*) AS observation_count,
        round(avg(value), 9) AS average_value, min(value) AS minimum_value, max(value) AS maximum_value
    FROM rec WHERE batch = 0 AND reason IS NULL GROUP BY ALL)""",
)


def _build_report() -> str:
    """What a build over the accepted records leaves; column orders are those of the model."""
    nanos = ["datetime_from_ns", "datetime_to_ns"]
    observed = [*OBSERVATION_COLUMNS, *nanos]
    # Partition columns come back last.
    joined = [name for name in observed if name != "parameter"] + ["parameter", "measurement_date_utc", *WEATHER_COLUMNS]
    canonical = ["canonical_location_name", "canonical_latitude", "canonical_longitude", "has_weather_context"]
    weather = ["weather_context_count", "weather_context_percentage"]
    statistics = ["location_name", "observation_count", "average_value", "minimum_value", "maximum_value", *weather]
    grain = ["location_id", "parameter", "unit"]
    columns = {
        "curated": [*observed, "measurement_date_utc"],
        "enriched": joined,
        "agg_daily_air_quality": ["measurement_date_utc", *grain, *statistics],
        "agg_location_air_quality": [*grain, *statistics, "earliest_observation_utc", "latest_observation_utc"],
        "agg_pollution_weather": [
            "measurement_date_utc", *grain, "location_name", "observation_count", "average_pollution_value",
            "average_temperature_2m_c", "average_relative_humidity_2m_pct", "average_precipitation_mm",
            "average_wind_speed_10m_kmh", "temperature_observation_count", "humidity_observation_count",
            "precipitation_observation_count", "wind_observation_count",
        ],
        "fct_air_quality_observations": [n for n in WAREHOUSE_COLUMNS if n != "measurement_date_utc"] + canonical + ["measurement_date_utc"],
    }
    fixed = [("columns", name, ",".join(names)) for name, names in columns.items()]
    fixed += [
        ("manifest", "curated partition_columns", "parameter,measurement_date_utc"),
        ("manifest", "enriched partition_columns", "parameter,measurement_date_utc"),
        ("manifest", "enriched weather_variables", "temperature_2m,relative_humidity_2m,precipitation,wind_speed_10m"),
        ("manifest", "curated schema_version", "1"),
        ("manifest", "enriched schema_version", "1"),
        ("order", "observations", "0"),
        ("export", "differing rows", "0"),
        ("second run", "weather", "refused"),
        ("second run", "snapshots kept", "True"),
    ]
    values = ", ".join(f"('{part}', '{item}', '{value}')" for part, item, value in fixed)
    grain_of = "measurement_date_utc, location_id, parameter, unit"
    counts = [
        ("manifest", "processed rows", "count(*)::VARCHAR"),
        ("manifest", "curated row_count", "count(*)::VARCHAR"),
        ("manifest", "enriched air_quality_rows", "count(*)::VARCHAR"),
        ("manifest", "enriched weather_matched_rows", "count(*) FILTER (WHERE matched)::VARCHAR"),
        ("rows", "fct_air_quality_observations", "count(*) || ' ' || count(*)"),
        ("rows", "agg_daily_air_quality", f"count(DISTINCT ({grain_of})) || ' ' || count(*)"),
        ("rows", "agg_location_air_quality", "count(DISTINCT (location_id, parameter, unit)) || ' ' || count(*)"),
        (
            "rows",
            "agg_pollution_weather",
            f"count(DISTINCT ({grain_of})) FILTER (WHERE matched) || ' ' || count(*) FILTER (WHERE matched)",
        ),
    ]
    counted = " UNION ALL ".join(f"SELECT '{part}', '{item}', {value} FROM built" for part, item, value in counts)
    report = SQL["quality_report"]
    ctes, _, lines = report.partition("SELECT 'raw_files_discovered'")
    avail = ", ".join(f"{name} AS ({PARTS[name]})" for name in ("wx", "avail"))
    return f"""{ctes.rstrip()}, {avail},
    built AS (SELECT k.*, a.location_id IS NOT NULL AS matched FROM kept k LEFT JOIN avail a
        ON a.location_id = k.location_id AND a.weather_hour_utc = date_trunc('hour', k.datetime_to_utc)),
    lines AS (SELECT 'raw_files_discovered'{lines})
    SELECT 'report' AS part, trim(metric || ' ' || item) AS item, n::VARCHAR AS value FROM lines
    UNION ALL {counted}
    UNION ALL SELECT * FROM (VALUES {values}) f"""


SQL["build_report"] = _build_report()
