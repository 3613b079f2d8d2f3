from __future__ import annotations

import json

import pytest
from fixtures import (
    hourly,
    measurement,
    weather_envelope,
    weather_response,
    land_batch,
    write_config,
    write_weather,
)

from envlake.errors import ConflictError, InputError
from envlake.functions import rules
from envlake.operators import serving
from envlake.plans.pipeline import Pipeline, failed_tests
from envlake.sources import weather


@pytest.fixture()
def inputs(tmp_path):
    """Six observations of two locations; five of them have a weather hour."""
    raw = tmp_path / "raw"
    land_batch(raw, [hourly(0, value=12.4), hourly(1, value=13.0)], location_id=101, sensor_id=1)
    land_batch(raw, [hourly(2, value=7.0)], location_id=101, sensor_id=1, start="2025-04-11")
    pm10 = {"parameter__name": "pm10", "parameter__id": 1}
    land_batch(raw, [hourly(0, value=-1.0, **pm10)], location_id=101, sensor_id=2, parameter="pm10")
    land_batch(raw, [hourly(0, **pm10)], location_id=102, sensor_id=3, parameter="pm10")
    late = measurement(
        period__datetimeFrom__utc="2025-04-10T22:37:00Z", period__datetimeTo__utc="2025-04-10T23:37:00Z"
    )
    land_batch(raw, [late], location_id=102, sensor_id=4)
    write_weather(tmp_path / "weather", 101, weather_response())
    # Location 102: hour 23 is missing, hour 1 has only a temperature.
    partial = weather_response(range(3))
    partial["hourly"]["wind_speed_10m"] = [None, None, None]
    partial["hourly"]["precipitation"] = [None, None, None]
    partial["hourly"]["relative_humidity_2m"] = [None, None, None]
    partial["hourly"]["temperature_2m"] = [None, 5.0, None]
    write_weather(tmp_path / "weather", 102, partial)
    return tmp_path


@pytest.fixture()
def built(spark, inputs):
    pipeline = Pipeline(spark, str(inputs / "lake"), write_config(inputs / "config.json"))
    pipeline.run(str(inputs / "raw"), str(inputs / "weather"))
    return pipeline


def test_golden_build(spark, built, inputs):
    assert built.observations().count() == 6
    assert built.locations().count() == 2
    assert built.mart("fct_air_quality_observations").count() == 6
    assert built.mart("agg_daily_air_quality").count() == 4
    assert built.mart("agg_location_air_quality").count() == 4
    assert built.mart("agg_pollution_weather").count() == 3
    assert failed_tests(built.relations()) == []
    manifest = json.loads(built.store.manifest("enriched"))
    assert (manifest["weather_matched_rows"], manifest["weather_unmatched_rows"]) == (5, 1)
    assert manifest["weather_rows_available"] == 25
    partial = built.enriched().filter("location_id = 102 AND sensor_id = 3").first()
    assert (partial.temperature_2m_c, partial.wind_speed_10m_kmh) == (5.0, None)
    unmatched = built.enriched().filter("sensor_id = 4").first()
    assert unmatched.weather_source is None and str(unmatched.weather_hour_utc) == "2025-04-10 23:00:00"
    sites = {r.location_id: (r.latitude, r.longitude) for r in built.locations().collect()}
    assert sites == {101: (-26.0, 28.0), 102: (-33.0, 18.0)}
    # The same input again gives the same content under a new version.
    before, rows = built.store.current_version("marts"), built.observations().collect()
    built.run(str(inputs / "raw"), str(inputs / "weather"))
    assert built.store.current_version("marts") != before
    assert sorted(map(str, built.observations().collect())) == sorted(map(str, rows))
    built.create_views()
    averages = spark.sql(
        "SELECT average_value FROM agg_location_air_quality WHERE location_id = 101 AND parameter = 'pm25'"
    ).first()
    assert averages[0] == pytest.approx((12.4 + 13.0 + 7.0) / 3)
    detail = serving.location_detail(built.mart("fct_air_quality_observations"), built.locations(), 101)
    assert detail["latest"].count() == 2 and detail["recent"].count() == 4
    assert serving.location_header(built.locations(), 999).isEmpty()


def test_failures_keep_the_snapshot(spark, built, inputs):
    version = built.store.current_version("processed")
    land_batch(inputs / "raw", [hourly(0, value=99.0)], location_id=101, sensor_id=1, start="2025-04-11", end="2025-04-14")
    with pytest.raises(ConflictError):
        built.process(str(inputs / "raw"))
    assert built.store.current_version("processed") == version
    write_weather(inputs / "weather", 101, weather_response(hourly_units__precipitation="inch"))
    enriched = built.store.current_version("enriched")
    with pytest.raises(InputError, match="wrong_units"):
        built.enrich(str(inputs / "weather"))
    assert built.store.current_version("enriched") == enriched


def test_unconfigured_location_is_refused(spark, inputs):
    pipeline = Pipeline(spark, str(inputs / "lake"), write_config(inputs / "one.json", ids=(101,)))
    pipeline.process(str(inputs / "raw"))
    pipeline.curate()
    with pytest.raises(InputError, match="102: no confirmed coordinates"):
        pipeline.enrich(str(inputs / "weather"))


WEATHER_FAULTS = [
    ({"error": True}, "provider_error"),
    ({"utc_offset_seconds": 7200}, "not_utc"),
    ({"timezone": "Africa/Johannesburg"}, "not_utc"),
    ({"hourly__precipitation": None}, "missing_array"),
    ({"hourly__precipitation": [0.0]}, "unequal_arrays"),
    ({"hourly_units__temperature_2m": "F"}, "wrong_units"),
    ({"hourly_units__time": "unixtime"}, "wrong_units"),
    ({"hourly__time": ["2025-04-10T00:30", "2025-04-10T01:00"]}, "bad_hour"),
    ({"hourly__time": ["2025-04-11T00:00", "2025-04-10T01:00"]}, "bad_hour"),
    ({"hourly__time": ["2025-04-10T01:00", "2025-04-10T01:00Z"]}, "duplicate_hour"),
    ({"hourly__temperature_2m": ["warm", 1]}, "bad_temperature"),
    ({"hourly__temperature_2m": [True, 1]}, "bad_temperature"),
    ({"hourly__relative_humidity_2m": [101, 1]}, "bad_humidity"),
    ({"hourly__precipitation": [-1, 1]}, "bad_precipitation"),
    ({"hourly__wind_speed_10m": [-0.1, 1]}, "bad_wind"),
    ({"latitude": 91}, "bad_position"),
    ({"hourly__temperature_2m": [None, -40.5]}, None),
    ({"latitude": None}, None),
]


def test_weather_contract(spark):
    files = spark.createDataFrame(
        [
            (str(i), json.dumps(weather_envelope(1, weather_response(range(2), **change))))
            for i, (change, _) in enumerate(WEATHER_FAULTS)
        ],
        "path string, content string",
    )
    parsed = weather.parse_weather(files)
    judged = parsed.select("path", rules.first_violation(weather.weather_rules()).alias("v"))
    assert {int(r.path): r.v for r in judged.collect()} == {i: v for i, (_, v) in enumerate(WEATHER_FAULTS)}
