from __future__ import annotations

import json

import pytest
from fixtures import batch_path, envelope, hourly, measurement, land_batch

from envlake.errors import ConflictError, InputError
from envlake.operators import dedup
from envlake.operators.normalize import normalize
from envlake.sources import envelopes

BIG = 2**63


def collapsed(spark, root):
    files = envelopes.read_raw_files(spark, str(root))
    return dedup.collapse(normalize(envelopes.split_records(envelopes.parse_envelopes(files))))


def collapse_bodies(spark, bodies):
    files = spark.createDataFrame(
        [(str(batch_path("", b)).lstrip("/"), json.dumps(b)) for b in bodies], "path string, content string"
    )
    return dedup.collapse(normalize(envelopes.split_records(envelopes.parse_envelopes(files))))


# (change, batch parameter, expected reason) per case
CASES = [
    ({"parameter__name": "no2"}, "invalid_parameter"),
    ({"parameter__name": "pm10"}, "parameter_mismatch"),
    ({"parameter__units": None}, "missing_unit"),
    ({"parameter__units": " "}, "missing_unit"),
    ({"parameter__units": 5}, "missing_unit"),
    ({"parameter__id": False}, "invalid_identifier"),
    ({"parameter__id": 1.0}, "invalid_identifier"),
    ({"parameter__id": BIG}, "invalid_identifier"),
    ({"value": None}, "invalid_value"),
    ({"value": "12.3"}, "invalid_value"),
    ({"value": True}, "invalid_value"),
    ({"value": float("nan")}, "invalid_value"),
    ({"value": float("inf")}, "invalid_value"),
    ({"period__datetimeFrom__utc": "bad"}, "invalid_timestamp"),
    ({"period__datetimeFrom__utc": "2025-04-10T00:00:00"}, "invalid_timestamp"),
    ({"period__datetimeFrom": "x"}, "invalid_timestamp"),
    ({"period__datetimeTo__local": 3}, "invalid_timestamp"),
    ({"period__datetimeTo__utc": "2025-04-10T00:00:00Z"}, "invalid_period"),
    ({"period__datetimeTo__utc": "2025-04-09T00:00:00Z"}, "invalid_period"),
    ({"period": None}, "missing_required_field"),
    ({"parameter": "pm25"}, "missing_required_field"),
    ({"coordinates": "here"}, "missing_required_field"),
    ({"coordinates": {"latitude": "x"}}, "invalid_value"),
    ({"period__label": 1}, "missing_required_field"),
    ({"value": -0.5}, None),
    ({"parameter__name": " PM25 "}, None),
    ({"coordinates": {"latitude": -26.2, "longitude": 28.0}}, None),
    ({"parameter__id": None}, None),
]


def test_reasons(spark):
    """Every case sits in its own envelope, so that the path tells it apart."""
    bodies = [envelope([measurement(**change)], sensor_id=i + 1) for i, (change, _) in enumerate(CASES)]
    files = spark.createDataFrame(
        [(str(i), json.dumps(body)) for i, body in enumerate(bodies)], "path string, content string"
    )
    rows = normalize(envelopes.split_records(envelopes.parse_envelopes(files)))
    found = {int(r.source_file): r.reject_reason for r in rows.select("source_file", "reject_reason").collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_records_that_are_no_objects(spark):
    body = envelope([3, "t", [1], None, measurement()])
    report = dedup.quality_report(collapse_bodies(spark, [body])).first()
    assert report.rejection_counts_by_reason == {"missing_required_field": 4}
    assert report.final_processed_row_count == 1


def test_batch_identifiers(spark):
    bodies = []
    for identifier in (0, -1, True, "101", None, 1.0):
        bodies.append(envelope([measurement()]))
        bodies[-1]["retrieval"]["location_id"] = identifier
    files = spark.createDataFrame([("p", json.dumps(b)) for b in bodies], "path string, content string")
    rows = normalize(envelopes.split_records(envelopes.parse_envelopes(files)))
    assert [r.reject_reason for r in rows.collect()] == ["invalid_identifier"] * len(bodies)


def test_report_and_first_copy(spark, tmp_path):
    first = land_batch(tmp_path, [measurement(value=-0.5), measurement(value=None), measurement(value=-0.5)])
    land_batch(tmp_path, [measurement(value=-0.5)], start="2025-04-11")
    land_batch(tmp_path, [], sensor_id=9)
    rows = collapsed(spark, tmp_path)
    dedup.require_publishable(rows)
    assert dedup.quality_report(rows).first().asDict() == {
        "raw_files_discovered": 3,
        "raw_measurement_records_read": 4,
        "valid_observations_before_deduplication": 3,
        "invalid_observations_rejected": 1,
        "rejection_counts_by_reason": {"invalid_value": 1},
        "identical_duplicates_removed": 2,
        "final_processed_row_count": 1,
        "negative_measurement_count": 1,
        "counts_by_parameter": {"pm25": 1, "pm10": 0},
        "observed_units_by_parameter": {"pm25": ["ug/m3"], "pm10": []},
    }
    kept = dedup.processed_rows(rows).first()
    assert kept.source_file == first.relative_to(tmp_path).as_posix()
    assert (kept.location_id, kept.sensor_id, kept.parameter_id, kept.value) == (101, 1, 2, -0.5)
    assert kept.datetime_from_local == "2025-04-10T01:00:00+01:00"
    assert (kept.retrieval_datetime_from, kept.retrieval_datetime_to) == ("2025-04-10", "2025-04-12")


SAME = [
    {"value": 8.250},
    {"parameter__name": " PM25"},
    {"period__datetimeFrom__utc": "2025-04-10T02:00:00+02:00"},
    {"period__datetimeTo__utc": "2025-04-10T01:00:00.000000000Z"},
]
DIFFERENT = [
    {"value": 99},
    {"parameter__units": "mg/m3"},
    {"parameter__id": 99},
    {"parameter__displayName": "other"},
    {"flagInfo": {"hasFlags": True}},
    {"extra": 1},
]


def pairs(changes):
    """Per change, an original and a changed copy under one sensor."""
    for sensor, change in enumerate(changes, 1):
        yield envelope([measurement()], sensor_id=sensor)
        yield envelope([measurement(**change)], sensor_id=sensor, start="2025-04-11")


def test_equal_spellings_collapse(spark):
    rows = collapse_bodies(spark, list(pairs(SAME)))
    assert dedup.conflicts(rows).count() == 0
    assert dedup.processed_rows(rows).count() == len(SAME)


def test_whole_numbers_compare_by_value(spark):
    values = [1, 1.0, 1e0]
    bodies = [envelope([measurement(value=v)], start=f"2025-04-0{i + 1}", end="2025-04-19") for i, v in enumerate(values)]
    raw = [json.dumps(b).replace('"value": 1.0', f'"value": {t}') for b, t in zip(bodies, ["1", "1.0", "1e0"], strict=True)]
    files = spark.createDataFrame([(str(i), c) for i, c in enumerate(raw)], "path string, content string")
    rows = dedup.collapse(normalize(envelopes.split_records(envelopes.parse_envelopes(files))))
    assert dedup.conflicts(rows).count() == 0


def test_changed_content_conflicts(spark):
    rows = collapse_bodies(spark, list(pairs(DIFFERENT)))
    assert dedup.conflicts(rows).count() == len(DIFFERENT)
    with pytest.raises(ConflictError, match="location=101, sensor=1"):
        dedup.require_publishable(rows)


def test_nanoseconds_are_identity(spark):
    records = [
        measurement(period__datetimeTo__utc="2025-04-10T01:00:00.000000001Z"),
        measurement(period__datetimeTo__utc="2025-04-10T01:00:00.000000002Z"),
    ]
    rows = dedup.processed_rows(collapse_bodies(spark, [envelope(records)])).orderBy("datetime_to_ns")
    assert [r.datetime_to_ns for r in rows.collect()] == [1, 2]


BROKEN = {
    "{broken": "unreadable or invalid JSON",
    "[]": "unreadable or invalid JSON",
    "{}": "invalid raw envelope/provenance",
}


@pytest.mark.parametrize("content", BROKEN)
def test_broken_file_is_named(spark, tmp_path, content):
    land_batch(tmp_path, [measurement()])
    path = land_batch(tmp_path, [measurement()], sensor_id=2)
    path.write_text(content)
    with pytest.raises(InputError, match=path.name) as error:
        dedup.require_publishable(collapsed(spark, tmp_path))
    assert BROKEN[content] in str(error.value)


BODY_FAULTS = [
    {"schema_version": 1.0},
    {"schema_version": "1"},
    {"source": "other"},
    {"source_meta": []},
    {"source_pages": [1]},
    {"measurements": {}},
    {"retrieval": []},
    {"retrieval": "x"},
]
RETRIEVAL_FAULTS = [
    {"returned": 2},
    {"complete": False},
    {"complete": 1},
    {"parameter": " "},
    {"datetime_from": "2025-04-12"},
    {"datetime_to": "2025-04-12T00:00:00Z"},
    {"datetime_from": "2025-04-10T00:00:00", "datetime_to": "2025-04-11T00:00:00"},
    {"location_name": 5},
]


def test_envelope_contract(spark):
    bodies = [envelope([measurement()])]
    bodies += [envelope([measurement()]) | change for change in BODY_FAULTS]
    bodies += [envelope([measurement()], **change) for change in RETRIEVAL_FAULTS]
    for name in ("location_id", "sensor_id", "datetime_from", "parameter"):
        bodies.append(envelope([measurement()]))
        del bodies[-1]["retrieval"][name]
    files = spark.createDataFrame(
        [(str(i), json.dumps(b)) for i, b in enumerate(bodies)], "path string, content string"
    )
    parsed = envelopes.parse_envelopes(files)
    assert [r.path for r in parsed.filter("envelope_error IS NULL").collect()] == ["0"]
    assert envelopes.first_envelope_error(parsed).first().broken_files == len(bodies) - 1


def test_missing_root(spark, tmp_path):
    with pytest.raises(InputError, match="No measurement batches"):
        envelopes.read_raw_files(spark, str(tmp_path))


def test_csv_round_trip(spark, tmp_path):
    from envlake.operators import curation
    from envlake.sinks.exports import write_processed_csv
    from envlake.sources.tables import read_processed_csv

    records = [
        hourly(0, parameter__id=None),
        hourly(1, value=-1.5),
        hourly(2, period__label="NA"),
        measurement(period__datetimeFrom__utc="2025-04-10T22:00:00.123456789Z", period__datetimeTo__utc="2025-04-11T00:30:00Z"),
    ]
    processed = dedup.processed_rows(collapse_bodies(spark, [envelope(records)]))
    write_processed_csv(processed, str(tmp_path / "csv"))
    text = read_processed_csv(spark, str(tmp_path / "csv"))
    typed = curation.curate_text(text)
    names = [n for n in typed.columns if n != "measurement_date_utc"]
    assert curation.content_difference(processed.select(*names), typed.select(*names)).count() == 0
    assert {r.period_label for r in typed.collect()} == {"hour", "NA"}
    assert {str(r.measurement_date_utc) for r in typed.collect()} == {"2025-04-10", "2025-04-11"}
