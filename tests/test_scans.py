"""Scans by name with typed cells, and the order of the text export."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from envlake.domain import REQUIRED_COLUMNS, WEATHER_COLUMNS, column_type
from envlake.errors import InputError
from envlake.sinks import exports
from envlake.sources import tables

NAMES = (*REQUIRED_COLUMNS, *WEATHER_COLUMNS, "measurement_date_utc")


def row(spark, **cells):
    """One row of null model columns but for the given ones."""
    return spark.range(1).select(
        *(F.expr(cells[name]).alias(name) if name in cells else F.lit(None).cast(column_type(name)).alias(name) for name in NAMES)
    )


# stored value, whether it is one of the model type
CELLS = [
    ("location_id", "CAST(7 AS int)", True),
    ("location_id", "CAST(7 AS decimal(20,0))", True),
    ("location_id", "CAST(1e19 AS decimal(20,0))", False),
    ("location_id", "'7'", False),
    ("location_id", "7.0D", False),
    ("value", "CAST(1.5 AS float)", True),
    ("value", "3", True),
    ("value", "true", False),
    ("value", "'3'", False),
    ("unit", "5", False),
    ("datetime_to_utc", "'2025-01-01T00:00:00Z'", False),
    ("datetime_to_utc", "TIMESTAMP_NTZ'2025-01-01 00:00:00'", False),
    ("weather_hour_utc", "TIMESTAMP'2025-01-01 00:00:00'", True),
    ("measurement_date_utc", "'2025-04-10'", True),
    ("measurement_date_utc", "'2025-4-10'", False),
    ("measurement_date_utc", "'2025'", False),
    ("measurement_date_utc", "20250410", False),
]


@pytest.mark.parametrize(("name", "cell", "ok"), CELLS)
def test_cells(spark, name, cell, ok):
    found = tables.typed_cells(row(spark, **{name: cell})).first()
    assert found.cast_error == (None if ok else name)
    assert (found[name] is not None) == ok


def test_first_column_wins_and_refusal(spark):
    rows = tables.typed_cells(row(spark, value="'x'", unit="5", weather_source="1"))
    assert rows.first().cast_error == "unit"
    with pytest.raises(InputError, match="enriched: 1 values of another type, first in column unit"):
        tables.require_typed(rows, "enriched")
    assert "cast_error" not in tables.require_typed(tables.typed_cells(row(spark)), "enriched").columns


def test_absent_columns_and_partition_text(spark, tmp_path):
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    full = row(spark, parameter="'007'", unit="'a'", measurement_date_utc="DATE'2025-04-10'").withColumn("period_label", F.lit("hour"))
    for rows in (full, full.drop("period_label")):
        rows.write.mode("append").partitionBy("parameter", "measurement_date_utc").parquet(str(tmp_path / "a"))
    found = tables.read_enriched(spark, str(tmp_path / "a")).collect()
    assert sorted(str(r.period_label) for r in found) == ["None", "hour"]
    assert {(r.parameter, str(r.measurement_date_utc), r.parameter_id, r.cast_error) for r in found} == {("007", "2025-04-10", None, None)}
    assert spark.conf.get(inference) == before
    full.drop("unit", "weather_hour_utc").write.parquet(str(tmp_path / "b"))
    with pytest.raises(InputError, match="missing required columns: unit, weather_hour_utc"):
        tables.read_enriched(spark, str(tmp_path / "b"))
    with pytest.raises(InputError, match="missing required columns: unit"):
        tables.read_observations(spark, str(tmp_path / "b"))
    full.limit(0).write.parquet(str(tmp_path / "c"))
    assert tables.read_enriched(spark, str(tmp_path / "c")).count() == 0


def test_out_of_order_is_found_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(exports, "RANGE_ROWS", 3)
    times = [1, 2, 3, 3, 5, 6, 4, 7, 8, 7]
    rows = spark.createDataFrame(
        [(place, f"2025-01-0{t}", "2025-02-01", "10", "9", "pm25") for place, t in enumerate(times)],
        "place bigint, datetime_from_utc string, datetime_to_utc string, location_id string, sensor_id string, parameter string",
    )
    assert sorted(r.place for r in exports.out_of_order(rows).collect()) == [6, 9]
