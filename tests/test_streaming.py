from __future__ import annotations

import pytest
from fixtures import hourly, land_batch
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from envlake.operators import curation, dedup, models
from envlake.operators.normalize import normalize
from envlake.sources import envelopes
from envlake.streaming.incremental import IncrementalBuild, read_landed_files


def run(build, raw):
    build.start(read_landed_files(build.spark, str(raw))).awaitTermination()


def rebuilt(spark, raw):
    files = envelopes.read_raw_files(spark, str(raw))
    rows = dedup.collapse(normalize(envelopes.split_records(envelopes.parse_envelopes(files))))
    return dedup.processed_rows(rows)


def test_stream_equals_rebuild(spark, tmp_path):
    raw = tmp_path / "raw"
    places = spark.createDataFrame([(101, "A")], "location_id bigint, location_name string")
    build = IncrementalBuild(spark, str(tmp_path / "state"), places)
    land_batch(raw, [hourly(0), hourly(1)], start="2025-04-11")
    run(build, raw)
    # An overlapping batch that comes first in path order takes over provenance.
    land_batch(raw, [hourly(1), hourly(2)], start="2025-04-10")
    run(build, raw)
    full = rebuilt(spark, raw)
    incremental = build.processed().drop("measurement_date_utc").select(*full.columns)
    assert curation.content_difference(full, incremental).isEmpty()
    mart = build.daily_mart().collect()
    assert [(r.location_name, r.observation_count) for r in mart] == [("A", 3)]
    # Nothing new: nothing changes.
    run(build, raw)
    assert build.daily_mart().collect() == mart
    # A changed record fails its micro-batch and leaves the state as it was.
    land_batch(raw, [hourly(2, value=99)], start="2025-04-10", end="2025-04-13")
    with pytest.raises(StreamingQueryException, match="Conflicting observation"):
        run(build, raw)
    assert build.daily_mart().collect() == mart


def test_many_batches_leave_few_runs_and_equal_a_rebuild(spark, tmp_path):
    raw = tmp_path / "raw"
    places = spark.createDataFrame([(101, "A")], "location_id bigint, location_name string")
    build = IncrementalBuild(spark, str(tmp_path / "state"), places, fan_out=2)
    for batch in range(6):
        # Every batch repeats hours of the one before, under a path that comes earlier.
        land_batch(raw, [hourly(h) for h in range(2 * batch, 2 * batch + 4)], start=f"2025-04-{11 - batch:02d}")
        run(build, raw)
        state = build.commits.newest()
        assert all(len(runs) <= 3 for runs in state.values())
        # A late batch adds only its new identities to the partial aggregates.
        assert build.partials.read(state["partials"]).agg({"n": "sum"}).first()[0] == 2 * batch + 4
    full = rebuilt(spark, raw)
    incremental = build.processed().select(*full.columns)
    assert curation.content_difference(full, incremental).isEmpty()
    grain = ["measurement_date_utc", "location_id", "parameter", "unit"]
    whole = models.daily_mart(full.withColumns({"measurement_date_utc": F.to_date("datetime_to_utc"), "weather_source": F.lit(None).cast("string")}), places)
    wanted = {tuple(r[c] for c in grain): r for r in whole.collect()}
    found = {tuple(r[c] for c in grain): r for r in build.daily_mart().collect()}
    assert set(found) == set(wanted)
    for key, row in found.items():
        assert row.observation_count == wanted[key].observation_count and row.average_value == pytest.approx(wanted[key].average_value)
        assert (row.minimum_value, row.maximum_value) == (wanted[key].minimum_value, wanted[key].maximum_value)
    # A batch that runs again after its commit changes nothing.
    staged = envelopes.read_raw_files(spark, str(raw)).filter("path LIKE '%20250406%'")
    build.apply(staged, 5)
    assert build.commits.newest() == state
    assert curation.content_difference(full, build.processed().select(*full.columns)).isEmpty()
