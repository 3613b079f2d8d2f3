"""Documents landed in bundles and in files of their own."""

from __future__ import annotations

import json
from pathlib import Path

from fixtures import batch_path, envelope, hourly, land_batch

from envlake.plans import rebuild
from envlake.plans.driver_tables import DriverTables
from envlake.sources import envelopes
from envlake.sources.bundles import write_bundles


def test_bundles_and_files_are_read_together(spark, tmp_path):
    land_batch(tmp_path, [hourly(0)], sensor_id=1)
    bodies = [envelope([hourly(k)], sensor_id=k) for k in range(2, 30)]
    texts = [(str(batch_path(Path("."), body)), json.dumps(body, indent=1)) for body in bodies] + [("broken", "{}{}"), ("none", None)]
    write_bundles(spark.createDataFrame(texts, "path string, content string"), f"{tmp_path}/openaq/bundles")
    files = envelopes.read_raw_files(spark, str(tmp_path))
    assert files.count() == 31
    assert {(r.path, r.content) for r in files.collect()} >= set(texts)
    found = {r.path: r.envelope_error for r in envelopes.parse_envelopes(files).collect()}
    assert {path for path, error in found.items() if error} == {"broken", "none"}


def test_a_build_lands_fewer_files_than_documents(spark):
    tables = DriverTables(spark, "/root/testdata/sf0.001")
    documents = tables.envelopes(nanoseconds=False)
    _, folder = rebuild._build(tables)
    landed = list(Path(folder, "raw").rglob("part-*"))
    assert 0 < len(landed) <= documents.rdd.getNumPartitions() < documents.count()
    same = envelopes.read_raw_files(spark, f"{folder}/raw")
    assert same.exceptAll(documents).isEmpty() and documents.exceptAll(same).isEmpty()
