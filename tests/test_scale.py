"""What queries leave out of their plans, and how their tables are dealt over tasks."""

from __future__ import annotations

from pathlib import Path

import pytest

from envlake.plans import catalog
from envlake.plans.driver_tables import DriverTables


@pytest.mark.parametrize(("name", "unread"), [("dedup_rows", ("sha2",)), ("quality_report", ("sha2", "period_label", "location_name"))])
def test_collapse_computes_what_is_read(spark, name, unread):
    frame = catalog._PLANS[name](DriverTables(spark, "/root/testdata/sf0.001"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    aggregated = [line for line in plan.splitlines() if "min_by" in line]
    assert aggregated and not any(word in line for word in unread for line in aggregated) and "sha2" not in plan


def test_a_large_partition_of_the_scanned_files_takes_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "workspace", lambda *_: str(tmp_path))
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        rows = catalog.scan_by_name(DriverTables(spark, "/root/testdata/sf0.01"))
        assert rows.select("event_id").distinct().count() == rows.count() == 10_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert len(list(Path(tmp_path, "other", "parameter=pm25").rglob("*.parquet"))) > 1
