"""The whole build from raw documents to marts, over bundles of documents written from the driver tables."""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, Window, functions as F

from envlake.domain import KEY
from envlake.errors import InputError
from envlake.operators import curation, dedup
from envlake.plans.driver_tables import DriverTables, latitude_of, longitude_of
from envlake.plans.pipeline import MARTS, Pipeline
from envlake.session import workspace
from envlake.sinks.exports import write_processed_csv
from envlake.sources.bundles import write_bundles
from envlake.sources.envelopes import RAW_BUNDLES
from envlake.sources.tables import read_processed_csv
from envlake.sources.weather import WEATHER_BUNDLES

def _build(t: DriverTables) -> tuple[Pipeline, str]:
    """Raw documents, weather documents and configuration below a new folder, and the finished build."""
    folder = workspace(t.spark, "build")
    write_bundles(t.envelopes(nanoseconds=False), f"{folder}/raw/{RAW_BUNDLES}")
    write_bundles(t.weather_files(faults=False), f"{folder}/weather/{WEATHER_BUNDLES}")
    place = F.col("id")
    sites = t.configured.withColumns({"latitude": latitude_of(place), "longitude": longitude_of(place)})
    sites.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("locations")).coalesce(1).write.json(f"{folder}/config")
    pipeline = Pipeline(t.spark, f"{folder}/lake", f"{folder}/config")
    pipeline.run(f"{folder}/raw", f"{folder}/weather")
    return pipeline, folder


def _out_of_order(rows: DataFrame) -> int:
    """Rows of a stored table that stand before their predecessor in the same file."""
    key = F.struct(*KEY)
    in_file = Window.partitionBy("file").orderBy("at")
    placed = rows.select(
        key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    return placed.withColumn("before", F.lag("key").over(in_file)).filter("before > key").count()


def build_report(t: DriverTables) -> DataFrame:
    """(part, item, value) of everything a build leaves: report, manifests, tables, column order, text export.

    A second run over one broken weather response must leave every snapshot as it was.
    """
    spark = t.spark
    pipeline, folder = _build(t)
    store = pipeline.store

    def line(part: str, item: str, value) -> DataFrame:
        texts = [F.lit(str(text)).alias(name) for name, text in (("part", part), ("item", item), ("value", value))]
        return spark.range(1).select(*texts)

    found = []
    report = dedup.report_lines(dedup.quality_report(store.read("processed", "collapsed")))
    found.append(report.select(F.lit("report").alias("part"), F.concat_ws(" ", "metric", F.nullif("item", F.lit(""))).alias("item"), F.col("n").cast("string").alias("value")))
    stored = json.loads(store.manifest("processed"))
    found.append(line("manifest", "processed rows", stored["final_processed_row_count"]))
    for name in ("curated", "enriched"):
        manifest = json.loads(store.manifest(name))
        for item in ("row_count", "air_quality_rows", "weather_matched_rows", "partition_columns", "weather_variables", "schema_version"):
            if item in manifest:
                value = manifest[item]
                found.append(line("manifest", f"{name} {item}", ",".join(value) if isinstance(value, list) else value))
        found.append(line("columns", name, ",".join(manifest["columns"])))
    for name in MARTS:
        rows = pipeline.mart(name)
        total = F.count(F.lit(1)) if name.startswith("fct") else F.sum("observation_count")
        counted = rows.agg(F.count(F.lit(1)).alias("rows"), total.alias("total"))
        found.append(counted.select(F.lit("rows").alias("part"), F.lit(name).alias("item"), F.concat_ws(" ", "rows", "total").alias("value")))
        found.append(line("columns", name, ",".join(rows.columns)))
    found.append(line("order", "observations", _out_of_order(store.read("warehouse", "observations"))))
    write_processed_csv(pipeline.processed(), f"{folder}/export")
    again = curation.curate_text(read_processed_csv(spark, f"{folder}/export", multiline=False))
    # Text holds no nanosecond columns of its own; they come back from the instants.
    differing = curation.content_difference(pipeline.curated().select(*sorted(again.columns)), again.select(*sorted(again.columns)))
    found.append(line("export", "differing rows", differing.count()))
    names = ("processed", "curated", "enriched", "warehouse", "marts")
    before = {name: store.current_version(name) for name in names}
    broken = t.weather_files(faults=False).orderBy("path").limit(1).withColumn("content", F.replace("content", F.lit('"GMT"'), F.lit('"CET"')))
    write_bundles(broken, f"{folder}/weather/{WEATHER_BUNDLES}")
    try:
        pipeline.enrich(f"{folder}/weather")
        outcome = "accepted"
    except InputError:
        outcome = "refused"
    found.append(line("second run", "weather", outcome))
    found.append(line("second run", "snapshots kept", before == {name: store.current_version(name) for name in names}))
    return functools.reduce(DataFrame.unionByName, found)
