"""Registered queries: name, plan over the driver tables, and equivalent SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.domain import KEY, NANO_COLUMNS, OBSERVATION_COLUMNS, PARAMETERS, PARTITIONS
from envlake.errors import InputError
from envlake.functions import instants, rules
from envlake.operators import (
    acquisition,
    curation,
    dedup,
    enrichment,
    expectations,
    geography,
    models,
    routing,
    run_audit,
    serving,
    warehouse,
)
from envlake.operators.normalize import MARKERS, normalize
from envlake.plans import oracle
from envlake.plans.driver_tables import DriverTables, divides
from envlake.plans.present import present
from envlake.session import workspace
from envlake.sinks import exports, registry
from envlake.sources import envelopes, locations as location_sources, tables, weather as weather_sources

Plan = Callable[[DriverTables], DataFrame]
_PLANS: dict[str, Plan] = {}


def query(plan: Plan) -> Plan:
    """Register a plan under its function name."""
    _PLANS[plan.__name__] = plan
    return plan


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query as a callable of (spark, folder)."""

    def bind(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: present(plan(DriverTables(spark, folder)))

    return {name: bind(plan) for name, plan in _PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle.SQL[name] for name in _PLANS if name in oracle.SQL}


# -- models ----------------------------------------------------------------------


@query
def fct_observations(t: DriverTables) -> DataFrame:
    return t.fact


@query
def has_weather_join(t: DriverTables) -> DataFrame:
    rows = t.enriched
    flag = F.col("weather_source").isNotNull()
    return rows.select(*KEY, "weather_hour_utc", flag.cast("int").alias("has_weather"), "temperature_2m_c")


@query
def agg_daily(t: DriverTables) -> DataFrame:
    return t.daily


@query
def agg_location(t: DriverTables) -> DataFrame:
    return t.by_location


@query
def agg_pollution_weather(t: DriverTables) -> DataFrame:
    return t.weather


# -- listings ----------------------------------------------------------------------


@query
def recent_with_location(t: DriverTables) -> DataFrame:
    return serving.recent_with_location(t.warehouse_observations, t.locations)


@query
def avg_by_location(t: DriverTables) -> DataFrame:
    return serving.average_by_location(t.observations)


@query
def avg_with_weather(t: DriverTables) -> DataFrame:
    return serving.average_with_weather(t.warehouse_observations)


@query
def daily_avg(t: DriverTables) -> DataFrame:
    return serving.daily_average(t.observations)


@query
def mart_daily_pm25(t: DriverTables) -> DataFrame:
    return serving.daily_pm25(t.daily)


@query
def mart_location_pm10(t: DriverTables) -> DataFrame:
    return serving.pm10_by_location(t.by_location)


@query
def mart_weather(t: DriverTables) -> DataFrame:
    return serving.weather_listing(t.weather)


@query
def latest_per_group(t: DriverTables) -> DataFrame:
    return serving.latest_listing(t.fact)


# -- serving -----------------------------------------------------------------------


@query
def summary_totals(t: DriverTables) -> DataFrame:
    return serving.summary_totals(t.by_location)


@query
def summary_averages(t: DriverTables) -> DataFrame:
    return serving.summary_averages(t.by_location)


@query
def metric_card(t: DriverTables) -> DataFrame:
    return serving.metric_card(t.by_location, "pm10")


@query
def locations_with_parameters(t: DriverTables) -> DataFrame:
    # Location 99 is a copy without observations, so that one location has no parameters.
    idle = t.locations.filter("location_id = 25").withColumn("location_id", F.lit(99).cast("bigint"))
    return serving.locations_with_parameters(t.locations.unionByName(idle), t.by_location)


@query
def location_header(t: DriverTables) -> DataFrame:
    return serving.location_header(t.locations, 7)


@query
def location_latest(t: DriverTables) -> DataFrame:
    return serving.latest_in_location(t.fact, 7)


@query
def location_recent(t: DriverTables) -> DataFrame:
    return serving.recent_in_location(t.fact, 7)


@query
def location_recent20(t: DriverTables) -> DataFrame:
    return serving.recent_per_location(t.fact)


@query
def latest_matched_in_recent(t: DriverTables) -> DataFrame:
    return serving.latest_matched_in_recent(t.fact)


@query
def series_trends(t: DriverTables) -> DataFrame:
    return serving.series("trends", t.fact, t.daily, "pm25")


@query
def series_weather(t: DriverTables) -> DataFrame:
    return serving.series("weather", t.fact, t.weather, "pm10", location_id=3, date_from="2024-01-05")


@query
def series_bounded(t: DriverTables) -> DataFrame:
    return serving.series(
        "trends", t.fact, t.daily, "pm10", date_from="2024-01-10", date_to="2024-01-12", limit=20
    )


@query
def series_tail(t: DriverTables) -> DataFrame:
    rows = serving.series("trends", t.fact, t.daily, "pm10", location_id=5, limit=routing.SERIES_LIMIT)
    return serving.series_tail(rows).select(
        "measurement_date_utc", "unit", "observation_count", "returned_row_count", "truncated"
    )


@query
def comparison(t: DriverTables) -> DataFrame:
    return serving.comparison(t.by_location, "pm10")


@query
def units_split(t: DriverTables) -> DataFrame:
    rows = serving.series("trends", t.fact, t.daily, "pm10", location_id=5)
    split = serving.split_by_unit(rows)
    return split.select(
        "unit",
        F.size("rows").alias("row_count"),
        F.transform("rows.measurement_date_utc", lambda d: F.date_format(d, "yyyy-MM-dd")).alias("days"),
    )


@query
def map_extent(t: DriverTables) -> DataFrame:
    return geography.map_extent(t.locations)


@query
def display_labels(t: DriverTables) -> DataFrame:
    return t.observations.select(
        "sensor_id",
        F.col("datetime_to_utc").alias("at"),
        instants.display_instant(F.col("datetime_to_utc")).alias("shown"),
        instants.display_bucket(F.col("measurement_date_utc")).alias("bucket"),
        instants.display_short_date(F.col("measurement_date_utc")).alias("short_date"),
        serving.pollutant_label(F.col("parameter")).alias("pollutant"),
        serving.location_label(F.col("location_name"), F.col("location_id")).alias("place"),
        serving.number_label(F.col("value")).alias("number"),
    )


# -- raw to processed -----------------------------------------------------------------


def _normalized(t: DriverTables, conflicts: bool = False, with_signature: bool = True) -> DataFrame:
    parsed = envelopes.parse_envelopes(t.envelopes(conflicts=conflicts))
    return normalize(envelopes.split_records(parsed), with_signature)


@query
def reject_reasons(t: DriverTables) -> DataFrame:
    rows = _normalized(t, with_signature=False).filter("reject_reason IS NOT NULL")
    rows = rows.filter(~F.col("reject_reason").isin(*MARKERS))
    return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query
def normalized_rows(t: DriverTables) -> DataFrame:
    rows = _normalized(t, with_signature=False).filter("reject_reason IS NULL")
    return rows.drop("reject_reason", "envelope_error", "position")


@query
def dedup_rows(t: DriverTables) -> DataFrame:
    return dedup.processed_rows(dedup.collapse(_normalized(t, with_signature=False)))


@query
def conflict_keys(t: DriverTables) -> DataFrame:
    return dedup.conflicts(dedup.collapse(_normalized(t, conflicts=True)))


@query
def quality_report(t: DriverTables) -> DataFrame:
    collapsed = dedup.collapse(_normalized(t, with_signature=False), dedup.REPORTED)
    return dedup.report_lines(dedup.quality_report(collapsed))


@query
def envelope_checks(t: DriverTables) -> DataFrame:
    """Envelopes broken by sensor; spelling a window in basic ISO form (8) breaks none."""
    files = t.envelopes()
    boundary = r'"datetime_(from|to)":"(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})Z"'
    sensor = F.regexp_extract("path", "sensor_id=([0-9]+)/", 1).cast("bigint")
    content = (
        F.when(sensor % 11 == 0, F.replace("content", F.lit('"schema_version":1'), F.lit('"schema_version":"1"')))
        .when(sensor % 11 == 1, F.replace("content", F.lit('"complete":true'), F.lit('"complete":false')))
        .when(sensor % 11 == 2, F.regexp_replace("content", r'"returned":\d+', '"returned":-1'))
        .when(sensor % 11 == 3, F.concat(F.lit("["), F.col("content"), F.lit("]")))
        .when(sensor % 11 == 4, F.regexp_replace("content", r'"datetime_to":"[^"]*"', '"datetime_to":"2020-01-01"'))
        .when(sensor % 11 == 5, F.concat(F.col("content"), F.col("content")))
        .when(sensor % 11 == 6, F.concat(F.col("content"), F.lit(" junk}")))
        .when(sensor % 11 == 7, F.regexp_replace("content", r'"datetime_from":"([^"T]*)T', '"datetime_from":"$1 '))
        .when(sensor % 11 == 8, F.regexp_replace("content", boundary, '"datetime_$1":"$2$3$4T$5$6$7Z"'))
        .when(sensor % 11 == 9, F.concat(F.col("content"), F.lit(","), F.col("content")))
        .otherwise(F.col("content"))
    )
    parsed = envelopes.parse_envelopes(files.select("path", content.alias("content")))
    return parsed.groupBy(F.coalesce("envelope_error", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("files"),
        F.min_by("path", F.split("path", "/")).alias("first_path"),
    )


# -- curation ----------------------------------------------------------------------------


@query
def curation_violations(t: DriverTables) -> DataFrame:
    return curation.text_violations(t.text_rows())


@query
def curated_rows(t: DriverTables) -> DataFrame:
    return curation.clean_text_rows(t.text_rows())


@query
def curated_manifest(t: DriverTables) -> DataFrame:
    return curation.curated_manifest(t.observations)


@query
def readback_diff(t: DriverTables) -> DataFrame:
    """Difference of curated rows, over all columns, and a copy with changed, lost and doubled rows."""
    rows = t.observations_with_event
    columns = [*(name for name in OBSERVATION_COLUMNS if name in rows.columns), "measurement_date_utc"]
    copies = F.when(divides(97), 0).when(divides(89), 2).otherwise(1)
    actual = rows.withColumns(
        {
            "value": F.when(divides(83), F.col("value") + 1).otherwise(F.col("value")),
            "source_file": F.when(divides(79), F.concat("source_file", F.lit("~"))).otherwise(F.col("source_file")),
        }
    ).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return curation.content_difference(rows.select(*columns), actual.select(*columns))


# -- weather -------------------------------------------------------------------------------


def _parsed_weather(t: DriverTables) -> DataFrame:
    return weather_sources.parse_weather(t.weather_files())


@query
def weather_violations(t: DriverTables) -> DataFrame:
    return rules.violation_report(_parsed_weather(t), weather_sources.weather_rules())


@query
def weather_hours(t: DriverTables) -> DataFrame:
    checks = weather_sources.weather_rules()
    clean = _parsed_weather(t).filter(rules.first_violation(checks).isNull())
    return weather_sources.weather_hours(clean)


@query
def available_hours(t: DriverTables) -> DataFrame:
    return enrichment.available_hours(t.hours)


@query
def coordinates_resolved(t: DriverTables) -> DataFrame:
    """Locations divisible by 6 vary within the tolerance, by 7 beyond it."""
    shift = (
        F.when(F.col("location_id") % 6 == 0, (F.col("k") % 2) * F.lit(0.000005))
        .when(F.col("location_id") % 7 == 0, (F.col("k") % 2) * F.lit(0.5))
        .otherwise(0.0)
    )
    rows = t.observations_with_event.withColumn("latitude", F.col("latitude") + shift)
    return geography.resolve_coordinates(rows, t.configured)


@query
def request_plan(t: DriverTables) -> DataFrame:
    return enrichment.request_plan(t.observations, t.configured)


@query
def request_cache(t: DriverTables) -> DataFrame:
    plan = enrichment.request_identity(
        enrichment.request_plan(t.observations, t.configured).filter("coordinate_error IS NULL")
    )
    cached = plan.filter(F.col("location_id") % 2 == 0).select("request_key")
    return enrichment.split_cached(plan, cached).select(
        "location_id", "start_date", "end_date", "request_key", F.col("cache_hit").cast("int").alias("cache_hit")
    )


@query
def enrichment_manifest(t: DriverTables) -> DataFrame:
    return enrichment.enrichment_manifest(t.enriched, t.hours)


# -- warehouse --------------------------------------------------------------------------------


@query
def dim_locations(t: DriverTables) -> DataFrame:
    return warehouse.build_locations(t.enriched, t.configured)


@query
def dimension_conflicts(t: DriverTables) -> DataFrame:
    return warehouse.dimension_conflicts(t.faulty_enriched())


@query
def warehouse_violations(t: DriverTables) -> DataFrame:
    return warehouse.violations(t.faulty_enriched()).select("event_id", "violation")


@query
def scan_by_name(t: DriverTables) -> DataFrame:
    """Enriched files with absent columns and other stored types, read as one table."""
    folder = workspace(t.spark, "scan")
    for name, parts in t.drifted_enriched().items():
        for rows in parts:
            # Only the folder with model types is partitioned by day. Large partitions take several tasks.
            by = PARTITIONS if name == "named" else PARTITIONS[:1]
            rows.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(f"{folder}/{name}")
    rows = tables.read_enriched(t.spark, f"{folder}/named", f"{folder}/other", extra=("event_id",))
    return rows.select(
        "event_id", "cast_error", "location_id", "sensor_id", "parameter", "parameter_id", "unit", "value",
        "period_label", "datetime_to_utc", "measurement_date_utc", "latitude", "weather_hour_utc", "temperature_2m_c",
    )


@query
def export_order(t: DriverTables) -> DataFrame:
    """Rows of the text export in the order of its files."""
    folder = f"{workspace(t.spark, 'export')}/csv"
    nanos = {name: F.lit(0).cast("smallint") for name in NANO_COLUMNS}
    exports.write_processed_csv(t.observations.withColumns(nanos), folder)
    typed = {name: F.col(name).cast("bigint") for name in ("location_id", "sensor_id")} | {"value": F.col("value").cast("double")}
    rows = exports.read_in_order(t.spark, folder).withColumns(typed)
    return rows.select("place", *KEY, "unit", "value", "source_file")


@query
def warehouse_checks(t: DriverTables) -> DataFrame:
    """Load checks over rows with repeats and of unknown locations."""
    rows = t.observations_with_event
    again = rows.filter(divides(97))
    loaded = rows.unionByName(again).withColumns(
        {
            "parameter": F.when(divides(83), "no2").otherwise(F.col("parameter")),
            "location_id": _moved_away(),
        }
    )
    return warehouse.load_checks(loaded, t.locations)


@query
def load_summary(t: DriverTables) -> DataFrame:
    return warehouse.load_summary(t.warehouse_observations, t.locations)


# -- model tests ---------------------------------------------------------------------------------


def _moved_away() -> Column:
    """Every fifth location's rows name a location that the dimension lacks."""
    place = F.col("location_id")
    return F.when(place % 5 == 0, place + 1000).otherwise(place)


def _faulty_relations(t: DriverTables) -> dict[str, DataFrame]:
    """The nine tested relations over observations with planted faults."""
    rows = enrichment.join_weather(t.observations_with_event, t.hours)
    rows = rows.withColumns(
        {
            "location_id": _moved_away(),
            "unit": F.when(~divides(97), F.col("unit")),
            "parameter": F.when(divides(89), "no2").otherwise(F.col("parameter")),
            "source": F.when(~divides(83), F.col("source")),
        }
    )
    observations = models.staged_observations(rows.unionByName(rows.filter(divides(79))))
    sites = t.locations
    fact = models.fact(observations, sites)
    return {
        "locations": sites.unionByName(sites.filter(F.col("location_id") % 8 == 0)),
        "observations": observations,
        "stg_locations": sites,
        "stg_observations": observations,
        "int_air_quality_weather": fact,
        "fct_air_quality_observations": fact,
        "agg_daily_air_quality": models.daily_mart(observations, sites),
        "agg_location_air_quality": models.location_mart(observations, sites),
        "agg_pollution_weather": models.weather_mart(observations, sites),
    }


@query
def qt_generic(t: DriverTables) -> DataFrame:
    return expectations.generic_tests(_faulty_relations(t))


@query
def qt_not_null(t: DriverTables) -> DataFrame:
    rows = _faulty_relations(t)["fct_air_quality_observations"]
    return expectations.not_null(rows, "unit").select(*KEY)


@query
def qt_unique(t: DriverTables) -> DataFrame:
    return expectations.unique(_faulty_relations(t)["locations"], "location_id")


@query
def qt_accepted(t: DriverTables) -> DataFrame:
    rows = _faulty_relations(t)["fct_air_quality_observations"]
    return expectations.accepted_values(rows, "parameter", PARAMETERS)


@query
def qt_relationships(t: DriverTables) -> DataFrame:
    relations = _faulty_relations(t)
    return expectations.relationships(
        relations["stg_observations"], relations["stg_locations"], "location_id"
    )


@query
def qt_natural_key(t: DriverTables) -> DataFrame:
    relations = _faulty_relations(t)
    return expectations.natural_key_repeats(
        {
            "warehouse": relations["observations"],
            "intermediate": relations["int_air_quality_weather"],
            "fact": relations["fct_air_quality_observations"],
        }
    )


@query
def qt_row_counts(t: DriverTables) -> DataFrame:
    relations = _faulty_relations(t)
    fact = relations["fct_air_quality_observations"]
    return expectations.row_count_drift(
        relations["observations"],
        relations["stg_observations"],
        relations["int_air_quality_weather"],
        fact.filter("unit IS NOT NULL"),
    )


@query
def qt_grain(t: DriverTables) -> DataFrame:
    daily = t.daily
    return expectations.grain_repeats(
        daily.unionByName(daily.filter("observation_count % 5 = 0")),
        t.by_location.unionByName(t.by_location.filter("location_id % 4 = 0")),
        t.weather,
    )


@query
def qt_invariants(t: DriverTables) -> DataFrame:
    daily = t.daily.withColumn(
        "maximum_value",
        F.when(F.col("observation_count") % 5 == 0, F.col("minimum_value") - 1).otherwise(
            F.col("maximum_value")
        ),
    )
    by_location = t.by_location.withColumn(
        "weather_context_count",
        F.when(F.col("location_id") % 4 == 0, F.col("observation_count") + 1).otherwise(
            F.col("weather_context_count")
        ),
    )
    return expectations.broken_invariants(daily, by_location)


@query
def qt_weather_matches(t: DriverTables) -> DataFrame:
    mart = t.weather.withColumn(
        "observation_count",
        F.when(F.col("location_id") % 4 == 0, F.col("observation_count") + 1).otherwise(
            F.col("observation_count")
        ),
    )
    # Groups of every fifth location appear under another name: one lacks, one is too many.
    mart = mart.withColumn("location_id", _moved_away())
    return expectations.weather_mart_differences(t.fact, mart)


# -- acquisition -------------------------------------------------------------------------------------


@query
def location_selection(t: DriverTables) -> DataFrame:
    """All locations, the one asked for, and the outcome for one that is unknown."""
    every = acquisition.select_locations(t.configured).withColumn("scope", F.lit("all"))
    one = acquisition.select_locations(t.configured, 7).withColumn("scope", F.lit("one"))
    try:
        unknown = acquisition.select_locations(t.configured, 999).withColumn("scope", F.lit("unknown"))
    except InputError as refused:
        unknown = one.withColumns({"scope": F.lit("unknown"), "id": F.lit(999).cast("bigint"), "name": F.lit(str(refused))})
    return every.unionByName(one).unionByName(unknown)


@query
def sensor_selection(t: DriverTables) -> DataFrame:
    return acquisition.select_sensors(t.sensors())


@query
def missing_parameters(t: DriverTables) -> DataFrame:
    return acquisition.missing_parameters(t.configured, t.sensors())


@query
def completeness(t: DriverTables) -> DataFrame:
    rows = t.responses()
    state = acquisition.incomplete(F.col("found"), F.col("returned"), F.col("pagination_complete"))
    return rows.select(
        "response_id", F.coalesce(state.cast("string"), F.lit("unknown")).alias("incomplete")
    )


@query
def window_bounds(t: DriverTables) -> DataFrame:
    return acquisition.normalize_windows(t.window_requests()).select(
        "request_id", "window_error", "window_from", "window_to", "window_label"
    )


@query
def checkpoint_reasons(t: DriverTables) -> DataFrame:
    return acquisition.unsafe_reasons(*t.checkpoint_runs())


@query
def checkpoint_safety(t: DriverTables) -> DataFrame:
    return acquisition.checkpoint_safety(*t.checkpoint_runs()).withColumn(
        "checkpoint_safe", F.col("checkpoint_safe").cast("int")
    )


@query
def page_audit(t: DriverTables) -> DataFrame:
    return acquisition.audit_pages(t.pages())


@query
def acquisition_summary(t: DriverTables) -> DataFrame:
    return acquisition.acquisition_summary(t.sensor_results())


@query
def catalogue_flatten(t: DriverTables) -> DataFrame:
    rows = location_sources.flatten_catalogue(t.catalogue_pages())
    flags = {name: F.col(name).cast("int") for name in ("is_mobile", "is_monitor")}
    return rows.withColumns(flags)


@query
def catalogue_totals(t: DriverTables) -> DataFrame:
    """Totals that are text, too large, reached, spelled with a zero, or differ between pages."""
    pages = t.catalogue_pages()
    even = F.col("path").cast("int") % 2 == 0
    stated = {
        "text": F.lit('">1000"'),
        "more": F.lit("100000"),
        "reached": F.lit("5"),
        "spelled": F.when(even, '"0999"').otherwise("999"),
        "differing": F.when(even, "999").otherwise("1000"),
    }
    cases = []
    for name, found in stated.items():
        content = F.replace(F.col("content"), F.lit('"found":">1000"'), F.concat(F.lit('"found":'), found))
        totals = location_sources.catalogue_totals(pages.withColumn("content", content))
        cases.append(totals.withColumn("stated", F.lit(name)))
    rows = functools.reduce(DataFrame.unionByName, cases)
    return rows.withColumn("incomplete", F.coalesce(F.col("incomplete").cast("string"), F.lit("unknown")))


@query
def batch_registry(t: DriverTables) -> DataFrame:
    return acquisition.register_batches(*t.registry_input())


@query
def registry_summary(t: DriverTables) -> DataFrame:
    return acquisition.registration_summary(acquisition.register_batches(*t.registry_input()))


@query
def registry_runs(t: DriverTables) -> DataFrame:
    """What two runs leave in a registry, and the totals of each; a run with an unsafe checkpoint leaves nothing."""
    place = f"{workspace(t.spark, 'registry')}/batches"
    totals = [registry.persist_run(t.spark, t.raw_batches(run), place, f"run-{run}", True) for run in (0, 1)]
    try:
        registry.persist_run(t.spark, t.raw_batches(1), place, "unsafe", False)
    except InputError:
        totals.append({"batches_written": 0, "batches_reused": 0, "measurements_represented": 0})
    rows = registry.read_registry(t.spark, place).select("path", "returned", "run_id")
    counted = [F.struct(*(F.lit(value).cast("bigint").alias(name) for name, value in found.items())) for found in totals]
    runs = F.when(F.col("run_id") == "run-0", counted[0]).when(F.col("run_id") == "run-1", counted[1]).otherwise(counted[2])
    return rows.withColumn("t", runs).select("path", "returned", "run_id", "t.*")


@query
def batch_violations(t: DriverTables) -> DataFrame:
    """Contract of batches to be registered, over order rows with faults."""
    key = F.col("o_orderkey")
    rows = t.read("orders").select(
        F.when(key % 31 == 0, -1).otherwise(F.col("o_custkey") + 1).alias("location_id"),
        F.when(key % 29 != 0, key + 1).alias("sensor_id"),
        F.when(key % 23 == 0, "pm 2.5").otherwise("pm25").alias("parameter"),
        F.lit("2024-01-01").alias("datetime_from"),
        F.when(key % 19 == 0, "2024-01-01T00:00:00Z").otherwise("2024-01-02").alias("datetime_to"),
        (F.col("o_custkey") % 10).alias("returned"),
        F.when(key % 17 == 0, 11).otherwise(F.col("o_custkey") % 10).alias("records"),
        F.when(key % 13 == 0, True).when(key % 11 != 0, False).alias("incomplete"),
        F.when(key % 2 == 0, key % 7 != 0).alias("pagination_complete"),
    )
    return rules.violation_report(rows, acquisition.batch_rules())


# -- questions and audit ----------------------------------------------------------------------------------


@query
def question_intents(t: DriverTables) -> DataFrame:
    rows = routing.question_intents(t.questions()).drop("text")
    return rows.withColumns({name: F.col(name).cast("int") for name in routing.INTENTS})


@query
def question_locations(t: DriverTables) -> DataFrame:
    return routing.mentioned_locations(t.questions(), t.places())


@query
def question_plan(t: DriverTables) -> DataFrame:
    rows = routing.question_plan(t.questions(), t.places())
    flags = ("uses_data_health", "uses_summary", "uses_catalogue")
    return rows.withColumns({name: F.col(name).cast("int") for name in flags})


@query
def station_catalogue(t: DriverTables) -> DataFrame:
    return routing.station_catalogue(serving.locations_with_parameters(t.locations, t.by_location))


@query
def conversation_bounds(t: DriverTables) -> DataFrame:
    return routing.conversation_bounds(t.read("conversations"))


@query
def run_audit_fold(t: DriverTables) -> DataFrame:
    return run_audit.fold_runs(t.run_events())


@query
def run_audit_errors(t: DriverTables) -> DataFrame:
    rows = run_audit.with_window(t.run_events())
    rows = rows.withColumn("stage", F.when(divides(13, "seq"), "unknown").otherwise(F.col("stage")))
    rows = rows.withColumn(
        "observations", F.when(divides(11, "seq"), -1).otherwise(F.col("observations"))
    )
    reason = F.coalesce(run_audit.event_error(), F.lit("valid"))
    return rows.groupBy("kind", reason.alias("outcome")).agg(F.count(F.lit(1)).alias("events"))


@query
def latest_run(t: DriverTables) -> DataFrame:
    newest = run_audit.newest_run_events(t.run_events(), "daily")
    return serving.latest_run(run_audit.fold_runs(newest), "daily")


# -- whole build -------------------------------------------------------------------------------------------


@query
def build_report(t: DriverTables) -> DataFrame:
    from envlake.plans import rebuild

    return rebuild.build_report(t)


# -- streaming ---------------------------------------------------------------------------------------------


@query
def stream_incremental(t: DriverTables) -> DataFrame:
    from envlake.streaming.replay import replay_daily_mart

    return replay_daily_mart(t)


