"""Acquisition control over landed tables: scope, completeness, pages, registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from envlake.domain import MAX_ID, PARAMETERS
from envlake.errors import InputError
from envlake.functions import instants, text, variants
from envlake.functions.rules import failed

# Page size and page guard of one retrieval.
PAGE_LIMIT = 1000
MAX_PAGES = 1000


# -- scope ---------------------------------------------------------------------


def select_locations(configured: DataFrame, location_id: int | None = None) -> DataFrame:
    """All configured locations, or the one approved location asked for."""
    if location_id is None:
        return configured
    chosen = configured.filter(F.col("id") == location_id)
    if chosen.isEmpty():
        raise InputError("location_id must belong to the approved configuration.")
    return chosen


def check_required(required: Sequence[str]) -> None:
    if set(required) != set(PARAMETERS):
        raise InputError("required parameters must be pm25 and pm10 only.")


def select_sensors(sensors: DataFrame, required: Sequence[str] = PARAMETERS) -> DataFrame:
    """Sensors (location_id, sensor_id, parameter) of the required parameters."""
    check_required(required)
    return sensors.filter(F.col("parameter").isin(*required))


def missing_parameters(
    locations: DataFrame, sensors: DataFrame, required: Sequence[str] = PARAMETERS
) -> DataFrame:
    """Per location: matching sensors and the required parameters it lacks."""
    counted = (
        select_sensors(sensors, required)
        .groupBy("location_id")
        .agg(
            F.count(F.lit(1)).alias("matching_sensors"),
            F.collect_set("parameter").alias("present"),
        )
    )
    wanted = F.array(*map(F.lit, required))
    return (
        locations.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"))
        .join(counted, "location_id", "left")
        .select(
            "location_id",
            "location_name",
            F.coalesce("matching_sensors", F.lit(0)).alias("matching_sensors"),
            F.array_except(
                wanted, F.coalesce("present", F.array().cast("array<string>"))
            ).alias("missing_parameters"),
        )
    )


# -- completeness --------------------------------------------------------------


def count_text(value: Column) -> Column:
    """Digits of a JSON integer or of text made of digits; null otherwise."""
    digits = F.coalesce(
        variants.integer_of(value).cast("string"), text.strip(variants.text_of(value))
    )
    return F.when(digits.rlike("^[0-9]+$"), digits)


def incomplete(found: Column, returned: Column, pagination_complete: Column) -> Column:
    """False, true, or null when the source gave no exact total."""
    total = F.when(text.digits_only(found), text.strip(found).try_cast("decimal(38,0)"))
    return F.when(F.coalesce(pagination_complete, F.lit(False)), F.lit(False)).otherwise(
        total > returned
    )


# -- windows -------------------------------------------------------------------


def normalize_windows(requests: DataFrame) -> DataFrame:
    """Check run requests and normalise their window.

    Input: run_mode, date_from, date_to, checkpoint, datetime_to, location_id.
    ``window_error`` is null for requests that may run.
    """
    read = requests.withColumns(
        {
            "_first_day": instants.parse_date(F.col("date_from")),
            "_last_day": instants.parse_date(F.col("date_to")),
            "_start": instants.parse_instant(_with_t(F.col("checkpoint"))),
            "_end": instants.parse_instant(_with_t(F.col("datetime_to"))),
        }
    )
    first_day, last_day, start, end = map(F.col, ("_first_day", "_last_day", "_start", "_end"))
    historical = F.col("run_mode") == "historical"
    location = F.col("location_id")
    error = (
        F.when(failed(F.col("run_mode").isin("historical", "incremental")), "unknown run mode")
        .when(location.isNotNull() & failed(location > 0), "location_id must be positive")
        .when(
            historical & (F.col("checkpoint").isNotNull() | F.col("datetime_to").isNotNull()),
            "historical mode uses dates only",
        )
        .when(
            ~historical & (F.col("date_from").isNotNull() | F.col("date_to").isNotNull()),
            "incremental mode uses timestamps only",
        )
        .when(historical & (first_day.isNull() | last_day.isNull()), "dates must be YYYY-MM-DD")
        .when(historical & (last_day <= first_day), "end must be later than start")
        .when(~historical & (start.isNull() | end.isNull()), "timestamps must name a zone")
        .when(~historical & (end <= start), "end must be later than start")
    )
    ok = F.col("window_error").isNull()
    windowed = read.withColumn("window_error", error).withColumns(
        {
            "window_from": F.when(
                ok, F.when(historical, F.col("date_from")).otherwise(instants.iso_utc(start))
            ),
            "window_to": F.when(
                ok, F.when(historical, F.col("date_to")).otherwise(instants.iso_utc(end))
            ),
        }
    )
    label = F.concat(
        instants.compact_label(F.col("window_from")),
        F.lit("__"),
        instants.compact_label(F.col("window_to")),
    )
    return windowed.withColumn("window_label", label).drop(
        "_first_day", "_last_day", "_start", "_end"
    )


def _with_t(value: Column) -> Column:
    return F.when(F.contains(value, F.lit("T")), value)


# -- page sequence -------------------------------------------------------------


def audit_pages(
    pages: DataFrame, keys: Sequence[str] = ("resource", "run_id"), max_pages: int = MAX_PAGES
) -> DataFrame:
    """Outcome of each paginated retrieval.

    Input per requested page: keys, page, results_ok, meta_page, meta_limit,
    meta_found (text), returned, content_hash. A retrieval ends at its first
    fault or when it is complete. A page without a number from 1 on makes the whole
    sequence inconsistent; one that goes on beyond the page guard exceeds it. Every
    retrieval has an outcome. Windows below see ``max_pages`` rows at most.
    """
    number = F.col("page")
    strays = pages.groupBy(*keys).agg(
        F.max(number.isNull() | (number < 1)).alias("bad_number"),
        F.max(F.coalesce(number > max_pages, F.lit(False))).alias("beyond"),
    )
    landed = (
        pages.filter(number.between(1, max_pages))
        # A page landed twice must not enlarge the window.
        .groupBy(*keys, "page")
        .agg(
            F.bool_and("results_ok").alias("results_ok"),
            *(F.min(name).alias(name) for name in ("meta_page", "meta_limit", "meta_found")),
            F.min("returned").alias("returned"),
            F.min("content_hash").alias("content_hash"),
            F.max("content_hash").alias("other_hash"),
        )
    )
    limit = F.coalesce(F.col("meta_limit"), F.lit(str(PAGE_LIMIT)))
    counted = landed.withColumns(
        {
            "limit": F.when(text.digits_only(limit), text.strip(limit).try_cast("bigint")),
            "found": F.when(
                text.digits_only(F.col("meta_found")),
                text.strip(F.col("meta_found")).try_cast("bigint"),
            ),
            "stated_page": F.when(
                text.digits_only(F.col("meta_page")),
                text.strip(F.col("meta_page")).try_cast("bigint"),
            ),
            "digest": F.when(F.col("returned") > 0, F.col("content_hash")),
        }
    )
    in_order = Window.partitionBy(*keys).orderBy("page")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    same_content = Window.partitionBy(*keys, "digest").orderBy("page")
    scanned = counted.select(
        "*",
        F.row_number().over(in_order).alias("expected_page"),
        F.first("limit", True).over(so_far).alias("first_limit"),
        F.first("found", True).over(so_far).alias("total"),
        F.sum("returned").over(so_far).alias("running"),
        F.row_number().over(same_content).alias("copy"),
    )
    col = F.col
    outcome = (
        F.when(failed(col("results_ok")), "invalid_page")
        .when(
            (col("page") != col("expected_page"))
            | (col("meta_page").isNotNull() & failed(col("stated_page") == col("page"))),
            "inconsistent_page_number",
        )
        .when(
            failed(col("limit").between(1, PAGE_LIMIT)) | (col("returned") > col("limit")),
            "inconsistent_page_size",
        )
        .when(col("limit") != col("first_limit"), "changed_page_size")
        .when(col("found") != col("total"), "changed_total")
        .when(
            (col("digest").isNotNull() & (col("copy") > 1))
            | (col("content_hash") != col("other_hash")),
            "repeated_page",
        )
        .when(
            col("total").isNotNull()
            & (
                (col("running") > col("total"))
                | ((col("returned") == 0) & (col("running") < col("total")))
            ),
            "inconsistent_total",
        )
        .when(
            F.when(col("total").isNotNull(), col("running") >= col("total")).otherwise(
                col("returned") < col("limit")
            ),
            "complete",
        )
    )
    judged = scanned.withColumn("outcome", outcome)
    ended = col("outcome").isNotNull()
    last = F.min_by(F.struct("outcome", "page", "running"), F.when(ended, col("page")))
    folded = judged.groupBy(*keys).agg(
        last.alias("end"), F.max("page").alias("pages_landed"), F.max("running").alias("all_returned")
    )
    guarded = col("beyond") | F.coalesce(col("pages_landed") >= max_pages, F.lit(False))
    open_status = F.when(guarded, "page_limit_exceeded").otherwise("incomplete")
    same_run = F.lit(True)
    for name in keys:
        same_run = same_run & strays[name].eqNullSafe(folded[name])
    zero = F.lit(0)
    counted = lambda value: F.when(col("bad_number"), zero).otherwise(F.coalesce(*value, zero)).cast("bigint")
    return strays.join(folded, same_run, "left").select(
        *(strays[name] for name in keys),
        F.when(col("bad_number"), "inconsistent_page_number")
        .otherwise(F.coalesce(col("end.outcome"), open_status))
        .alias("status"),
        counted((col("end.page"), col("pages_landed"))).alias("pages_fetched"),
        counted((col("end.running"), col("all_returned"))).alias("returned"),
    )


# -- checkpoint safety ---------------------------------------------------------


def unsafe_reasons(runs: DataFrame, locations: DataFrame, sensors: DataFrame) -> DataFrame:
    """One row per reason why a run must not advance its checkpoint.

    runs: run_id; locations: run_id, location_id, missing_parameters,
    discovery_incomplete; sensors: run_id, sensor_id, incomplete.
    """
    return _ordered_reasons(runs, locations, sensors).drop("place")


def _ordered_reasons(runs: DataFrame, locations: DataFrame, sensors: DataFrame) -> DataFrame:
    """Reasons with their place: locations by id, then sensors by id."""
    lacking = F.size("missing_parameters") > 0
    place = F.col("location_id").cast("string")
    unknown = F.coalesce(F.col("discovery_incomplete"), F.lit(True))
    at = lambda kind, number, part: F.struct(
        F.lit(kind).alias("kind"), F.col(number).cast("bigint").alias("id"), part.alias("part")
    )
    texts = F.array(
        F.when(lacking, F.concat(F.lit("Location "), place, F.lit(" is missing required sensors."))),
        F.when(unknown, F.concat(F.lit("Location "), place, F.lit(" sensor discovery is incomplete or unknown."))),
    )
    location_reasons = (
        locations.select("run_id", "location_id", F.posexplode(texts).alias("part", "reason"))
        .filter("reason IS NOT NULL")
        .select("run_id", "reason", at(0, "location_id", F.col("part")).alias("place"))
    )
    sensor_reasons = sensors.filter(F.coalesce(F.col("incomplete"), F.lit(True))).select(
        "run_id",
        F.concat(
            F.lit("Sensor "),
            F.col("sensor_id").cast("string"),
            F.lit(" measurement completeness is incomplete or unknown."),
        ).alias("reason"),
        at(1, "sensor_id", F.lit(0)).alias("place"),
    )
    empty_runs = runs.join(locations.select("run_id").distinct(), "run_id", "left_anti").select(
        "run_id",
        F.lit("No configured locations were processed.").alias("reason"),
        F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("bigint").alias("id"), F.lit(0).alias("part")).alias("place"),
    )
    return empty_runs.unionByName(location_reasons).unionByName(sensor_reasons)


def checkpoint_safety(runs: DataFrame, locations: DataFrame, sensors: DataFrame) -> DataFrame:
    """Per run: the candidate checkpoint and whether it may be used.

    The candidate is the requested upper bound even when nothing was returned.
    Reasons are counted, not collected: a run may have very many of them.
    """
    reasons = (
        _ordered_reasons(runs, locations, sensors)
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("reason_count"), F.min(F.struct("place", "reason")).alias("first"))
        .select("run_id", "reason_count", "first.reason")
        .withColumnRenamed("reason", "first_reason")
    )
    scope = locations.groupBy("run_id").agg(F.count(F.lit(1)).alias("location_count"))
    safe = F.col("reason_count").isNull()
    return (
        runs.join(reasons, "run_id", "left")
        .join(scope, "run_id", "left")
        .select(
            *runs.columns,
            F.col("datetime_to").alias("next_checkpoint_candidate"),
            safe.alias("checkpoint_safe"),
            F.when(safe, "complete").otherwise("not_complete").alias("status"),
            F.coalesce("reason_count", F.lit(0)).alias("reason_count"),
            "first_reason",
            F.coalesce("location_count", F.lit(0)).alias("location_count"),
        )
    )


def acquisition_summary(sensors: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Per run: sensors queried, rows by parameter, completeness counters."""
    return sensors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sensors_queried"),
        F.sum("returned").alias("total_measurements"),
        *(
            F.sum(F.when(F.col("parameter") == name, F.col("returned")).otherwise(0)).alias(
                f"{name}_measurements"
            )
            for name in PARAMETERS
        ),
        F.count_if(F.col("returned") == 0).alias("empty_responses"),
        F.count_if(F.col("incomplete")).alias("incomplete_responses"),
        F.count_if(F.col("incomplete").isNull()).alias("unknown_completeness_responses"),
    )


# -- batch preparation and registry --------------------------------------------


def batch_path(
    location_id: Column, parameter: Column, sensor_id: Column, start: Column, end: Column
) -> Column:
    """Place of a batch, from its identifiers and window."""
    return F.concat(
        F.lit("openaq/measurements/location_id="),
        location_id.cast("string"),
        F.lit("/parameter="),
        parameter,
        F.lit("/sensor_id="),
        sensor_id.cast("string"),
        F.lit("/"),
        instants.compact_label(start),
        F.lit("__"),
        instants.compact_label(end),
        F.lit(".json"),
    )


def normalized_boundary(value: Column) -> Column:
    """A date unchanged, or a zoned instant as UTC text; null when neither."""
    instant = instants.parse_instant(_with_t(value))
    return F.when(instants.parse_date(value).isNotNull(), value).otherwise(instants.iso_utc(instant))


def batch_rules() -> dict[str, Column]:
    """Contract of batches to be registered.

    Columns: location_id, sensor_id, parameter, datetime_from, datetime_to,
    returned, records (array size), incomplete, pagination_complete.
    """
    start, end = F.col("datetime_from"), F.col("datetime_to")
    ordered = (instants.parse_date(end) > instants.parse_date(start)) | (
        instants.parse_instant(_with_t(end)) > instants.parse_instant(_with_t(start))
    )
    return {
        "incomplete": failed(F.col("incomplete") == F.lit(False)),
        "pagination": F.col("pagination_complete").isNotNull() & ~F.coalesce("pagination_complete", F.lit(False)),
        "location_id": failed(F.col("location_id").between(1, MAX_ID)),
        "sensor_id": failed(F.col("sensor_id").between(1, MAX_ID)),
        "parameter": failed(F.col("parameter").rlike("^[a-zA-Z0-9_-]+$")),
        "returned": failed(F.col("returned") == F.col("records")),
        "window_order": failed(ordered),
    }


def register_batches(incoming: DataFrame, registry: DataFrame) -> DataFrame:
    """Status per path: written, reused or conflict.

    incoming: path, content_hash, returned; registry: path, content_hash. The
    content itself takes no part, so only digests are shuffled. The first new
    copy of a path is written, every further equal copy is a reuse. A path that two
    concurrent runs have registered is one path if they agree, else a conflict.
    """
    arrived = incoming.groupBy("path").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("content_hash").alias("content_hash"),
        F.max("content_hash").alias("other_hash"),
        F.sum("returned").alias("measurements"),
    )
    known = registry.groupBy("path").agg(
        F.min("content_hash").alias("known_hash"), F.max("content_hash").alias("known_other")
    )
    joined = arrived.join(known, "path", "left")
    clash = (F.col("content_hash") != F.col("other_hash")) | (
        F.col("known_hash").isNotNull()
        & ((F.col("known_hash") != F.col("content_hash")) | (F.col("known_other") != F.col("content_hash")))
    )
    status = (
        F.when(clash, "conflict").when(F.col("known_hash").isNotNull(), "reused").otherwise("written")
    )
    return joined.withColumn("status", status).select(
        "path",
        "status",
        F.when(F.col("status") == "written", 1).otherwise(0).alias("batches_written"),
        F.when(F.col("status") == "written", F.col("copies") - 1)
        .when(F.col("status") == "reused", F.col("copies"))
        .otherwise(0)
        .alias("batches_reused"),
        "measurements",
    )


def registration_summary(registered: DataFrame) -> DataFrame:
    """One row of totals; any conflict means that nothing may be written."""
    return registered.agg(
        F.sum("batches_written").alias("batches_written"),
        F.sum("batches_reused").alias("batches_reused"),
        F.sum("measurements").alias("measurements_represented"),
        F.count_if(F.col("status") == "conflict").alias("conflicts"),
    )
