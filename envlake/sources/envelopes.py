"""Raw measurement envelopes: discovery, contract and split into records."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.domain import SCHEMA_VERSION, SOURCE
from envlake.errors import InputError
from envlake.functions import instants, text, variants
from envlake.functions.rules import failed
from envlake.sources.bundles import read_documents

# Place and kind of the landed batches.
RAW_SUBDIR = "openaq/measurements"
RAW_BUNDLES = "openaq/bundles"
RESOURCE = "measurements"
REQUIRED_RETRIEVAL = (
    "location_id",
    "sensor_id",
    "parameter",
    "datetime_from",
    "datetime_to",
    "returned",
    "complete",
)
BATCH = ("batch_location_id", "batch_location_name", "batch_sensor_id", "batch_parameter")
UNREADABLE = "unreadable or invalid JSON"
BROKEN_CONTRACT = "invalid raw envelope/provenance"

ENVELOPE_STRUCT = (
    "source: variant, resource: variant, schema_version: variant, "
    "retrieval: struct<location_id: variant, location_name: variant, sensor_id: variant, parameter: variant, "
    "datetime_from: variant, datetime_to: variant, returned: variant, complete: variant>, "
    "source_meta: variant, source_pages: variant, measurements: array<string>"
)


def read_raw_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(path, content) of every landed batch below ``raw_dir``, in files of its own or in bundles.

    One file is one JSON document, so one row; small files share a task.
    """
    root = raw_dir.rstrip("/")
    path = relative_path(F.col("_metadata.file_path"))
    files = read_documents(spark, f"{root}/{RAW_SUBDIR}", f"{root}/{RAW_BUNDLES}", path)
    if files is None:
        raise InputError(f"No measurement batches found below {RAW_SUBDIR}.")
    return files


def relative_path(path: Column) -> Column:
    """Path below the raw root, with URL escapes removed."""
    return F.regexp_extract(F.try_url_decode(path), f"({RAW_SUBDIR}/.*)$", 1)


def parse_envelopes(files: DataFrame) -> DataFrame:
    """Envelope parts per file and ``envelope_error``, null when the contract holds.

    Measurements are split as text first and parsed one by one later: a record
    with a non-finite number must not make its whole envelope unreadable.

    The content is read as the first element of an array that ends in a null. More
    elements, or a broken array, show a file that is not one JSON document.
    """
    stripped = F.btrim("content", F.lit(text.WHITESPACE))
    inside = F.concat(F.lit("["), stripped, F.lit(",null]"))
    documents = F.when(stripped.startswith("{") & stripped.endswith("}"), F.from_json(inside, f"array<struct<{ENVELOPE_STRUCT}>>"))
    split = files.select("path", documents.alias("d"))
    whole = (F.size("d") == 2) & F.col("d")[1].isNull()
    parsed = split.select("path", F.when(whole, F.col("d")[0]).alias("e"))
    # Each leaf is looked at once; the contract then combines plain columns only.
    read = parsed.select("path", *(column.alias(name) for name, column in _leaves().items()))
    checked = read.withColumns({"window_ok": window_holds(F.col("retrieval_datetime_from"), F.col("retrieval_datetime_to"))})
    error = F.when(~F.col("readable"), UNREADABLE).when(failed(_contract()), BROKEN_CONTRACT)
    return checked.select(
        "path", error.alias("envelope_error"), *BATCH, "retrieval_datetime_from", "retrieval_datetime_to", "measurements"
    )


def _leaves() -> dict[str, Column]:
    """Members of the envelope as plain columns, and the provenance that every record of the batch shares."""

    def part(name: str) -> Column:
        return F.col(f"e.retrieval.{name}")

    def identifier(name: str) -> Column:
        return F.when(variants.is_identifier(part(name)), variants.integer_of(part(name)))

    present = [part(name).isNotNull() for name in REQUIRED_RETRIEVAL]
    pages, meta, name = F.col("e.source_pages"), F.col("e.source_meta"), part("location_name")
    page_list = F.try_variant_get(pages, "$", "array<variant>")
    return {
        "readable": F.col("e").isNotNull(),
        "source_text": variants.text_of(F.col("e.source")),
        "resource_text": variants.text_of(F.col("e.resource")),
        "version": variants.integer_of(F.col("e.schema_version")),
        "complete": part("complete").isNotNull()
        & (variants.kind(part("complete")) == "BOOLEAN")
        & F.try_variant_get(part("complete"), "$", "boolean"),
        "returned": variants.integer_of(part("returned")),
        "parameter_text": variants.text_of(part("parameter")),
        "parts_present": functools.reduce(lambda one, other: one & other, present),
        "meta_ok": meta.isNotNull() & (variants.is_missing(meta) | variants.is_object(meta)),
        "pages_ok": pages.isNull() | (variants.is_array(pages) & F.forall(page_list, variants.is_object)),
        "location_name_ok": variants.is_missing(name) | variants.is_text(name),
        "batch_location_id": identifier("location_id"),
        "batch_location_name": variants.text_of(name),
        "batch_sensor_id": identifier("sensor_id"),
        "batch_parameter": text.canonical_name(variants.text_of(part("parameter"))),
        "retrieval_datetime_from": variants.text_of(part("datetime_from")),
        "retrieval_datetime_to": variants.text_of(part("datetime_to")),
        "measurements": F.col("e.measurements"),
    }


def _contract() -> Column:
    col = F.col
    return (
        (col("source_text") == SOURCE)
        & (col("resource_text") == RESOURCE)
        & (col("version") == SCHEMA_VERSION)
        & col("parts_present")
        & col("measurements").isNotNull()
        & (col("returned") == F.size("measurements"))
        & col("complete")
        & col("meta_ok")
        & col("pages_ok")
        & ~text.is_blank(col("parameter_text"))
        & col("location_name_ok")
        & col("window_ok")
    )


def window_holds(start: Column, end: Column) -> Column:
    """Both boundaries are dates or both are zoned instants, and end > start."""
    dates = instants.parse_date(end) > instants.parse_date(start)
    with_t = lambda value: F.when(F.contains(value, F.lit("T")), value)
    times = instants.parse_instant(with_t(end)) > instants.parse_instant(with_t(start))
    return F.coalesce(dates, F.lit(False)) | F.coalesce(times, F.lit(False))


def split_records(envelopes: DataFrame) -> DataFrame:
    """One row per measurement with its position and batch provenance.

    A broken or empty envelope yields one row with a null position, so that file
    counts and errors come out of the same pass as the records.
    """
    usable = F.when(F.col("envelope_error").isNull(), F.col("measurements"))
    return envelopes.select(
        F.col("path").alias("source_file"),
        "envelope_error",
        *BATCH,
        "retrieval_datetime_from",
        "retrieval_datetime_to",
        F.posexplode_outer(usable).alias("position", "record_text"),
    )


def first_envelope_error(envelopes: DataFrame) -> DataFrame:
    """Number of broken files and the first of them in path order."""
    broken = envelopes.filter("envelope_error IS NOT NULL")
    first = F.min_by(F.struct("path", "envelope_error"), text.path_parts(F.col("path")))
    return broken.agg(F.count(F.lit(1)).alias("broken_files"), first.alias("first")).select(
        "broken_files", "first.path", "first.envelope_error"
    )
