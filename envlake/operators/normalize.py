"""Typed observations from raw records, with one reason per rejected record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import NANO_COLUMNS, OBSERVATION_COLUMNS, PARAMETERS, SOURCE
from envlake.functions import instants, text, variants
from envlake.functions.plans import compute_once
from envlake.functions.rules import failed

# Rejection reasons in no particular order; the order in which
# they are tested is the order of the rules in ``_reject_reason``.
MISSING_FIELD = "missing_required_field"
BAD_IDENTIFIER = "invalid_identifier"
BAD_PARAMETER = "invalid_parameter"
MISMATCH = "parameter_mismatch"
MISSING_UNIT = "missing_unit"
BAD_VALUE = "invalid_value"
BAD_TIMESTAMP = "invalid_timestamp"
BAD_PERIOD = "invalid_period"

# Marks rows that stand for a whole broken file instead of a record.
BROKEN_FILE = "broken_file"
# Marks rows that stand for a readable file without records.
NO_RECORDS = "no_records"
MARKERS = (BROKEN_FILE, NO_RECORDS)


# Members the model reads; everything else only takes part in the signature.
MEMBERS_DDL = (
    "value variant, parameter struct<id: variant, name: variant, units: variant>, "
    "period struct<label: variant, interval: variant, "
    "datetimeFrom: struct<utc: variant, local: variant>, "
    "datetimeTo: struct<utc: variant, local: variant>>, coordinates variant"
)
BATCH_COLUMNS = (
    "source_file",
    "position",
    "envelope_error",
    "batch_location_id",
    "batch_location_name",
    "batch_sensor_id",
    "batch_parameter",
    "retrieval_datetime_from",
    "retrieval_datetime_to",
)


def normalize(records: DataFrame, with_signature: bool = True) -> DataFrame:
    """Add the observation columns, the comparison signature and the reason.

    ``reject_reason`` is null for valid rows. Identity columns and payload are
    null on rejected rows, so they group together cheaply later on. Only the
    collapse of copies needs the signature; others can go without its cost.
    """
    reasoned = _read_members(records).withColumn("reject_reason", _reject_reason())
    valid = F.col("reject_reason").isNull()
    columns = _observation_columns()
    rows = reasoned.select(
        "reject_reason",
        "source_file",
        "position",
        "envelope_error",
        *(
            F.when(valid, columns[name]).alias(name)
            for name in (*OBSERVATION_COLUMNS, *NANO_COLUMNS)
            if name != "source_file"
        ),
        *([F.when(valid, _signature()).alias("signature")] if with_signature else []),
    )
    # A later filter on the reason must not repeat all of the parsing.
    return compute_once(rows, {name: F.col(name) for name in rows.columns})


def _read_members(records: DataFrame) -> DataFrame:
    """Parse each record once into plain columns that the rules then combine.

    Members are read as VARIANT leaves, which keep their JSON kind; a part that
    should be an object but is not becomes null as a whole.
    """
    is_object = F.startswith("record_text", F.lit("{"))
    parsed = records.withColumn("r", F.when(is_object, F.from_json("record_text", MEMBERS_DDL)))

    def text_at(path: str) -> Column:
        return variants.text_of(F.col(path))

    def is_optional_text(path: str) -> Column:
        return F.coalesce(variants.kind(F.col(path)).isin("VOID", "STRING"), F.lit(True))

    def is_optional_number(value: Column) -> Column:
        return variants.is_missing(value) | variants.is_number(value)

    coordinates = F.col("r.coordinates")
    latitude = variants.member(coordinates, "$.latitude")
    longitude = variants.member(coordinates, "$.longitude")
    parameter_id = F.col("r.parameter.id")
    start, end = "r.period.datetimeFrom", "r.period.datetimeTo"
    columns = {
        **{name: F.col(name) for name in BATCH_COLUMNS},
        "record_text": F.col("record_text"),
        "has_record": F.col("r").isNotNull(),
        "has_parameter": F.col("r.parameter").isNotNull(),
        "has_period": F.col("r.period").isNotNull(),
        "coordinates_ok": variants.is_missing(coordinates) | variants.is_object(coordinates),
        "name_text": text_at("r.parameter.name"),
        "unit": text_at("r.parameter.units"),
        "parameter_id": F.when(
            variants.is_identifier(parameter_id), variants.integer_of(parameter_id)
        ),
        "parameter_id_missing": variants.is_missing(parameter_id),
        "raw_value": F.col("r.value"),
        "number": variants.number_of(F.col("r.value")),
        "label": text_at("r.period.label"),
        "interval": text_at("r.period.interval"),
        "labels_ok": is_optional_text("r.period.label") & is_optional_text("r.period.interval"),
        "from_text": text_at(f"{start}.utc"),
        "to_text": text_at(f"{end}.utc"),
        "from_local": text_at(f"{start}.local"),
        "to_local": text_at(f"{end}.local"),
        "from_local_ok": is_optional_text(f"{start}.local"),
        "to_local_ok": is_optional_text(f"{end}.local"),
        "latitude": variants.number_of(latitude),
        "longitude": variants.number_of(longitude),
        "position_ok": is_optional_number(latitude) & is_optional_number(longitude),
    }
    read = parsed.select(*(column.alias(name) for name, column in columns.items()))
    derived = {
        "name": text.canonical_name(F.col("name_text")),
        "from_instant": instants.parse_instant(F.col("from_text")),
        "to_instant": instants.parse_instant(F.col("to_text")),
        "from_nanos": instants.nanosecond_remainder(F.col("from_text")),
        "to_nanos": instants.nanosecond_remainder(F.col("to_text")),
    }
    return read.withColumns(derived)


def _reject_reason() -> Column:
    """First failing rule; every rule is null-safe."""
    col = F.col
    start = F.struct("from_instant", "from_nanos")
    end = F.struct("to_instant", "to_nanos")
    rules = [
        (MISSING_FIELD, col("has_record")),
        (BAD_IDENTIFIER, col("batch_location_id").isNotNull() & col("batch_sensor_id").isNotNull()),
        (MISSING_FIELD, col("has_parameter") & col("has_period")),
        (BAD_PARAMETER, col("name").isin(*PARAMETERS)),
        (MISMATCH, col("name") == col("batch_parameter")),
        (BAD_IDENTIFIER, col("parameter_id_missing") | col("parameter_id").isNotNull()),
        (MISSING_UNIT, ~text.is_blank(col("unit"))),
        (BAD_VALUE, col("number").isNotNull()),
        (BAD_TIMESTAMP, col("from_instant").isNotNull() & col("from_local_ok")),
        (BAD_TIMESTAMP, col("to_instant").isNotNull() & col("to_local_ok")),
        (BAD_PERIOD, end > start),
        (MISSING_FIELD, col("coordinates_ok")),
        (BAD_VALUE, col("position_ok")),
        (MISSING_FIELD, col("labels_ok")),
    ]
    reason = F.when(col("envelope_error").isNotNull(), BROKEN_FILE).when(
        col("position").isNull(), NO_RECORDS
    )
    for name, ok in rules:
        reason = reason.when(failed(ok), name)
    return reason


def _observation_columns() -> dict[str, Column]:
    sources = {
        "location_id": "batch_location_id",
        "location_name": "batch_location_name",
        "sensor_id": "batch_sensor_id",
        "parameter": "name",
        "parameter_id": "parameter_id",
        "unit": "unit",
        "value": "number",
        "period_label": "label",
        "period_interval": "interval",
        "datetime_from_utc": "from_instant",
        "datetime_to_utc": "to_instant",
        "datetime_from_local": "from_local",
        "datetime_to_local": "to_local",
        "latitude": "latitude",
        "longitude": "longitude",
        "retrieval_datetime_from": "retrieval_datetime_from",
        "retrieval_datetime_to": "retrieval_datetime_to",
        "datetime_from_ns": "from_nanos",
        "datetime_to_ns": "to_nanos",
    }
    return {"source": F.lit(SOURCE), **{name: F.col(column) for name, column in sources.items()}}


def _signature() -> Column:
    """Digest of the whole record with name, instants and value canonical.

    Two records with the same digest are the same measurement; provenance of
    the batch takes no part. Members this model does not know do take part.
    VARIANT text has sorted keys and plain numbers, so a record that is spelled
    canonically already is digested as it stands; others are respelled first.
    """
    record = F.try_parse_json("record_text")
    start = instants.canonical_utc(F.col("from_instant"), F.col("from_nanos"))
    end = instants.canonical_utc(F.col("to_instant"), F.col("to_nanos"))
    plain_number = variants.kind(F.col("raw_value")).rlike("^(BIGINT|DECIMAL)")
    canonical = (
        (F.col("name_text") == F.col("name"))
        & (F.col("from_text") == start)
        & (F.col("to_text") == end)
        & plain_number
    )
    number = F.col("number")
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(1e38))
    value = (
        F.when(plain_number, F.col("raw_value"))
        .when(whole, number.cast("decimal(38,0)").cast("variant"))
        .otherwise(F.col("raw_value"))
    )

    def boundary(name: str, utc: Column) -> Column:
        return variants.replaced(
            variants.member(record, f"$.period.{name}"), {"utc": utc.cast("variant")}
        )

    respelled = variants.replaced(
        record,
        {
            "value": value,
            "parameter": variants.replaced(
                variants.member(record, "$.parameter"), {"name": F.col("name").cast("variant")}
            ),
            "period": variants.replaced(
                variants.member(record, "$.period"),
                {
                    "datetimeFrom": boundary("datetimeFrom", start),
                    "datetimeTo": boundary("datetimeTo", end),
                },
            ),
        },
    )
    return F.sha2(F.when(canonical, record.cast("string")).otherwise(respelled.cast("string")), 256)
