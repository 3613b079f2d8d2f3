"""Location configuration and the location catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.functions import text, variants
from envlake.operators.acquisition import count_text, incomplete

LOCATION_STRUCT = (
    "struct<id: bigint, name: string, locality: string, country_code: string, latitude: double, "
    "longitude: double, coordinates: struct<latitude: double, longitude: double>>"
)


def read_location_config(spark: SparkSession, path: str) -> DataFrame:
    """Configured locations; flat members or a coordinates object."""
    schema = f"locations array<{LOCATION_STRUCT}>"
    config = spark.read.schema(schema).json(path, multiLine=True)
    rows = config.select(F.inline("locations"))
    nested = F.col("coordinates").isNotNull()
    return rows.select(
        "id",
        "name",
        "locality",
        "country_code",
        F.when(nested, F.col("coordinates.latitude")).otherwise(F.col("latitude")).alias("latitude"),
        F.when(nested, F.col("coordinates.longitude")).otherwise(F.col("longitude")).alias("longitude"),
    )


def read_required_parameters(spark: SparkSession, path: str) -> DataFrame:
    """Required parameters of the configuration with their position."""
    config = spark.read.schema("selection struct<required_parameters: array<string>>").json(
        path, multiLine=True
    )
    return config.select(
        F.posexplode("selection.required_parameters").alias("position", "parameter")
    )


def flatten_catalogue(pages: DataFrame) -> DataFrame:
    """One row per catalogue location from ``content`` pages.

    ``parameters`` keeps the first-seen order of the sensors; members that are
    absent stay null and an empty list means that no names were supplied.
    """
    rows = pages.select(
        F.explode(F.from_json("content", "results array<string>")["results"]).alias("r")
    ).select(F.try_parse_json("r").alias("r"))

    def text_at(path: str):
        return variants.text_of(variants.member(F.col("r"), path))

    def boolean_at(path: str):
        value = variants.member(F.col("r"), path)
        return F.when(variants.kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))

    sensors = F.try_variant_get(F.col("r"), "$.sensors", "array<variant>")
    names = F.transform(
        sensors, lambda sensor: variants.text_of(variants.member(sensor, "$.parameter.name"))
    )
    named = F.filter(names, lambda name: name.isNotNull() & (name != ""))
    return rows.select(
        variants.integer_of(variants.member(F.col("r"), "$.id")).alias("id"),
        text_at("$.name").alias("name"),
        text_at("$.locality").alias("locality"),
        text_at("$.country.code").alias("country_code"),
        variants.number_of(variants.member(F.col("r"), "$.coordinates.latitude")).alias("latitude"),
        variants.number_of(variants.member(F.col("r"), "$.coordinates.longitude")).alias("longitude"),
        text_at("$.timezone").alias("timezone"),
        text_at("$.provider.name").alias("provider"),
        text_at("$.owner.name").alias("owner"),
        boolean_at("$.isMobile").alias("is_mobile"),
        boolean_at("$.isMonitor").alias("is_monitor"),
        F.coalesce(F.array_distinct(named), F.array().cast("array<string>")).alias("parameters"),
    )


def catalogue_totals(pages: DataFrame) -> DataFrame:
    """Rows returned, total the source names, and the completeness tri-state.

    Totals are compared as numbers. Pages that name different totals leave it open, as
    they cannot belong to one retrieval: ``found`` is then null and ``incomplete`` true.
    Text that is no plain number is shown only where no page has a number.
    """
    parts = pages.select(
        F.from_json("content", "meta variant, results array<string>").alias("p")
    ).select(
        F.size("p.results").cast("bigint").alias("rows"),
        count_text(variants.member(F.col("p.meta"), "$.found")).alias("found"),
    )
    number = F.when(text.digits_only(F.col("found")), text.strip(F.col("found")).try_cast("decimal(38,0)"))
    totals = parts.agg(
        F.sum("rows").alias("returned"), F.min(number).alias("least"), F.max(number).alias("most"), F.max("found").alias("other")
    )
    differing = F.coalesce(F.col("least") != F.col("most"), F.lit(False))
    found = F.when(~differing, F.coalesce(F.col("most").cast("string"), F.col("other")))
    state = incomplete(F.col("found"), F.col("returned"), F.lit(None).cast("boolean"))
    return totals.select("returned", found.alias("found"), differing.alias("differing")).select(
        "returned", "found", F.when(F.col("differing"), F.lit(True)).otherwise(state).alias("incomplete")
    )
