"""Model tests: every test returns its violations; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import KEY, PARAMETERS
from envlake.operators.models import DAILY_GRAIN, LOCATION_GRAIN

# The declared generic tests. -----------------------------------

OBSERVATION_NOT_NULL = (
    "location_id",
    "sensor_id",
    "parameter",
    "unit",
    "value",
    "datetime_from_utc",
    "datetime_to_utc",
    "measurement_date_utc",
    "source",
)
STATISTICS_NOT_NULL = (
    "observation_count",
    "average_value",
    "minimum_value",
    "maximum_value",
    "weather_context_count",
    "weather_context_percentage",
)
NOT_NULL = {
    "locations": ("location_id",),
    "observations": OBSERVATION_NOT_NULL,
    "stg_locations": ("location_id",),
    "stg_observations": OBSERVATION_NOT_NULL,
    "int_air_quality_weather": (*OBSERVATION_NOT_NULL, "has_weather_context"),
    "fct_air_quality_observations": (*OBSERVATION_NOT_NULL, "has_weather_context"),
    "agg_daily_air_quality": (*DAILY_GRAIN, *STATISTICS_NOT_NULL),
    "agg_location_air_quality": (
        *LOCATION_GRAIN,
        *STATISTICS_NOT_NULL,
        "earliest_observation_utc",
        "latest_observation_utc",
    ),
    "agg_pollution_weather": (
        *DAILY_GRAIN,
        "observation_count",
        "average_pollution_value",
        "temperature_observation_count",
        "humidity_observation_count",
        "precipitation_observation_count",
        "wind_observation_count",
    ),
}
ACCEPTED_PARAMETERS = (
    "observations",
    "stg_observations",
    "int_air_quality_weather",
    "fct_air_quality_observations",
    "agg_daily_air_quality",
    "agg_location_air_quality",
    "agg_pollution_weather",
)
UNIQUE = ("locations", "stg_locations")
RELATIONSHIPS = {
    "observations": "locations",
    "stg_observations": "stg_locations",
    "int_air_quality_weather": "stg_locations",
    "fct_air_quality_observations": "stg_locations",
}

KEY_COLUMN = "location_id"

# End of fixed values. --------------------------------------------------------


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def unique(rows: DataFrame, *key: str) -> DataFrame:
    present = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in key))
    counted = rows.filter(present).groupBy(*key).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.filter("record_count > 1")


def accepted_values(rows: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Distinct values outside the accepted ones; null is not a value."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child keys without a parent, with the number of rows that hold them.

    Counting per key first leaves one row per key for the anti join.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    return keys.join(parent, column, "left_anti")


def generic_tests(relations: Mapping[str, DataFrame]) -> DataFrame:
    """(model, test, column_name, failures) for every declared generic test.

    Models that are the same relation share one scan of it. All scans meet in one
    aggregation by relation and location, which combines before its shuffle and holds
    what every test needs: broken cells, rows per key, and which keys a parent has.
    No relation is joined to another; what is joined at the end are counts.
    """
    scans = _distinct(relations)
    number = {model: i for i, (_, models) in enumerate(scans) for model in models}
    checks = [_checks(models) for _, models in scans]
    width = max(map(len, checks))

    def flags(i: int) -> list[Column]:
        found = [broken.alias(f"broken_{j}") for j, broken in enumerate(checks[i].values())]
        return found + [F.lit(False).alias(f"broken_{j}") for j in range(len(found), width)]

    seen = [rows.select(F.lit(i).alias("relation"), KEY_COLUMN, *flags(i)) for i, (rows, _) in enumerate(scans)]
    counted = reduce(DataFrame.unionAll, seen).groupBy("relation", KEY_COLUMN).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(f"broken_{j}").alias(f"broken_{j}") for j in range(width)),
    )
    # One entry per relation, so the list is as short as the declared suite.
    entry = F.struct("relation", "rows", F.array(*(f"broken_{j}" for j in range(width))).alias("broken"))
    per_key = counted.groupBy(KEY_COLUMN).agg(F.collect_list(entry).alias("found"))
    known = F.col(KEY_COLUMN).isNotNull()

    def rows_of(model: str) -> Column:
        here = F.filter("found", lambda e: e["relation"] == number[model])
        return F.coalesce(F.get(here, F.lit(0))["rows"], F.lit(0))

    key_tests = {(model, "unique"): F.when(known & (rows_of(model) > 1), 1).otherwise(0) for model in UNIQUE}
    key_tests |= {
        (child, "relationships"): F.when(known & (rows_of(parent) == 0), rows_of(child)).otherwise(0)
        for child, parent in RELATIONSHIPS.items()
    }

    def failure(relation: Column, place: Column, n: Column) -> Column:
        return F.struct(relation.alias("relation"), place.alias("place"), n.cast("bigint").alias("n"))

    by_row = F.flatten(F.transform("found", lambda e: F.transform(e["broken"], lambda n, place: failure(e["relation"], place, n))))
    by_key = F.array(*(failure(F.lit(-1), F.lit(place), n) for place, n in enumerate(key_tests.values())))
    failures = per_key.select(F.inline(F.concat(by_row, by_key))).groupBy("relation", "place").agg(F.sum("n").alias("n"))
    # Every declared test has a line, whatever the relations hold.
    declared = [
        (model, test, column, number[model], place)
        for model in NOT_NULL
        for place, (test, column) in enumerate(checks[number[model]])
        if column in NOT_NULL[model] and test == "not_null" or model in ACCEPTED_PARAMETERS and test == "accepted_values"
    ]
    declared += [(model, test, KEY_COLUMN, -1, place) for place, (model, test) in enumerate(key_tests)]
    names = ("model", "test", "column_name", "relation", "place")
    lines = F.array(*(F.struct(*(F.lit(value).alias(name) for name, value in zip(names, line, strict=True))) for line in declared))
    tests = scans[0][0].sparkSession.range(1).select(F.inline(lines))
    return tests.join(failures, ["relation", "place"], "left").select(
        "model", "test", "column_name", F.coalesce("n", F.lit(0)).alias("failures")
    )


def _distinct(relations: Mapping[str, DataFrame]) -> list[tuple[DataFrame, list[str]]]:
    """Relations with the tested models that are the same data."""
    found: list[tuple[DataFrame, list[str]]] = []
    for model in NOT_NULL:
        rows = relations[model]
        same = next((models for other, models in found if rows is other or rows.sameSemantics(other)), None)
        if same is None:
            found.append((rows, [model]))
        else:
            same.append(model)
    return found


def _checks(models: list[str]) -> dict[tuple[str, str], Column]:
    """Tests of single rows that any of the models declares."""
    checks = {("not_null", name): F.col(name).isNull() for model in models for name in NOT_NULL[model]}
    if any(model in ACCEPTED_PARAMETERS for model in models):
        outside = F.col("parameter").isNotNull() & ~F.col("parameter").isin(*PARAMETERS)
        checks["accepted_values", "parameter"] = outside
    return checks


def natural_key_repeats(relations: Mapping[str, DataFrame]) -> DataFrame:
    """Natural keys held twice within one labelled relation."""
    labelled = [
        rows.select(F.lit(label).alias("relation_name"), *KEY) for label, rows in relations.items()
    ]
    counted = (
        reduce(DataFrame.unionByName, labelled)
        .groupBy("relation_name", *KEY)
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    return counted.filter("record_count > 1")


def row_count_drift(
    warehouse: DataFrame, staging: DataFrame, intermediate: DataFrame, fact: DataFrame
) -> DataFrame:
    """The four row counts, returned only when they differ."""
    layers = {
        "warehouse_rows": warehouse,
        "staging_rows": staging,
        "intermediate_rows": intermediate,
        "fact_rows": fact,
    }
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        for name, rows in layers.items()
    ]
    one_row = reduce(DataFrame.unionByName, counts).agg(
        *(F.max(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers)
    )
    return one_row.filter(
        "warehouse_rows <> staging_rows OR staging_rows <> intermediate_rows "
        "OR intermediate_rows <> fact_rows"
    )


def grain_repeats(daily: DataFrame, location: DataFrame, weather: DataFrame) -> DataFrame:
    """Mart grains that occur more than once."""
    keys = reduce(
        DataFrame.unionByName,
        [
            daily.select(F.lit("daily").alias("mart"), *DAILY_GRAIN),
            location.select(
                F.lit("location").alias("mart"),
                F.lit(None).cast("date").alias("measurement_date_utc"),
                *LOCATION_GRAIN,
            ),
            weather.select(F.lit("weather").alias("mart"), *DAILY_GRAIN),
        ],
    )
    counted = keys.groupBy("mart", *DAILY_GRAIN).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.filter("record_count > 1")


def broken_invariants(daily: DataFrame, location: DataFrame) -> DataFrame:
    """Mart rows whose statistics cannot be true."""
    span = ("earliest_observation_utc", "latest_observation_utc")
    columns = (*LOCATION_GRAIN, *STATISTICS_NOT_NULL)
    tagged_daily = daily.select(F.lit("daily").alias("mart"), *columns)
    tagged_location = location.select(F.lit("location").alias("mart"), *columns, *span)
    summaries = tagged_daily.unionByName(tagged_location, allowMissingColumns=True)
    return summaries.filter(
        "observation_count <= 0 OR minimum_value > maximum_value "
        "OR weather_context_count < 0 OR weather_context_count > observation_count "
        "OR weather_context_percentage < 0 OR weather_context_percentage > 100 "
        "OR earliest_observation_utc > latest_observation_utc"
    ).select("mart", *LOCATION_GRAIN)


def weather_mart_differences(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Groups of the weather mart that do not follow from the matched facts."""
    expected = (
        fact.filter("has_weather_context")
        .groupBy(*DAILY_GRAIN)
        .agg(F.count(F.lit(1)).alias("expected_count"))
    )
    samples = [
        "temperature_observation_count",
        "humidity_observation_count",
        "precipitation_observation_count",
        "wind_observation_count",
    ]
    joined = expected.join(
        weather.select(*DAILY_GRAIN, "observation_count", *samples), list(DAILY_GRAIN), "full"
    )
    broken = ~F.col("expected_count").eqNullSafe(F.col("observation_count")) | (
        F.col("observation_count") <= 0
    )
    for name in samples:
        broken = broken | ~F.col(name).between(F.lit(0), F.col("observation_count"))
    return joined.filter(broken).select("location_id", "parameter", "unit")
