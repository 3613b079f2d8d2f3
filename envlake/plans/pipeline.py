"""The batch build: raw envelopes to marts, with a gate before every publication."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.domain import CURATED_ORDER, IDENTITY, KEY, PARTITIONS, SCHEMA_VERSION, WEATHER_VARIABLES
from envlake.errors import InputError
from envlake.functions import rules
from envlake.operators import curation, dedup, enrichment, expectations, models, warehouse
from envlake.operators.normalize import normalize
from envlake.session import configure
from envlake.sinks.snapshots import SnapshotStore, Table
from envlake.sources import envelopes, weather as weather_sources
from envlake.sources.locations import read_location_config
from envlake.sources.tables import read_enriched, read_observations, require_typed


@dataclass
class Pipeline:
    """Stages over one lake folder; each reads the snapshot before it."""

    spark: SparkSession
    lake: str
    config_path: str
    store: SnapshotStore = field(init=False)

    def __post_init__(self) -> None:
        configure(self.spark)
        self.store = SnapshotStore(self.spark, self.lake)

    def run(self, raw_dir: str, weather_dir: str) -> None:
        """All stages in order; a failing stage leaves later snapshots as they were."""
        self.process(raw_dir)
        self.curate()
        self.enrich(weather_dir)
        self.load()
        self.model()

    @property
    def configured(self) -> DataFrame:
        return read_location_config(self.spark, self.config_path)

    def process(self, raw_dir: str) -> DataFrame:
        """Parse once into a staged table, gate it, publish; returns the report."""
        files = envelopes.read_raw_files(self.spark, raw_dir)
        records = envelopes.split_records(envelopes.parse_envelopes(files))
        collapsed = dedup.collapse(normalize(records))

        def gate(staged: dict[str, DataFrame], counts: dict[str, int]) -> None:
            rows = staged["collapsed"]
            if not counts["collapsed"]:
                raise InputError("No measurement batches found.")
            dedup.require_publishable(rows)

        def report(staged: dict[str, DataFrame]) -> str:
            return _as_json(dedup.quality_report(staged["collapsed"]))

        self.store.publish("processed", {"collapsed": Table(collapsed)}, report, gate)
        return dedup.quality_report(self.store.read("processed", "collapsed"))

    def processed(self) -> DataFrame:
        return dedup.processed_rows(self.store.read("processed", "collapsed"))

    def curate(self) -> DataFrame:
        curated = curation.curate(self.processed())
        table = Table(curated, partition_by=PARTITIONS, order_by=CURATED_ORDER)

        def manifest(staged: dict[str, DataFrame]) -> str:
            return _as_json(curation.curated_manifest(staged["air_quality"]), columns=curated.columns, partition_columns=PARTITIONS)

        self.store.publish("curated", {"air_quality": table}, manifest)
        return self.curated()

    def curated(self) -> DataFrame:
        # One build wrote the files, so they hold the same columns.
        rows = read_observations(self.spark, self.store.path("curated", "air_quality"), merge=False)
        return require_typed(rows, "curated input")

    def enrich(self, weather_dir: str) -> DataFrame:
        observations = self.curated()
        plan = enrichment.request_plan(observations, self.configured)
        missing = plan.filter("coordinate_error IS NOT NULL").orderBy("location_id").first()
        if missing is not None:
            raise InputError(f"location {missing.location_id}: {missing.coordinate_error}")
        parsed = weather_sources.parse_weather(
            weather_sources.read_weather_files(self.spark, weather_dir)
        )
        rules.require_clean(parsed, weather_sources.weather_rules(), "weather responses")
        hours = weather_sources.weather_hours(parsed)
        enrichment.check_enrichment_input(observations, hours)
        enriched = enrichment.join_weather(observations, hours)
        before = self.store.manifest("curated")

        def gate(staged: dict[str, DataFrame], counts: dict[str, int]) -> None:
            if before is None or json.loads(before)["row_count"] != counts["air_quality_weather"]:
                raise InputError("enrichment changed the number of observations")
            rules.require_unique(staged["air_quality_weather"], IDENTITY, "enriched output")

        def manifest(staged: dict[str, DataFrame]) -> str:
            return _as_json(
                enrichment.enrichment_manifest(staged["air_quality_weather"], hours),
                columns=enriched.columns,
                partition_columns=PARTITIONS,
                weather_variables=WEATHER_VARIABLES,
            )

        table = Table(enriched, partition_by=PARTITIONS, order_by=CURATED_ORDER)
        self.store.publish("enriched", {"air_quality_weather": table}, manifest, gate)
        return self.enriched()

    def enriched(self) -> DataFrame:
        rows = read_enriched(self.spark, self.store.path("enriched", "air_quality_weather"), merge=False)
        return require_typed(rows, "enriched input")

    def load(self) -> DataFrame:
        """Full refresh of both tables as one snapshot; returns the summary."""
        locations, observations = warehouse.prepare_load(self.enriched(), self.configured)

        def gate(staged: dict[str, DataFrame], counts: dict[str, int]) -> None:
            warehouse.check_loaded(
                staged["observations"], staged["locations"], counts["observations"], counts["locations"]
            )

        tables = {
            "locations": Table(locations, order_by=("location_id",)),
            "observations": Table(observations, DAY, (*DAY, *KEY)),
        }
        self.store.publish("warehouse", tables, check=gate)
        return warehouse.load_summary(self.observations(), self.locations())

    def observations(self) -> DataFrame:
        rows = self.store.read("warehouse", "observations")
        typed = rows.withColumn("measurement_date_utc", F.col("measurement_date_utc").cast("date"))
        return models.staged_observations(typed)

    def locations(self) -> DataFrame:
        return models.staged_locations(self.store.read("warehouse", "locations"))

    def relations(self) -> dict[str, DataFrame]:
        """Warehouse tables, staging and intermediate views, and the marts."""
        observations, locations = self.observations(), self.locations()
        marts = {name: self.mart(name) for name in MARTS}
        return {
            "locations": locations,
            "observations": observations,
            "stg_locations": locations,
            "stg_observations": observations,
            "int_air_quality_weather": models.fact(observations, locations),
            **marts,
        }

    def mart(self, name: str) -> DataFrame:
        rows = self.store.read("marts", name)
        if "measurement_date_utc" in rows.columns:
            rows = rows.withColumn("measurement_date_utc", F.col("measurement_date_utc").cast("date"))
        return rows

    def model(self) -> None:
        """Materialise fact and marts; publish only if every model test passes."""
        observations, locations = self.observations(), self.locations()
        fact = models.fact(observations, locations)
        tables = {
            "fct_air_quality_observations": Table(fact, DAY, (*DAY, *KEY)),
            "agg_daily_air_quality": Table(models.daily_mart(observations, locations)),
            "agg_location_air_quality": Table(models.location_mart(observations, locations)),
            "agg_pollution_weather": Table(models.weather_mart(observations, locations)),
        }

        def gate(staged: dict[str, DataFrame], counts: dict[str, int]) -> None:
            relations = {
                "locations": locations,
                "observations": observations,
                "stg_locations": locations,
                "stg_observations": observations,
                "int_air_quality_weather": fact,
                **staged,
            }
            failures = failed_tests(relations)
            if failures:
                raise InputError(f"model tests failed: {', '.join(failures)}")

        self.store.publish("marts", tables, check=gate)

    def create_views(self) -> None:
        """Expose every relation to SQL under its model name."""
        for name, rows in self.relations().items():
            rows.createOrReplaceTempView(name)


DAY = ("measurement_date_utc",)
MARTS = (
    "fct_air_quality_observations",
    "agg_daily_air_quality",
    "agg_location_air_quality",
    "agg_pollution_weather",
)


def failed_tests(relations: dict[str, DataFrame]) -> list[str]:
    """Names of the declared tests that do not pass on the relations."""
    generic = expectations.generic_tests(relations).filter("failures > 0")
    failed = [f"{row.model}.{row.column_name}.{row.test}" for row in generic.collect()]
    fact = relations["fct_air_quality_observations"]
    daily = relations["agg_daily_air_quality"]
    by_location = relations["agg_location_air_quality"]
    weather = relations["agg_pollution_weather"]
    singular = {
        "observation_natural_keys_unique": expectations.natural_key_repeats(
            {
                "warehouse": relations["observations"],
                "intermediate": relations["int_air_quality_weather"],
                "fact": fact,
            }
        ),
        "observation_row_counts_match": expectations.row_count_drift(
            relations["observations"],
            relations["stg_observations"],
            relations["int_air_quality_weather"],
            fact,
        ),
        "mart_grains_unique": expectations.grain_repeats(daily, by_location, weather),
        "mart_summary_invariants": expectations.broken_invariants(daily, by_location),
        "weather_mart_matches_fact": expectations.weather_mart_differences(fact, weather),
    }
    return failed + [name for name, violations in singular.items() if not violations.isEmpty()]


def _as_json(one_row: DataFrame, **names) -> str:
    """JSON of one row and of lists of names, with the schema version."""
    lists = [F.array(*map(F.lit, values)).alias(name) for name, values in names.items()]
    row = one_row.select("*", *lists, F.lit(SCHEMA_VERSION).alias("schema_version"))
    return row.select(F.to_json(F.struct("*")).alias("j")).first().j
