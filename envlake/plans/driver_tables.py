"""Observation-shaped inputs derived from the driver tables.

Every rule is arithmetic on the columns of one row, so that the same input can
be written down independently in SQL. Faults are planted by ``event_id``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.domain import (
    OBSERVATION_COLUMNS,
    RUN_STAGES,
    SOURCE,
    WAREHOUSE_COLUMNS,
    WEATHER_METRICS,
    WEATHER_SOURCE,
    WEATHER_UNITS,
    WEATHER_VARIABLES,
)
from envlake.operators import acquisition, enrichment, models
from envlake.session import configure
from envlake.sinks.registry import content_hash

# An envelope holds the records of one sensor within one block of event ids, so
# it never exceeds this many records however often a sensor occurs.
ENVELOPE_BLOCK = 20_000
CATALOGUE_PAGE = 4


def divides(divisor: int, column: str = "event_id") -> Column:
    return F.col(column) % divisor == 0


class DriverTables:
    """Lazily built inputs over the parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    # -- observations, weather, locations ---------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        """Events with the numeric property and the derived identifiers."""
        rows = self.read("events").withColumn("ts", F.col("ts").cast("timestamp"))
        location = F.col("user_id") % 25 + 1
        return rows.withColumns(
            {
                "k": F.regexp_extract("props", "[0-9]+", 0).cast("int"),
                "location_id": location,
                "sensor_id": F.col("user_id") + 1,
                "parameter": F.when(
                    F.col("event_type").isin("click", "view", "purchase"), "pm25"
                ).otherwise("pm10"),
                "block": F.floor(F.col("event_id") / ENVELOPE_BLOCK).cast("bigint"),
            }
        )

    @cached_property
    def observations_with_event(self) -> DataFrame:
        """Typed observations beside the event they come from."""
        has_pair = (F.col("k") % 3 != 0) & (F.col("location_id") % 4 != 0)
        is_error = F.col("event_type") == "error"
        end = F.col("ts")
        start = end - F.expr("INTERVAL 1 HOUR")
        local = lambda t: F.concat(
            F.date_format(t + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")
        )
        columns = {
            "source": F.lit(SOURCE),
            "location_id": F.col("location_id"),
            "location_name": F.when(F.col("k") % 7 != 0, self.location_name()),
            "sensor_id": F.col("sensor_id"),
            "parameter": F.col("parameter"),
            "parameter_id": F.when(F.col("k") % 10 != 0, F.lit(2).cast("bigint")),
            "unit": F.when(is_error, "mg/m3").otherwise("ug/m3"),
            "value": F.when(is_error, -F.col("value")).otherwise(F.col("value")),
            "period_label": F.lit("hour"),
            "period_interval": F.lit("01:00:00"),
            "datetime_from_utc": start,
            "datetime_to_utc": end,
            "datetime_from_local": local(start),
            "datetime_to_local": local(end),
            "latitude": F.when(has_pair, latitude_of(F.col("location_id"))),
            "longitude": F.when(has_pair, longitude_of(F.col("location_id"))),
            "source_file": envelope_path(0),
            "retrieval_datetime_from": window_text(F.col("block")),
            "retrieval_datetime_to": window_text(F.col("block") + 1),
        }
        return self.events.select(
            "event_id",
            "k",
            "event_type",
            "block",
            *(columns[name].alias(name) for name in OBSERVATION_COLUMNS),
            F.to_date(end).alias("measurement_date_utc"),
        )

    @staticmethod
    def location_name() -> Column:
        return F.concat(F.lit("NATION_"), (F.col("location_id") - 1).cast("string"))

    @cached_property
    def observations(self) -> DataFrame:
        """Curated observations."""
        return self.observations_with_event.drop("event_id", "k", "event_type", "block")

    @cached_property
    def hours(self) -> DataFrame:
        """Weather hours of the locations that had views or clicks."""
        seen = (
            self.events.filter(F.col("event_type").isin("view", "click"))
            .select("location_id", F.date_trunc("HOUR", "ts").alias("weather_hour_utc"))
            .distinct()
        )
        h = F.hour("weather_hour_utc")
        known = h % 11 != 0
        metrics = {
            "temperature_2m_c": (F.col("location_id") * 7 + h) % 30,
            "relative_humidity_2m_pct": (F.col("location_id") * 3 + h) % 100,
            "precipitation_mm": F.when(h % 5 != 0, h % 4),
            "wind_speed_10m_kmh": h % 20,
        }
        return seen.select(
            "location_id",
            "weather_hour_utc",
            *(F.when(known, metrics[m]).cast("double").alias(m) for m in WEATHER_METRICS),
            F.lit(WEATHER_SOURCE).alias("weather_source"),
            latitude_of(F.col("location_id")).alias("weather_latitude"),
            longitude_of(F.col("location_id")).alias("weather_longitude"),
        )

    @cached_property
    def enriched(self) -> DataFrame:
        return enrichment.join_weather(self.observations, self.hours)

    @cached_property
    def warehouse_observations(self) -> DataFrame:
        return self.enriched.select(*WAREHOUSE_COLUMNS)

    @cached_property
    def configured(self) -> DataFrame:
        """Location configuration; every fifth location lacks coordinates."""
        nation = self.read("nation").withColumn(
            "location_id", (F.col("n_nationkey") + 1).cast("bigint")
        )
        known = F.col("location_id") % 5 != 0
        return nation.select(
            F.col("location_id").alias("id"),
            F.col("n_name").alias("name"),
            F.when(known, latitude_of(F.col("location_id"))).alias("latitude"),
            F.when(known, longitude_of(F.col("location_id"))).alias("longitude"),
        )

    @cached_property
    def locations(self) -> DataFrame:
        """Warehouse locations; a few have no name."""
        rows = self.configured
        return rows.select(
            F.col("id").alias("location_id"),
            F.when(F.col("id") % 9 != 0, F.col("name")).alias("location_name"),
            "latitude",
            "longitude",
            latitude_of(F.col("id")).alias("weather_latitude"),
            longitude_of(F.col("id")).alias("weather_longitude"),
        )

    @cached_property
    def fact(self) -> DataFrame:
        return models.fact(self.warehouse_observations, self.locations)

    @cached_property
    def daily(self) -> DataFrame:
        return models.daily_mart(self.warehouse_observations, self.locations)

    @cached_property
    def by_location(self) -> DataFrame:
        return models.location_mart(self.warehouse_observations, self.locations)

    @cached_property
    def weather(self) -> DataFrame:
        return models.weather_mart(self.warehouse_observations, self.locations)

    # -- raw envelopes -----------------------------------------------------------

    def _record_text(self, nanoseconds: bool = True) -> Column:
        """Measurement JSON of a row, with the planted faults."""
        start, end = F.col("datetime_from_utc"), F.col("datetime_to_utc")
        other = F.when(F.col("parameter") == "pm25", "pm10").otherwise("pm25")
        name = (
            F.when(divides(83), "no2")
            .when(divides(61), other)
            .when(F.col("event_id") % 10 == 3, F.concat(F.lit(" "), F.upper("parameter"), F.lit(" ")))
            .otherwise(F.col("parameter"))
        )
        nanos = F.when(divides(11) & F.lit(nanoseconds), "123").otherwise("")
        shifted = (F.col("event_id") % 10 == 7) | F.col("offset_spelling")

        def utc(t: Column) -> Column:
            zulu = F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), nanos)
            plus2 = F.concat(
                F.date_format(t + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), nanos
            )
            return F.when(shifted, F.concat(plus2, F.lit("+02:00"))).otherwise(
                F.concat(zulu, F.lit("Z"))
            )

        from_text = F.when(
            divides(79), F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss")
        ).otherwise(utc(start))
        to_text = F.when(divides(73), utc(start)).otherwise(utc(end))
        number = (F.col("value") + F.col("value_shift")).cast("string")
        return F.concat(
            F.lit('{"value":'),
            F.when(divides(97), F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number),
            F.lit(',"parameter":{"id":'),
            F.when(divides(59), "false").otherwise(
                F.coalesce(F.col("parameter_id").cast("string"), F.lit("null"))
            ),
            F.lit(',"name":"'),
            name,
            F.lit('","units":"'),
            F.when(divides(89), " ").otherwise(F.col("unit")),
            F.lit('"},"period":{"label":'),
            F.when(divides(53), "1").otherwise('"hour"'),
            F.lit(',"interval":"01:00:00","datetimeFrom":{"utc":"'),
            from_text,
            F.lit('","local":"'),
            F.col("datetime_from_local"),
            F.lit('"},"datetimeTo":{"utc":"'),
            to_text,
            F.lit('","local":"'),
            F.col("datetime_to_local"),
            F.lit('"}},"coordinates":'),
            F.when(divides(71), '"unknown"')
            .when(divides(47), '{"latitude":"x","longitude":1}')
            .when(F.col("latitude").isNull(), "null")
            .otherwise(
                F.concat(
                    F.lit('{"latitude":'),
                    F.col("latitude").cast("string"),
                    F.lit(',"longitude":'),
                    F.col("longitude").cast("string"),
                    F.lit("}"),
                )
            ),
            F.lit(',"flagInfo":{"hasFlags":false}}'),
        )

    def envelopes(self, *, conflicts: bool = False, nanoseconds: bool = True) -> DataFrame:
        """(path, content) of landed envelopes."""
        # Every event is in batch 0. Every fiftieth arrives again in batch 1, spelled
        # with an offset; on request some come back in batch 2 with another value.
        batches = F.array(
            F.lit(0),
            F.when(divides(50), F.lit(1)),
            F.when(divides(67) & F.lit(conflicts), F.lit(2)),
        )
        rows = self.observations_with_event.withColumn(
            "batch", F.explode(F.array_compact(batches))
        ).withColumns(
            {
                "offset_spelling": F.col("batch") == 1,
                "value_shift": F.when(F.col("batch") == 2, 1.0).otherwise(0.0),
            }
        )
        grouped = (
            rows.withColumn("t", self._record_text(nanoseconds))
            .select("location_id", "sensor_id", "parameter", "block", "batch", "event_id", "t")
            .groupBy("location_id", "sensor_id", "parameter", "block", "batch")
            .agg(F.array_sort(F.collect_list(F.struct("event_id", "t"))).alias("records"))
        )
        retrieval = F.to_json(
            F.struct(
                "location_id",
                self.location_name().alias("location_name"),
                "sensor_id",
                "parameter",
                window_text(F.col("block")).alias("datetime_from"),
                window_text(F.col("block") + 1 + F.col("batch")).alias("datetime_to"),
                F.size("records").alias("returned"),
                F.lit(True).alias("complete"),
            )
        )
        content = F.concat(
            F.lit(f'{{"source":"{SOURCE}","resource":"measurements","schema_version":1,"retrieval":'),
            retrieval,
            F.lit(',"source_meta":null,"measurements":['),
            F.array_join("records.t", ","),
            F.lit("]}"),
        )
        return grouped.select(envelope_path(F.col("batch")).alias("path"), content.alias("content"))

    def weather_files(self, *, faults: bool = True) -> DataFrame:
        """(path, content) of weather responses per location and day, some broken unless asked otherwise.

        The day number decides the fault; each file holds at most 25 hours.
        """
        rows = self.hours.withColumn("day", F.to_date("weather_hour_utc"))
        item = F.struct(
            "weather_hour_utc",
            F.date_format("weather_hour_utc", "yyyy-MM-dd'T'HH:mm").alias("t"),
            *(F.coalesce(F.col(m).cast("string"), F.lit("null")).alias(m) for m in WEATHER_METRICS),
        )
        grouped = rows.groupBy("location_id", "day").agg(F.array_sort(F.collect_list(item)).alias("h"))
        fault = (F.dayofmonth("day") + F.col("location_id")) % 23 if faults else F.lit(0)
        times = F.transform("h.t", lambda t: F.concat(F.lit('"'), t, F.lit('"')))
        times = (
            F.when(fault == 3, F.concat(times, F.slice(times, 1, 1)))
            .when(fault == 4, F.transform(times, lambda t: F.replace(t, F.lit(':00"'), F.lit(':30"'))))
            .otherwise(times)
        )

        def values(metric: str, bad: Column | None = None, value: str = "-1.0") -> Column:
            base = F.col(f"h.{metric}")
            base = F.when(fault == 3, F.concat(base, F.slice(base, 1, 1))).otherwise(base)
            return base if bad is None else F.when(bad, F.transform(base, lambda _: F.lit(value))).otherwise(base)

        series = {
            "temperature_2m": values("temperature_2m_c", fault == 5, '"warm"'),
            "relative_humidity_2m": values("relative_humidity_2m_pct", fault == 6, "150.0"),
            "precipitation": values("precipitation_mm", fault == 7),
            "wind_speed_10m": values("wind_speed_10m_kmh", fault == 8),
        }
        series["wind_speed_10m"] = F.when(
            fault == 9, F.concat(series["wind_speed_10m"], F.array(F.lit("1.0")))
        ).otherwise(series["wind_speed_10m"])
        arrays = [F.lit('"time":['), F.array_join(times, ","), F.lit("]")]
        for name in WEATHER_VARIABLES:
            arrays += [F.lit(f',"{name}":['), F.array_join(series[name], ","), F.lit("]")]
        units = ",".join(
            f'"{name}":"{unit}"' for name, unit in zip(WEATHER_VARIABLES, WEATHER_UNITS, strict=True)
        )
        day = F.date_format("day", "yyyy-MM-dd")
        arrays[-3 * len(WEATHER_VARIABLES)] = F.when(fault == 13, F.lit(',"other":[')).otherwise(arrays[-3 * len(WEATHER_VARIABLES)])
        content = F.concat(
            F.lit(f'{{"schema_version":1,"source":"{WEATHER_SOURCE}","request":{{"location_id":'),
            F.col("location_id").cast("string"),
            F.lit(',"latitude":'),
            latitude_of(F.col("location_id")).cast("string"),
            F.lit(',"longitude":'),
            longitude_of(F.col("location_id")).cast("string"),
            F.lit(',"start_date":"'),
            day,
            F.lit('","end_date":"'),
            day,
            F.lit('"},"response":{'),
            F.when(fault == 12, '"error":true,').otherwise(""),
            F.lit('"latitude":'),
            F.when(fault == 10, "95.0").otherwise(latitude_of(F.col("location_id")).cast("string")),
            F.lit(',"longitude":'),
            longitude_of(F.col("location_id")).cast("string"),
            F.lit(',"utc_offset_seconds":'),
            F.when(fault == 1, "7200").otherwise("0"),
            F.lit(',"timezone":"GMT","hourly_units":{"time":"iso8601",'),
            F.when(fault == 2, units.replace("mm", "inch")).otherwise(units),
            F.lit('},"hourly":{'),
            *arrays,
            F.when(fault == 11, "}}").otherwise("}}}"),
        )
        path = F.concat(
            F.lit("open_meteo/hourly/location_id="), F.col("location_id").cast("string"), F.lit("/"), day
        )
        return grouped.select(path.alias("path"), content.alias("content"))

    # -- text rows with contract faults --------------------------------------------

    def text_rows(self) -> DataFrame:
        """Processed rows as text, as a CSV export holds them, with faults."""
        rows = self.observations_with_event
        zoned = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'")
        start, end = F.col("datetime_from_utc"), F.col("datetime_to_utc")
        faulty = {
            "source": F.when(divides(89), "other").otherwise(F.col("source")),
            "parameter": F.when(divides(83), "no2").otherwise(F.col("parameter")),
            "unit": F.when(divides(97), " ").otherwise(F.col("unit")),
            "location_id": F.when(divides(79), "-1").otherwise(F.col("location_id").cast("string")),
            "sensor_id": F.when(divides(73), "9223372036854775808").otherwise(
                F.col("sensor_id").cast("string")
            ),
            "parameter_id": F.when(divides(71), "2.0").otherwise(F.col("parameter_id").cast("string")),
            "value": F.when(divides(67), "nan").otherwise(F.col("value").cast("string")),
            "latitude": F.when(divides(61), "abc").otherwise(F.col("latitude").cast("string")),
            "longitude": F.when(divides(59), "1e400").otherwise(F.col("longitude").cast("string")),
            "datetime_from_utc": F.when(divides(53), F.date_format(start, "yyyy-MM-dd HH:mm:ss"))
            .when(divides(43), zoned(end))
            .otherwise(zoned(start)),
            "datetime_to_utc": F.when(~divides(47), zoned(end)),
            "measurement_date_utc": F.when(divides(41), "1999-01-01").otherwise(
                F.date_format("measurement_date_utc", "yyyy-MM-dd")
            ),
        }
        return rows.select(
            *(faulty.get(name, F.col(name)).alias(name) for name in OBSERVATION_COLUMNS),
            faulty["measurement_date_utc"].alias("measurement_date_utc"),
        )

    def faulty_enriched(self) -> DataFrame:
        """Enriched rows with faults of the warehouse contract."""
        rows = enrichment.join_weather(self.observations_with_event, self.hours)
        one_day = F.expr("INTERVAL 1 DAY")
        matched = F.col("weather_source").isNotNull()
        return rows.withColumns(
            {
                "unit": F.when(divides(89), " ").otherwise(F.col("unit")),
                "parameter": F.when(divides(83), "no2").otherwise(F.col("parameter")),
                "latitude": F.when(divides(79), 95.0).otherwise(F.col("latitude")),
                "datetime_from_utc": F.when(divides(73), F.col("datetime_to_utc")).otherwise(
                    F.col("datetime_from_utc")
                ),
                "measurement_date_utc": F.when(
                    divides(71), F.to_date(F.col("datetime_to_utc") + one_day)
                ).otherwise(F.col("measurement_date_utc")),
                "weather_hour_utc": F.when(
                    divides(67), F.col("weather_hour_utc") + F.expr("INTERVAL 1 HOUR")
                ).otherwise(F.col("weather_hour_utc")),
                "weather_source": F.when(matched & divides(61), "other").otherwise(
                    F.col("weather_source")
                ),
                "source": F.when(~divides(59), F.col("source")),
                "temperature_2m_c": F.when(~matched & divides(53), 1.0).otherwise(
                    F.col("temperature_2m_c")
                ),
                "value": F.when(divides(47), F.lit(float("nan"))).otherwise(F.col("value")),
                "location_name": F.when(divides(43), "RENAMED").otherwise(F.col("location_name")),
            }
        )

    def drifted_enriched(self) -> dict[str, list[DataFrame]]:
        """Enriched files per folder: some lack columns, one folder stores other types."""
        rows = enrichment.join_weather(self.observations_with_event, self.hours).drop("k", "event_type", "block")
        third = F.col("event_id") % 3
        whole, drifted, slim = (rows.filter(third == n) for n in (2, 1, 0))
        stored = {
            "location_id": F.when(divides(61), F.col("location_id").cast("double")),
            "sensor_id": F.col("sensor_id").cast("int"),
            "parameter_id": F.when(divides(47), "2"),
            "unit": F.when(divides(43), F.length("unit")),
            "datetime_to_utc": F.when(divides(71), F.date_format("datetime_to_utc", "yyyy-MM-dd HH:mm:ss")),
            "measurement_date_utc": F.when(divides(41), "31 December").otherwise(F.date_format("measurement_date_utc", "yyyy-MM-dd")),
            "latitude": F.when(divides(67), F.lit(True)),
            "weather_hour_utc": F.when(divides(59), F.unix_micros("datetime_from_utc")),
            "temperature_2m_c": F.when(divides(53), "warm"),
        }
        return {
            "named": [whole, slim.drop("parameter_id", "period_label", "period_interval")],
            "other": [drifted.withColumns(stored)],
        }

    # -- acquisition tables ----------------------------------------------------------

    def sensors(self) -> DataFrame:
        """Distinct sensors; some locations lack a required parameter."""
        parameter = (
            F.when(F.col("location_id") % 6 == 0, "no2")
            .when(F.col("location_id") % 4 == 0, "pm25")
            .otherwise(F.col("parameter"))
        )
        return self.events.select("location_id", "sensor_id", parameter.alias("parameter")).distinct()

    def pages(self) -> DataFrame:
        """Page sequences of five pages per run, with faults by run; some page numbers are none."""
        key = F.col("o_orderkey")
        run, page = F.floor(key / 5).cast("bigint"), key % 5 + 1
        rows = self.read("orders").select(run.alias("run_id"), page.alias("page"))
        run, page = F.col("run_id"), F.col("page")
        number = (
            F.when((run % 41 == 0) & (page == 1), F.lit(0))
            .when((run % 43 == 0) & (page == 5), F.lit(acquisition.MAX_PAGES + 1))
            .when(~((run % 47 == 0) & (page == 2)), page)
        )
        tail = run % 1000
        last = page == 5
        total = F.when(run % 17 == 0, tail + 4001).otherwise(tail + 4000)
        return rows.select(
            F.lit("measurements").alias("resource"),
            "run_id",
            number.cast("bigint").alias("page"),
            (~((run % 19 == 0) & (page == 3))).alias("results_ok"),
            F.when((run % 23 == 0) & (page == 2), "7").otherwise(page.cast("string")).alias("meta_page"),
            F.when((run % 29 == 0) & (page == 4), "500").otherwise("1000").alias("meta_limit"),
            F.when(run % 3 != 0, F.when((run % 31 == 0) & (page == 3), "1").otherwise(total.cast("string")))
            .alias("meta_found"),
            F.when(last, tail).otherwise(1000).cast("bigint").alias("returned"),
            F.when((run % 37 == 0) & (page == 3), F.concat(run.cast("string"), F.lit("-2")))
            .otherwise(F.concat_ws("-", run.cast("string"), page.cast("string")))
            .alias("content_hash"),
        )

    def catalogue_pages(self) -> DataFrame:
        """(path, content) of catalogue pages of a few locations each."""
        supplier = self.read("supplier")
        names = F.array(F.lit("pm25"), F.lit("pm10"), F.lit("no2"), F.lit(""))
        pick = lambda n: F.element_at(names, ((F.col("s_suppkey") + n) % 4 + 1).cast("int"))
        sensors = F.array(*(F.struct(F.struct(pick(n).alias("name")).alias("parameter")) for n in (0, 1, 0, 3)))
        item = F.to_json(
            F.struct(
                F.col("s_suppkey").alias("id"),
                F.col("s_name").alias("name"),
                F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("AREA_"), F.col("s_nationkey")))
                .alias("locality"),
                F.struct(F.lit("ZA").alias("code")).alias("country"),
                F.when(
                    F.col("s_suppkey") % 4 != 0,
                    F.struct(
                        latitude_of(F.col("s_nationkey")).alias("latitude"),
                        longitude_of(F.col("s_nationkey")).alias("longitude"),
                    ),
                ).alias("coordinates"),
                F.when(F.col("s_suppkey") % 5 != 0, F.struct(F.lit("agency").alias("name")))
                .alias("provider"),
                F.struct(F.concat(F.lit("OWNER_"), F.col("s_nationkey")).alias("name")).alias("owner"),
                (F.col("s_suppkey") % 2 == 0).alias("isMobile"),
                F.lit(True).alias("isMonitor"),
                F.when(F.col("s_suppkey") % 7 != 0, sensors).alias("sensors"),
            )
        )
        page = F.floor(F.col("s_suppkey") / CATALOGUE_PAGE)
        pages = supplier.groupBy(page.alias("page")).agg(
            F.array_sort(F.collect_list(F.struct("s_suppkey", item.alias("t")))).alias("r")
        )
        content = F.concat(F.lit('{"meta":{"found":">1000"},"results":['), F.array_join("r.t", ","), F.lit("]}"))
        return pages.select(F.col("page").cast("string").alias("path"), content.alias("content"))

    def window_requests(self) -> DataFrame:
        """Run requests from orders, some of them invalid."""
        key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        historical = key % 2 == 0
        later = F.date_add(F.to_date(day), (F.col("o_custkey") % 4 - 1).cast("int"))
        iso = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")
        hours = F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 4 - 1).cast("int"))
        return self.read("orders").select(
            F.col("o_orderkey").alias("request_id"),
            F.when(key % 41 == 0, "weekly").when(historical, "historical").otherwise("incremental")
            .alias("run_mode"),
            F.when(historical | (key % 37 == 0), F.date_format(day, "yyyy-MM-dd")).alias("date_from"),
            F.when(
                historical,
                F.when(key % 13 == 0, "1998-1-1").otherwise(F.date_format(later, "yyyy-MM-dd")),
            ).alias("date_to"),
            F.when(
                ~historical,
                F.when(key % 11 == 0, iso).otherwise(F.concat(iso, F.lit("+02:00"))),
            ).alias("checkpoint"),
            F.when(
                ~historical, F.concat(F.date_format(day + hours, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
            ).alias("datetime_to"),
            F.when(key % 7 == 0, key % 3 - 1).alias("location_id"),
        )

    def responses(self) -> DataFrame:
        """Sensor responses from orders: totals in every spelling."""
        key = F.col("o_orderkey")
        found = (
            F.when(key % 4 == 0, (F.col("o_custkey") % 60).cast("string"))
            .when(key % 4 == 2, ">1000")
            .when(key % 4 == 3, " 25 ")
        )
        return self.read("orders").select(
            F.col("o_orderkey").alias("response_id"),
            found.alias("found"),
            (F.col("o_custkey") % 50).alias("returned"),
            F.when(F.col("o_custkey") % 5 == 0, True).alias("pagination_complete"),
        )

    def checkpoint_runs(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Runs per customer; locations and sensors per order."""
        runs = self.read("customer").select(
            F.col("c_custkey").alias("run_id"),
            F.lit("2024-01-01T00:00:00Z").alias("datetime_to"),
        )
        orders = self.read("orders")
        key = F.col("o_orderkey")
        missing = F.when(key % 11 == 0, F.array(F.lit("pm10"))).otherwise(
            F.array().cast("array<string>")
        )
        locations = orders.select(
            F.col("o_custkey").alias("run_id"),
            key.alias("location_id"),
            missing.alias("missing_parameters"),
            F.when(key % 13 == 0, True).when(key % 17 != 0, False).alias("discovery_incomplete"),
        )
        sensors = orders.select(
            F.col("o_custkey").alias("run_id"),
            (key * 10).alias("sensor_id"),
            F.when(key % 19 == 0, True).when(key % 23 != 0, False).alias("incomplete"),
        )
        return runs, locations, sensors

    def sensor_results(self) -> DataFrame:
        """Sensor results per line item."""
        line = F.col("l_linenumber")
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("run_id"),
            F.when(line % 2 == 0, "pm25").otherwise("pm10").alias("parameter"),
            F.when(F.col("l_discount") == 0, 0).otherwise(F.col("l_quantity")).cast("bigint").alias("returned"),
            F.when(line % 3 == 0, True).when(line % 3 == 1, False).alias("incomplete"),
        )

    def registry_input(self) -> tuple[DataFrame, DataFrame]:
        """Incoming batches (two orders share a path) and a part already known."""
        orders = self.read("orders")
        key = F.col("o_orderkey")
        pair = F.floor(key / 2).cast("bigint")
        path = F.concat(F.lit("batch/"), pair.cast("string"))
        changed = F.when((key % 2 == 1) & (pair % 13 == 0), 1).otherwise(0)
        incoming = orders.select(
            path.alias("path"),
            content_hash(
                F.concat(
                    F.lit('{"shift":'), changed.cast("string"), F.lit('.0,"pair":'), pair.cast("string"), F.lit("}")
                )
            ).alias("content_hash"),
            (F.col("o_custkey") % 100).alias("returned"),
        )
        stored = F.when(pair % 11 == 0, 9).otherwise(0)
        # Two runs have registered every fifth pair; for some the digests differ.
        runs = F.when(pair % 5 == 0, F.array(stored, F.when(pair % 15 == 0, stored).otherwise(7))).otherwise(F.array(stored))
        known = (
            orders.filter((key % 2 == 0) & ((pair % 3 == 0) | (pair % 5 == 0)))
            .select(path.alias("path"), pair.alias("pair"), F.explode(runs).alias("shift"))
            .select(
                "path",
                content_hash(
                    F.concat(F.lit('{"pair": '), F.col("pair").cast("string"), F.lit(', "shift": '), F.col("shift").cast("string"), F.lit("}"))
                ).alias("content_hash"),
            )
        )
        return incoming, known

    def raw_batches(self, run: int) -> DataFrame:
        """Batches of one of two runs; every third order is in both, its numbers spelled in two ways."""
        orders = self.read("orders").filter(F.col("o_orderkey") % 3 != 2 * (1 - run))
        key = F.col("o_orderkey")
        record = F.lit('{"value":1}' if run else '{"value":1.0}')
        returned = (key % 4).cast("bigint")
        return orders.select(
            (F.col("o_custkey") % 25 + 1).cast("bigint").alias("location_id"),
            F.lit(None).cast("string").alias("location_name"),
            (key + 1).cast("bigint").alias("sensor_id"),
            F.lit("pm25").alias("parameter"),
            F.lit("2024-01-01").alias("datetime_from"),
            F.lit("2024-01-02").alias("datetime_to"),
            returned.alias("returned"),
            returned.cast("string").alias("found"),
            F.lit(False).alias("incomplete"),
            F.lit(True).alias("pagination_complete"),
            F.lit(None).cast("string").alias("source_meta"),
            F.concat(F.lit("["), F.array_join(F.array_repeat(record, returned.cast("int")), ","), F.lit("]")).alias("measurements"),
        )

    # -- questions and run events ------------------------------------------------------

    def questions(self) -> DataFrame:
        """User messages with a planted request and location name."""
        pick = ((F.col("conv_id") * 3 + F.col("turn")) % len(REQUESTS)).cast("int")
        request = F.element_at(F.array(*map(F.lit, REQUESTS)), pick + 1)
        street = F.when(F.col("conv_id") % 2 == 0, " STRASSE").when(F.col("conv_id") % 5 == 0, " AFFIX").otherwise("")
        place = F.concat(F.lit(" at Nation_"), (F.col("conv_id") % 40).cast("string"), street)
        return (
            self.read("conversations")
            .filter("role = 'user'")
            .select(
                (F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"),
                F.concat(
                    F.col("text"), F.lit(" "), request, F.when(F.col("conv_id") % 3 != 0, place).otherwise("")
                ).alias("text"),
            )
        )

    def places(self) -> DataFrame:
        """Locations, some with a sharp s or a ligature in their names."""
        number, name = F.col("location_id") % 3, F.col("location_name")
        spelled = F.when(number == 0, F.concat(name, F.lit(" Straße"))).when(number == 1, F.concat(name, F.lit(" Aﬃx")))
        return self.locations.withColumn("location_name", F.coalesce(spelled, name))

    def run_events(self) -> DataFrame:
        """Run events, one run per user."""
        kinds = {"signup": "start", "view": "stage", "click": "count", "purchase": "succeed", "error": "fail"}
        kind = F.coalesce(*(F.when(F.col("event_type") == e, k) for e, k in kinds.items()))
        stage = F.element_at(F.array(*map(F.lit, RUN_STAGES)), F.col("k") % 7 + 1)
        starts = F.col("event_type") == "signup"
        historical = F.col("k") % 2 == 0
        return self.events.select(
            F.lit("daily").alias("dag_id"),
            F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
            F.col("event_id").alias("seq"),
            F.col("ts").alias("at"),
            kind.alias("kind"),
            F.when(kind == "stage", stage).when((kind == "fail") & (F.col("k") % 3 == 0), stage).alias("stage"),
            F.when(kind == "count", F.col("k").cast("bigint")).alias("observations"),
            F.when(starts, F.when(historical, "historical").otherwise("incremental")).alias("run_mode"),
            F.when(
                starts, F.when(historical, "2024-01-01").otherwise("2024-01-01T06:00:00+02:00")
            ).alias("requested_start"),
            F.when(
                starts, F.when(historical, "2024-01-02").otherwise("2024-01-01T06:00:00Z")
            ).alias("requested_end"),
            F.when(starts & (F.col("k") % 5 == 0), F.col("location_id")).alias("location_id"),
        )


REQUESTS = (
    "How recent are these observations?",
    "Which station has the highest recorded average PM10?",
    "Show the PM 2.5 trend",
    "Is the pipeline refresh healthy? Give the latest summary",
    "Compare locations for pm2.5 and pm10",
    "PM10 and wind over time",
    "List the stations",
    "Thanks!",
)


def latitude_of(location: Column) -> Column:
    return F.lit(-35.0) + location * F.lit(0.25)


def longitude_of(location: Column) -> Column:
    return F.lit(16.0) + location * F.lit(0.5)


def window_text(minute: Column) -> Column:
    """Instant text of a window boundary: minutes after the start of 2020."""
    return F.date_format(
        F.timestamp_seconds(F.lit(1577836800) + minute * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )


def envelope_path(batch: Column | int) -> Column:
    """Path of the envelope of a sensor, block and batch."""
    batch = F.lit(batch) if isinstance(batch, int) else batch
    return acquisition.batch_path(
        F.col("location_id"),
        F.col("parameter"),
        F.col("sensor_id"),
        window_text(F.col("block")),
        window_text(F.col("block") + 1 + batch),
    )
