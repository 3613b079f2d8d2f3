"""Text export of processed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from envlake.domain import OBSERVATION_COLUMNS, PROCESSED_ORDER

RANGE_ROWS = 100_000


def instant_text(instant: Column, nanoseconds: Column) -> Column:
    """Zoned text that keeps the nanosecond remainder."""
    base = F.date_format(instant, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(instant, "SSSSSS")
    nanos = F.lpad(nanoseconds.cast("string"), 3, "0")
    fraction = F.when(nanoseconds != 0, F.concat(F.lit("."), micros, nanos)).when(
        micros != "000000", F.concat(F.lit("."), micros)
    )
    return F.concat(base, F.coalesce(fraction, F.lit("")), F.lit("+00:00"))


def write_processed_csv(processed: DataFrame, path: str) -> None:
    """Processed rows as CSV parts in processed order, empty fields for nulls.

    The order holds across parts: a range sort, not one big file.
    """
    text = processed.withColumns(
        {
            "datetime_from_text": instant_text(F.col("datetime_from_utc"), F.col("datetime_from_ns")),
            "datetime_to_text": instant_text(F.col("datetime_to_utc"), F.col("datetime_to_ns")),
        }
    ).orderBy(*PROCESSED_ORDER)
    columns = {"datetime_from_utc": "datetime_from_text", "datetime_to_utc": "datetime_to_text"}
    text.select(*(F.col(columns.get(name, name)).alias(name) for name in OBSERVATION_COLUMNS)).write.csv(
        path, header=True, quote='"', escape='"', nullValue="", mode="errorifexists"
    )


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Exported rows as text with ``place``, the place of the row over all parts in file order.

    Parts are ordered by the number in their name. Rows are numbered within a block of a
    file, and the rows before a block come from one count per block. Texts with line
    breaks are not read, because such files cannot be split.
    """
    rows = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', nullValue="", emptyValue="")
    number = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("bigint")
    placed = rows.select(
        "*",
        number.alias("_part"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    block = ("_part", "_block")
    counts = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*block, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    in_block = F.row_number().over(Window.partitionBy(*block).orderBy("_at"))
    numbered = placed.withColumn("_in_block", in_block).join(starts, [*block])
    return numbered.select(*rows.columns, (F.col("_start") + F.col("_in_block") - 1).alias("place"))


def out_of_order(ordered: DataFrame) -> DataFrame:
    """Places of exported rows whose key is below that of the row before, across parts too.

    The rows are cut into ranges of places; each range also takes the last row before it.
    """
    key = F.struct(*(F.col(name).cast("bigint") if name in ("location_id", "sensor_id") else F.col(name) for name in PROCESSED_ORDER))
    ranges = F.floor(F.col("place") / RANGE_ROWS)
    carried = F.when(F.col("place") % RANGE_ROWS == RANGE_ROWS - 1, F.array(ranges, ranges + 1)).otherwise(F.array(ranges))
    cut = ordered.select("place", key.alias("key"), ranges.alias("own"), F.explode(carried).alias("range"))
    before = F.lag("key").over(Window.partitionBy("range").orderBy("place"))
    return cut.withColumn("before", before).filter("before > key AND own = range").select("place")
