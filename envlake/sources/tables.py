"""Typed readers for processed text files and published Parquet."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.domain import (
    NANO_COLUMNS,
    OBSERVATION_COLUMNS,
    REQUIRED_COLUMNS,
    WAREHOUSE_COLUMNS,
    WEATHER_COLUMNS,
    column_type,
)
from envlake.errors import InputError
from envlake.functions import instants

CAST_ERROR = "cast_error"
WHOLE = ("tinyint", "smallint", "int", "bigint")


def read_processed_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Every column as text; only an empty field is null, literal NA stays text.

    Quoted line breaks need ``multiline``, which reads a file in one task; large
    exports without them should pass False so that files are split.
    """
    rows = spark.read.csv(
        path,
        header=True,
        inferSchema=False,
        quote='"',
        escape='"',
        nullValue="",
        emptyValue="",
        multiLine=multiline,
    )
    return rows.select(*(F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns))


def require_columns(rows: DataFrame, required: set[str], stage: str) -> None:
    missing = required - set(rows.columns)
    if missing:
        raise InputError(f"{stage}: missing required columns: {', '.join(sorted(missing))}")


def read_observations(spark: SparkSession, *paths: str, merge: bool = True) -> DataFrame:
    """Curated observations of model types, and ``cast_error``."""
    required = {*REQUIRED_COLUMNS, "measurement_date_utc"}
    return read_typed(spark, paths, required, "curated input", merge=merge)


def read_enriched(spark: SparkSession, *paths: str, merge: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """Warehouse columns of weather-enriched files, ``extra`` ones as they are, and ``cast_error``."""
    required = {*REQUIRED_COLUMNS, *WEATHER_COLUMNS, "measurement_date_utc"}
    rows = read_typed(spark, paths, required, "enriched input", merge=merge, extra=extra)
    return with_warehouse_columns(rows, (*extra, CAST_ERROR))


def read_typed(
    spark: SparkSession,
    paths: Sequence[str],
    required: set[str],
    stage: str,
    merge: bool = True,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Model columns of one or more Parquet folders, put together by name.

    A column that a file or folder lacks is null there. Folders may store a column in
    different types; within a folder the files must agree. ``merge`` reads the footer of
    every file and is needed only where files of a folder hold different columns.
    """
    parts = [typed_cells(_scan(spark, path, merge), extra) for path in paths]
    rows = functools.reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    require_columns(rows, required, stage)
    return rows


def _scan(spark: SparkSession, path: str, merge: bool) -> DataFrame:
    """Parquet files whose partition values come back as the text of the path."""
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    # The layout of the folder is looked at here; later reads keep what was found.
    spark.conf.set(inference, "false")
    try:
        return spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    finally:
        spark.conf.set(inference, before)


def typed_cells(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Model columns in model types, and ``cast_error``, the first column whose cell has no value of its type.

    Whole numbers of any width are identifiers, whole numbers and floats are measures, and
    ISO text is a date. Any other stored type is a fault of every cell that is not null;
    the cell is null then. A column in its model type costs nothing.
    """
    types = dict(rows.dtypes)
    model = [name for name in (*dict.fromkeys((*WAREHOUSE_COLUMNS, *OBSERVATION_COLUMNS)), *NANO_COLUMNS) if name in types]
    cells = {name: _cell(name, types[name]) for name in model if types[name] != column_type(name)}
    faults = [F.when(F.col(name).isNotNull() & cell.isNull(), F.lit(name)) for name, cell in cells.items()]
    error = F.coalesce(*faults) if faults else F.lit(None).cast("string")
    in_order = [name for name in rows.columns if name in model]
    return rows.select(
        *(cells.get(name, F.col(name)).alias(name) for name in in_order), *extra, error.alias(CAST_ERROR)
    )


def _cell(name: str, stored: str) -> Column:
    """Value of a cell in the type of its model column; null where it has none."""
    wanted = column_type(name)
    whole = stored in WHOLE or (stored.startswith("decimal") and stored.endswith(",0)"))
    if wanted in ("bigint", "smallint") and whole or wanted == "double" and (stored in WHOLE or stored == "float"):
        return F.col(name).try_cast(wanted)
    if wanted == "date" and stored == "string":
        return instants.parse_date(F.col(name))
    return F.lit(None).cast(wanted)


def require_typed(rows: DataFrame, stage: str) -> DataFrame:
    """The rows without ``cast_error``; refuses the first column with a cell of another type."""
    broken = rows.groupBy(CAST_ERROR).agg(F.count(F.lit(1)).alias("n")).filter(F.col(CAST_ERROR).isNotNull())
    first = broken.orderBy(CAST_ERROR).first()
    if first is not None:
        raise InputError(f"{stage}: {first.n} values of another type, first in column {first[CAST_ERROR]}")
    return rows.drop(CAST_ERROR)


def with_warehouse_columns(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Exactly the warehouse columns plus the nanosecond remainders, in order, and ``extra``."""
    present = set(rows.columns)

    def column(name: str):
        found = F.col(name) if name in present else F.lit(None)
        return found.cast(column_type(name)).alias(name)

    nanos = [name for name in NANO_COLUMNS if name in present]
    return rows.select(*map(column, WAREHOUSE_COLUMNS), *map(column, nanos), *extra)
