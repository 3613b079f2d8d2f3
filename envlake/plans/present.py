"""Client-neutral form of query results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DIGITS = 9


def present(rows: DataFrame) -> DataFrame:
    """Instants and dates as text, doubles rounded, lists of text joined.

    Results then compare equal whatever zone or types a client library uses, and
    whatever order doubles were summed in.
    """

    def shown(name: str, dtype: str):
        column = F.col(f"`{name}`")
        if dtype in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif dtype == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif dtype == "double":
            column = F.round(column, DIGITS)
        elif dtype == "array<string>":
            column = F.array_join(column, ",")
        elif dtype in ("int", "smallint", "tinyint") or dtype.startswith("decimal"):
            column = column.cast("bigint")
        return column.alias(name)

    return rows.select(*(shown(name, dtype) for name, dtype in rows.dtypes))
