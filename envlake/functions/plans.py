"""Plan-shaping helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Project costly columns behind a one-element ``inline``.

    The optimizer moves filters below a plain projection by repeating its
    expressions. It does not do so across a generator, so what is parsed here is
    parsed once however many later expressions and filters use it.
    """
    fields = (column.alias(name) for name, column in columns.items())
    return rows.select(F.inline(F.array(F.struct(*fields))))
