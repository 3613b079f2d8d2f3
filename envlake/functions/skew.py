"""Helpers that keep one hot key from becoming one slow task."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, dimension: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join facts to a dimension that is unique on ``key``.

    The runtime broadcasts the dimension where its size is below the session threshold.
    Beyond it both sides are shuffled, and a key that owns a large share of the facts is
    split over several tasks, each with its copy of that one dimension row.
    """
    return facts.join(dimension, key, how)
