"""Named validation rules, all counted in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from envlake.errors import InputError


def failed(ok: Column) -> Column:
    """Violation flag of a condition that must hold; unknown counts as failed."""
    return ~F.coalesce(ok, F.lit(False))


def count_violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row with a counter per rule, plus the number of rows seen."""
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(broken).alias(name) for name, broken in rules.items()),
    )


def violation_report(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations), one row per rule, from a single pass."""
    counted = count_violations(rows, rules)
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return counted.select(F.inline(F.array(*pairs)))


def first_violation(rules: Mapping[str, Column]) -> Column:
    """Name of the first broken rule of a row, or null."""
    return F.coalesce(*(F.when(broken, F.lit(name)) for name, broken in rules.items()))


def require_clean(rows: DataFrame, rules: Mapping[str, Column], stage: str) -> int:
    """Raise naming every broken rule; return the number of rows seen."""
    counts = count_violations(rows, rules).first().asDict()
    total = counts.pop("rows")
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        detail = ", ".join(f"{name}={n}" for name, n in sorted(broken.items()))
        raise InputError(f"{stage}: {detail}")
    if not total:
        raise InputError(f"{stage}: input is empty")
    return total


def duplicate_keys(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("record_count")).filter("record_count > 1")


def require_unique(rows: DataFrame, key: tuple[str, ...], stage: str) -> None:
    found = duplicate_keys(rows, key).first()
    if found is not None:
        raise InputError(f"{stage}: duplicate key {[found[name] for name in key]}")
