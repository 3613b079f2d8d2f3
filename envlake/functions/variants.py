"""Typed inspection of JSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from envlake.domain import MAX_ID


def member(value: Column, path: str) -> Column:
    """Member as VARIANT; null when absent."""
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    """Type name of a VARIANT; VOID for JSON null, null when absent."""
    return F.schema_of_variant(value)


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_object(value: Column) -> Column:
    return _known(kind(value).startswith("OBJECT"))


def is_array(value: Column) -> Column:
    return _known(kind(value).startswith("ARRAY"))


def is_text(value: Column) -> Column:
    return _known(kind(value) == "STRING")


def is_missing(value: Column) -> Column:
    """Absent or JSON null."""
    return F.coalesce(kind(value) == "VOID", F.lit(True))


def is_number(value: Column) -> Column:
    """A finite JSON number; text and booleans are not numbers."""
    number = F.try_variant_get(value, "$", "double")
    numeric = kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    finite = ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return _known(numeric & finite)


def is_identifier(value: Column) -> Column:
    """A JSON integer between 1 and the largest 64-bit identifier."""
    number = F.try_variant_get(value, "$", "bigint")
    return _known((kind(value) == "BIGINT") & number.between(1, MAX_ID))


def text_of(value: Column) -> Column:
    """Text of a JSON string; null for every other kind."""
    return F.when(is_text(value), F.try_variant_get(value, "$", "string"))


def number_of(value: Column) -> Column:
    return F.when(is_number(value), F.try_variant_get(value, "$", "double"))


def integer_of(value: Column) -> Column:
    return F.when(kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def canonical_json(content: Column) -> Column:
    """Comparable text of a JSON document: sorted keys, plain numbers."""
    return F.to_json(F.try_parse_json(content))


def replaced(value: Column, members: dict[str, Column]) -> Column:
    """Object with the named members set; all other members stay."""
    kept = F.map_filter(
        F.try_variant_get(value, "$", "map<string,variant>"), lambda name, _: ~name.isin(*members)
    )
    pairs = (part for name, item in members.items() for part in (F.lit(name), item))
    return F.to_variant_object(F.map_concat(kept, F.create_map(*pairs)))
