"""Maps, their sorted pair form, and lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_pairs(mapping: str | Column) -> Column:
    """Map as an array of (key, value) structs sorted by key."""
    return F.sort_array(F.map_entries(mapping))


def pairs_map(pairs: str | Column) -> Column:
    """Array of (key, value) structs as a map; a repeated or null key is an error."""
    return F.map_from_entries(pairs)


def map_value(mapping: str | Column, key) -> Column:
    """Value under `key`, null when absent."""
    return F.try_element_at(mapping, key if isinstance(key, Column) else F.lit(key))


def row_map(names: list[str]) -> Column:
    """Map from column name to that column's text, for the given columns of each row."""
    keys = F.array(*[F.lit(name) for name in names])
    values = F.array(*[F.col(name).cast("string") for name in names])
    return F.map_from_arrays(keys, values)
