"""Schema-driven projection: renaming, ordering, dropping, casting and chunking columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[name.lower() for name in frame.columns])


def sort_columns(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f"`{name}`") for name in sorted(frame.columns)])


def drop_matching(frame: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose whole name matches the regular expression."""
    return frame.select(*[F.col(f"`{n}`") for n in frame.columns if not re.fullmatch(pattern, n)])


def keep_matching(frame: DataFrame, pattern: str) -> DataFrame:
    """Keep only columns whose whole name matches the regular expression."""
    return frame.select(*[F.col(f"`{n}`") for n in frame.columns if re.fullmatch(pattern, n)])


def tidy(frame: DataFrame, drop_suffix: str | None = None) -> DataFrame:
    """Lower-case names, optionally drop those ending in a suffix, and sort the rest."""
    tidied = lower_names(frame)
    if drop_suffix:
        tidied = drop_matching(tidied, f".*{re.escape(drop_suffix)}")
    return sort_columns(tidied)


def cast_by_prefix(frame: DataFrame, prefix: str, data_type: T.DataType | str) -> DataFrame:
    """Cast every column whose name starts with `prefix`; values that do not fit become null."""
    return frame.select(*[F.col(f"`{n}`").try_cast(data_type).alias(n) if n.startswith(prefix) else F.col(f"`{n}`")
                          for n in frame.columns])


def column_chunks(names: list[str], width: int = 3) -> list[list[str]]:
    """Split names into len(names) // width chunks whose sizes differ by at most one, the longer first."""
    count = max(1, len(names) // width)
    size, longer = divmod(len(names), count)
    chunks, start = [], 0
    for i in range(count):
        stop = start + size + (1 if i < longer else 0)
        chunks.append(names[start:stop])
        start = stop
    return chunks


def split_wide(frame: DataFrame, width: int = 3) -> list[DataFrame]:
    """A wide table as several narrow ones."""
    return [frame.select(*[F.col(f"`{n}`") for n in chunk]) for chunk in column_chunks(frame.columns, width)]


def schema_rows(frame: DataFrame) -> list[tuple[str, str]]:
    """Column names with their type text."""
    return [(field.name, field.dataType.simpleString()) for field in frame.schema.fields]
