"""Unions over frames whose schemas only partly agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_columns(frames: list[DataFrame]) -> list[str]:
    """Columns present in every frame, in the order of the first."""
    shared = set.intersection(*[set(frame.columns) for frame in frames])
    return [name for name in frames[0].columns if name in shared]


def union_common_columns(frames: list[DataFrame], required: tuple[str, ...] = ()) -> DataFrame:
    """Union of all rows on the shared columns; duplicates stay, a missing required column is an error."""
    names = common_columns(frames)
    missing = sorted(set(required) - set(names))
    if missing:
        raise ValueError(f"required columns missing from at least one input: {missing}")
    picked = [frame.select(*[F.col(f"`{n}`") for n in names]) for frame in frames]
    return reduce(DataFrame.unionByName, picked)


def union_distinct(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both frames without duplicates."""
    return existing.unionByName(new).distinct()
