"""Programme-log analytics: a fact table with durations joined to small descriptive tables.

Expected columns
    facts        service_id, class_id, duration and, if categories are joined, category_id
    identifiers  service_id, channel_id, primary_flag (0/1)
    classes      class_id, class_code, class_name
    categories   category_id, category_name
    channels     channel_id, channel_name
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.scalars import ratio
from sparkloom.operators.joins import lookup_join
from sparkloom.operators.summaries import rounded_histogram

# Codes of programme classes that count as commercial.
COMMERCIAL_CODES = ["COM", "PRC", "PGI", "PRO", "PSA", "MAG", "LOC", "SPO", "MER", "SOL"]
# The code that counts only in part, and its weight.
PARTIAL_CODES = ["PRC"]
PARTIAL_WEIGHT = 0.75
FULL_WEIGHT_CODES = [code for code in COMMERCIAL_CODES if code not in PARTIAL_CODES]


def primary_identifiers(identifiers: DataFrame) -> DataFrame:
    return identifiers.where(F.col("primary_flag") == 1).drop("primary_flag")


def full_log(facts: DataFrame, identifiers: DataFrame, classes: DataFrame, categories: DataFrame | None = None,
             channels: DataFrame | None = None) -> DataFrame:
    """Durations of primary services with their channel (inner), class and category (left) descriptions.

    One row for each fact, whatever the sizes of the other tables; filtering joins come first. The sums over it add
    up within each task before anything is shuffled for them.
    """
    log = lookup_join(facts, primary_identifiers(identifiers), "service_id", "inner")
    keys = ["service_id"]
    for lookup, key, how in ((channels, "channel_id", "inner"), (classes, "class_id", "left"),
                             (categories, "category_id", "left")):
        if lookup is not None:
            log = lookup_join(log, lookup, key, how)
            keys.append(key)
    return log.drop(*[key for key in keys if key != "channel_id"])


def duration_by(log: DataFrame, *keys: str) -> DataFrame:
    """Total duration per group, longest first."""
    return (log.groupBy(*keys).agg(F.sum("duration").alias("duration_total"))
            .orderBy(F.desc("duration_total"), *keys))


def duration_by_class(log: DataFrame) -> DataFrame:
    return duration_by(log, "class_code", "class_name")


def commercial_duration(codes: list[str], partial_codes: list[str] = (), weight: float = PARTIAL_WEIGHT) -> Column:
    """Duration that counts as commercial, comparing trimmed codes.

    A code in `partial_codes` counts with `weight`; the two lists must not overlap, because the first
    match wins and would hide the other.
    """
    overlap = sorted(set(codes) & set(partial_codes))
    if overlap:
        raise ValueError(f"codes are in both lists: {overlap}")
    code = F.trim("class_code")
    counted = F.when(code.isin(list(codes)), F.col("duration"))
    if partial_codes:
        counted = counted.when(code.isin(list(partial_codes)), F.col("duration") * weight)
    return counted.otherwise(0)


def commercial_share(log: DataFrame, keys: list[str], codes: list[str] = COMMERCIAL_CODES,
                     partial_codes: list[str] = (), weight: float = PARTIAL_WEIGHT) -> DataFrame:
    """Commercial and total duration per group with their ratio, which is null where the total is 0."""
    counted = commercial_duration(codes, partial_codes, weight)
    return (log.groupBy(*keys)
            .agg(F.sum(counted).alias("duration_commercial"), F.sum("duration").alias("duration_total"))
            .withColumn("commercial_ratio", ratio("duration_commercial", "duration_total")))


def commercial_ratio(log: DataFrame, codes: list[str] = COMMERCIAL_CODES) -> DataFrame:
    """Share per programme class, highest first; facts without a class form a group of their own."""
    return (commercial_share(log, ["class_code", "class_name"], codes)
            .orderBy(F.desc("commercial_ratio"), "class_code", "class_name"))


def known_ratios(shares: DataFrame) -> DataFrame:
    """Only groups whose ratio is known."""
    return shares.dropna(subset=["commercial_ratio"])


def filled_ratios(shares: DataFrame) -> DataFrame:
    """Null replaced by 0 in every number column."""
    return shares.fillna(0)


def channel_ratio(log: DataFrame, codes: list[str] = COMMERCIAL_CODES, partial_codes: list[str] = (),
                  weight: float = PARTIAL_WEIGHT) -> DataFrame:
    """Share per named channel with null as 0, highest first; with partial codes, the weighted share."""
    shares = commercial_share(log, ["channel_id", "channel_name"], codes, partial_codes, weight)
    return filled_ratios(shares).orderBy(F.desc("commercial_ratio"), "channel_id", "channel_name")


def ratio_histogram(shares: DataFrame, digits: int = 1) -> DataFrame:
    """Channels per rounded ratio; an unknown ratio falls into bucket 0."""
    return rounded_histogram(shares, "commercial_ratio", digits, "ratio").orderBy("ratio")
