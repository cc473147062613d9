"""Equi-joins that stay balanced when some keys hold a large share of the rows.

Without a list of hot keys the join is Spark's: broadcast where the session allows it, else shuffled, with the
partitions of a hot key split by adaptive execution. With a list (`hot_keys`) the rows of those keys are spread over
all shuffle partitions before the join, which also holds where adaptive execution cannot split. Every row takes part
in either form, so the two give the same result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.workspace import written

SPREAD = "_spread"
# Kinds in which each fact row belongs to one partition, so that lookup rows may be repeated.
SPREADABLE = ("inner", "left", "left_semi", "left_anti")


def _partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_hash(keys: list[str]) -> Column:
    """A hash that is the same for equal keys of different whole-number types."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def hot_keys(facts: DataFrame, keys: str | list[str], partitions: int | None = None) -> DataFrame:
    """Hashes of all keys that hold more than one partition's share of the rows, written once.

    One pass with a mergeable frequent-items sketch and no shuffle of the facts. At most `partitions` keys can hold
    that share, so the list has at most twice as many rows; the sketch tracks sixteen times as many and loses none
    of them up to 62,500 partitions; beyond, where it tracks a million keys, one that holds barely the share may be
    missed, and its rows stay together. It may name other frequent keys too. Neither changes the result of a join.
    Runs a job at once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    partitions = partitions or _partitions(facts)
    tracked = 1 << (16 * partitions - 1).bit_length()
    present = facts.where(~_any_null(keys)).select(_key_hash(keys).alias("_hot"))
    top = F.call_function("approx_top_k", F.col("_hot"), F.lit(min(2 * partitions, 100_000)),
                          F.lit(min(max(tracked, 16), 1_000_000)))
    found = present.agg(F.count("*").alias("_all"), top.alias("_top"))
    listed = found.select("_all", F.explode("_top").alias("_t")).select("_all", "_t.item", "_t.count")
    return written(listed.where(F.col("count") * partitions > F.col("_all")).select(F.col("item").alias("_hot")), "hot-keys")


def _row_salt(frame: DataFrame, salts: int) -> Column:
    hashable = [F.col(f.name) for f in frame.schema.fields if not _holds_map(f.dataType)]
    return F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int")


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, (T.MapType, T.VariantType))


def spread_sides(facts: DataFrame, lookup: DataFrame, fact_keys: list[str], lookup_keys: list[str], hot: DataFrame,
                 salts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Add a `_spread` column to both sides, to be joined on together with the keys.

    Fact rows of a hot key are scattered by a hash of the row over as many slots as there are shuffle partitions, and
    lookup rows of that key are repeated once for each slot; other rows use slot 0. Null keys match nothing and are
    scattered too. Fact rows alike in every column share a slot; adaptive skew handling, which cuts by size and not by
    value, splits those. The list is broadcast: `hot_keys` bounds it by the number of partitions.
    """
    salts = salts or _partitions(facts)
    marked = F.broadcast(hot.select("_hot").distinct().withColumn("_is_hot", F.lit(True)))

    def tagged(frame: DataFrame, keys: list[str]) -> DataFrame:
        return frame.withColumn("_hot", _key_hash(keys)).join(marked, "_hot", "left").drop("_hot")

    slot = F.when(F.col("_is_hot") | _any_null(fact_keys), F.col("_slot")).otherwise(F.lit(0))
    facts = (tagged(facts.withColumn("_slot", _row_salt(facts, salts)), fact_keys)
             .withColumn(SPREAD, slot).drop("_slot", "_is_hot"))
    slots = F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    lookup = tagged(lookup, lookup_keys).withColumn(SPREAD, F.explode(slots)).drop("_is_hot")
    return facts, lookup


def _prepared(facts: DataFrame, lookup: DataFrame, fact_keys: list[str], lookup_keys: list[str], how: str,
              hot: DataFrame | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """The sides to join, and the columns to join on besides the keys. Every join of this module begins here."""
    if hot is None:
        return facts, lookup, []
    if how not in SPREADABLE:
        raise ValueError(f"a {how!r} join cannot be spread; leave out the hot keys")
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select(*lookup_keys).distinct()
    return *spread_sides(facts, lookup, fact_keys, lookup_keys, hot), [SPREAD]


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: str | list[str], how: str = "inner",
                hot: DataFrame | None = None) -> DataFrame:
    """Equi-join on shared key names, keeping one copy of each key; `hot` comes from `hot_keys`."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    facts, lookup, more = _prepared(facts, lookup, keys, keys, how, hot)
    return facts.join(lookup, [*keys, *more], how).drop(*more)


def join_on_reference(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Join on an expression, then drop the right-hand key by its frame reference."""
    left, right, more = _prepared(left, right, [left_key], [right_key], how, hot)
    match = reduce(and_, [left[a] == right[b] for a, b in [(left_key, right_key), *zip(more, more)]])
    joined = left.join(right, match, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop(*more)
    for name in more:
        joined = joined.drop(left[name]).drop(right[name])
    return joined.drop(right[right_key])


def join_on_alias(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Join two aliased frames, then drop the right-hand key by its qualified name."""
    left, right, more = _prepared(left, right, [left_key], [right_key], how, hot)
    pairs = [(left_key, right_key), *zip(more, more)]
    match = reduce(and_, [F.col(f"left.{a}") == F.col(f"right.{b}") for a, b in pairs])
    joined = left.alias("left").join(right.alias("right"), match, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop(*more)
    for name in more:
        joined = joined.drop(F.col(f"left.{name}")).drop(F.col(f"right.{name}"))
    return joined.drop(F.col(f"right.{right_key}"))


def keys_without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct left keys that the right side lacks, as an anti join.

    Both sides are reduced to distinct keys first: repeats collapse before the shuffle, and the join
    reuses that partitioning.
    """
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def keys_without_match_by_null(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The same keys found by a left join and a null test."""
    left_keys = left.select(key).distinct().alias("left")
    right_keys = right.select(key).distinct().alias("right")
    return (left_keys.join(right_keys, F.col(f"left.{key}") == F.col(f"right.{key}"), "left")
            .where(F.col(f"right.{key}").isNull()).select(F.col(f"left.{key}")))
