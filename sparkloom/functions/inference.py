"""Schema of JSON objects held as strings, with a bounded number of names.

Every value is one row of (path, type); types are counted for each path by a distributed aggregate, a level of
nesting at a time. A path with more than `most_fields` different names below it is a map: its names are data, not
schema, and count as one. So no more names than the limit reach the driver for any path, and none for a map.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_FIELDS, MOST_PATHS = 500, 20_000
_ITEM, _ENTRY = "[]", "{}"  # steps into an array and into a map
_FIELD = "\x01"  # before the name of a field


def _children(level: DataFrame) -> DataFrame:
    """(path, step, v) of the values one level down."""
    return (level.alias("level").lateralJoin(
        level.sparkSession.tvf.variant_explode(F.col("level.v").outer()).alias("part"))
        .select("level.path", F.when(F.col("part.key").isNull(), F.lit(_ITEM))
                .otherwise(F.concat(F.lit(_FIELD), "part.key")).alias("step"), F.col("part.value").alias("v")))


def _scalar(found: str) -> T.DataType | None:
    """The column type of a value's type text; none for a null."""
    kind = found.upper()
    if kind in ("VOID", "VARIANT"):
        return None
    if kind.startswith("DECIMAL"):
        digits, scale = map(int, re.findall(r"\d+", kind))
        return T.DecimalType(digits, scale) if scale == 0 else T.DoubleType()
    return {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(),
            "BOOLEAN": T.BooleanType()}.get(kind, T.StringType())


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: numbers widen to each other, anything else is text."""
    if a == b:
        return a
    whole = (T.LongType, T.DecimalType)
    if isinstance(a, whole) and isinstance(b, whole):
        return T.DecimalType(max(x.precision if isinstance(x, T.DecimalType) else 20 for x in (a, b)), 0)
    numbers = (*whole, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    return T.StringType()


def _built(path: str, kinds: dict[str, set[str]], steps: dict[str, list[str]]) -> T.DataType:
    """The type at a path from the types that were met there and the steps below it."""
    met = kinds.get(path, set())
    nested = {kind for kind in met if kind in ("OBJECT", "ARRAY")}
    plain = [t for t in map(_scalar, sorted(met - nested)) if t is not None]
    if len(nested) + bool(plain) > 1:
        return T.StringType()
    if "ARRAY" in nested:
        return T.ArrayType(_built(path + _ITEM, kinds, steps))
    if "OBJECT" in nested:
        if steps.get(path) == [_ENTRY]:
            return T.MapType(T.StringType(), _built(path + _ENTRY, kinds, steps))
        return T.StructType([T.StructField(step[1:], _built(path + step, kinds, steps))
                             for step in sorted(steps.get(path, []))])
    return reduce(_wider, plain) if plain else T.StringType()


def infer_json(strings: DataFrame, column: str, most_fields: int = MOST_FIELDS) -> T.DataType:
    """The type of a column of JSON texts: a struct, or a map where the objects have more than `most_fields` names.

    The same holds at every depth. Numbers that mix are widened (bigint, decimal without fraction, double), other
    mixtures and paths that are always null are text, fractions are doubles; texts that are no JSON are left out.
    An empty object is a struct without fields. Names must not hold the character 1. Runs one job a level of nesting,
    and one more where it has maps; the driver gets a row for each path, `MOST_PATHS` at most, and a map has one.
    """
    kind = F.regexp_extract(F.schema_of_variant("v"), r"^(DECIMAL\(\d+,\s*\d+\)|[A-Z]+)", 1)
    nested = {"OBJECT", "ARRAY"}
    level = strings.select(F.lit("").alias("path"), F.try_parse_json(column).alias("v")).where("v IS NOT NULL")
    kinds = {"": set(level.agg(F.collect_set(kind)).first()[0])}
    steps: dict[str, list[str]] = {}
    last = kinds[""]
    while last & nested:
        below = _children(level)
        met = below.groupBy("path", "step").agg(F.collect_set(kind).alias("kinds"))
        # One name more than a struct may have says that it is a map; the step into an array comes first.
        order = Window.partitionBy("path").orderBy(F.col("step") != _ITEM, "step")
        listed = (met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most_fields + 2)
                  .limit(MOST_PATHS + 1).collect())
        if len(kinds) + len(listed) > MOST_PATHS:
            raise ValueError(f"more than {MOST_PATHS} paths: lower most_fields")
        fields: dict[str, list] = {}
        last = set()
        for row in listed:
            if row["step"] == _ITEM:
                kinds[row["path"] + _ITEM] = set(row["kinds"])
                last |= set(row["kinds"])
            else:
                fields.setdefault(row["path"], []).append(row)
        wide = [path for path, own in fields.items() if len(own) > most_fields]
        for path, own in fields.items():
            if path not in wide:
                steps[path] = [row["step"] for row in own]
                kinds.update({path + row["step"]: set(row["kinds"]) for row in own})
                last = last.union(*[row["kinds"] for row in own])
        in_map = F.col("path").isin(wide) & (F.col("step") != _ITEM) if wide else F.lit(False)
        if wide:
            for row in below.where(in_map).groupBy("path").agg(F.collect_set(kind).alias("kinds")).collect():
                steps[row["path"]] = [_ENTRY]
                kinds[row["path"] + _ENTRY] = set(row["kinds"])
                last |= set(row["kinds"])
        level = below.where(kind.isin(*nested)).select(
            F.concat("path", F.when(in_map, F.lit(_ENTRY)).otherwise(F.col("step"))).alias("path"), "v")
    return _built("", kinds, steps)
