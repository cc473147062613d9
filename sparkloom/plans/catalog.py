"""Views, query text and schema documents."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register(frame: DataFrame, name: str) -> None:
    frame.createOrReplaceTempView(name)


def view_names(spark: SparkSession) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables() if table.isTemporary)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def try_query(spark: SparkSession, text: str, args: dict | None = None) -> tuple[DataFrame | None, str | None]:
    """Frame of a query, or none and the reason why it cannot be analysed. Bind values through `args`."""
    try:
        return spark.sql(text, args=args), None
    except AnalysisException as problem:
        return None, str(problem)


def group_counts(frame: DataFrame, phase: str, column: str = "phase", group: str = "period") -> DataFrame:
    """Rows per group of one phase."""
    return frame.where(F.col(column) == phase).groupBy(group).agg(F.count("*").alias("count"))


def group_counts_sql(frame: DataFrame, phase: str, view: str = "elements") -> DataFrame:
    """The same through a view and query text, the phase being a bound value."""
    register(frame, view)
    query = f"SELECT period, count(*) AS count FROM {view} WHERE phase = :phase GROUP BY period"
    return frame.sparkSession.sql(query, args={"phase": phase})


def schema_to_text(schema: T.StructType) -> str:
    return schema.json()


def schema_from_text(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


WHOLE = ("byte", "short", "integer", "long")
FRACTIONS = ("float", "double")


def wider_type(one: T.DataType, other: T.DataType, path: str = "") -> T.DataType:
    """The narrowest type that holds every value of both; raises where there is none.

    Whole numbers widen to larger ones, to decimals with room for them and, up to 32 bits, to doubles; floats to
    doubles, dates to timestamps without a zone, null to anything. Structs have the fields of both, arrays and maps
    widen inside.
    """
    def whole_digits(t: T.DataType) -> int:
        return {"byte": 3, "short": 5, "integer": 10, "long": 19}[t.typeName()]

    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    names = (one.typeName(), other.typeName())
    if all(isinstance(t, T.StructType) for t in (one, other)):
        return wider_schema(one, other, path)
    if all(isinstance(t, T.ArrayType) for t in (one, other)):
        return T.ArrayType(wider_type(one.elementType, other.elementType, f"{path}[]"),
                           one.containsNull or other.containsNull)
    if all(isinstance(t, T.MapType) for t in (one, other)) and one.keyType == other.keyType:
        return T.MapType(one.keyType, wider_type(one.valueType, other.valueType, f"{path}{{}}"),
                         one.valueContainsNull or other.valueContainsNull)
    if all(name in WHOLE for name in names):
        return max(one, other, key=whole_digits)
    if set(names) <= {"decimal", *WHOLE}:
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (whole_digits(t), 0)
                 for t in (one, other)]
        digits, scale = max(d for d, _ in sizes), max(s for _, s in sizes)
        if digits + scale <= 38:
            return T.DecimalType(digits + scale, scale)
    if set(names) <= {*FRACTIONS, "byte", "short", "integer"}:
        return T.DoubleType()
    if set(names) == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    raise ValueError(f"column {path or '(whole)'}: {one.simpleString()} and {other.simpleString()} have no common type")


def wider_schema(one: T.StructType, other: T.StructType, path: str = "") -> T.StructType:
    """Fields of both in order of appearance; a field that one lacks, or that may be null in one, may be null."""
    fields = []
    for field in [*one.fields, *[f for f in other.fields if f.name not in one.names]]:
        sides = [schema[field.name] for schema in (one, other) if field.name in schema.names]
        below = f"{path}.{field.name}" if path else field.name
        fields.append(T.StructField(field.name, wider_type(sides[0].dataType, sides[-1].dataType, below),
                                    len(sides) == 1 or any(side.nullable for side in sides)))
    return T.StructType(fields)


def merged_schema(texts: list[str]) -> T.StructType:
    """The widest of stored schema documents, in any order of widening; incompatible ones are refused."""
    return reduce(wider_schema, map(schema_from_text, texts))


def widened(value: Column, own: T.DataType | None, wide: T.DataType) -> Column:
    """A value of one type as the wider one; null where there is none."""
    if own is None or isinstance(own, T.NullType):
        return F.lit(None).cast(wide)
    if own == wide:
        return value
    if isinstance(wide, T.StructType):
        inner = [widened(value[f.name], own[f.name].dataType if f.name in own.names else None, f.dataType).alias(f.name)
                 for f in wide.fields]
        return F.when(value.isNotNull(), F.struct(*inner)).cast(wide)
    if isinstance(wide, T.ArrayType):
        return F.transform(value, lambda x: widened(x, own.elementType, wide.elementType))
    if isinstance(wide, T.MapType):
        return F.transform_values(value, lambda _, x: widened(x, own.valueType, wide.valueType))
    return value.cast(wide)


def read_versions(spark: SparkSession, versions: list[tuple[str, str]]) -> DataFrame:
    """Parquet folders, each with its stored schema document, as one frame in the widest schema.

    Each folder is read with its own schema, so its files are pruned and pushed to as always; columns that a version
    lacks are null.
    """
    widest = merged_schema([text for _, text in versions])

    def part(path: str, text: str) -> DataFrame:
        own = schema_from_text(text)
        stored = spark.read.schema(own).parquet(path)
        return stored.select(*[widened(F.col(f"`{f.name}`") if f.name in own.names else F.lit(None),
                                       own[f.name].dataType if f.name in own.names else None, f.dataType).alias(f.name)
                               for f in widest.fields])

    return reduce(DataFrame.unionAll, [part(*version) for version in versions])
