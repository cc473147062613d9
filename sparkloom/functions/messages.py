"""Message payloads: delimited text, JSON text and change-event envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.inference import MOST_FIELDS, infer_json


def payload_text(value: str | Column, charset: str = "UTF-8") -> Column:
    """Binary message body as text."""
    return F.decode(value, charset)


def delimited_fields(messages: DataFrame, schema: T.StructType, column: str = "value", delimiter: str = ",",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Split each message and cast item i to field i; messages with another field count are dropped.

    The delimiter is taken literally. `keep` names columns of the message, such as its key or timestamp, that stay in
    front. Works on batch and streaming frames alike.
    """
    parts = F.split(F.col(column).cast("string"), rf"\Q{delimiter}\E")
    split = messages.select(*keep, parts.alias("_parts")).where(F.size("_parts") == len(schema.fields))
    return split.select(*keep, *[F.get("_parts", F.lit(i)).try_cast(field.dataType).alias(field.name)
                                 for i, field in enumerate(schema.fields)])


def array_rows(messages: DataFrame, schema: T.StructType | str, items: str, value: str = "value",
               fields: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON messages with an array of structs at the path `items`: one row per entry, its fields as columns.

    `fields` names parts of the message and `keep` columns beside it that stay in front of each entry. Messages
    without entries, or that cannot be read, disappear.
    """
    read = messages.select(*keep, F.from_json(payload_text(value), schema).alias("_m"))
    entries = read.select(*keep, *[F.col(f"_m.{f}").alias(f) for f in fields], F.explode(f"_m.{items}").alias("_e"))
    return entries.select(*keep, *fields, "_e.*")


def envelope_schema(row_schema: T.StructType) -> T.StructType:
    """Schema of a change event: payload with the row before and after, its source and operation code."""
    return T.StructType([
        T.StructField("payload", T.StructType([
            T.StructField("before", row_schema),
            T.StructField("after", row_schema),
            T.StructField("source", T.MapType(T.StringType(), T.StringType())),
            T.StructField("op", T.StringType()),
        ])),
    ])


def json_schema(strings: DataFrame, column: str, most_fields: int = MOST_FIELDS) -> T.StructType | T.MapType:
    """Infer one schema from a column of JSON objects held as strings (see `inference.infer_json`).

    A struct, or a map where the objects have more than `most_fields` different keys.
    """
    found = infer_json(strings, column, most_fields)
    if not isinstance(found, (T.StructType, T.MapType)):
        raise ValueError(f"column {column!r} holds no JSON objects")
    return found


def parse_json_strings(strings: DataFrame, column: str, schema: str | T.StructType | T.MapType | None = None,
                       map_column: str = "entries", most_fields: int = MOST_FIELDS) -> DataFrame:
    """Expand JSON strings to typed columns, inferring the schema first when none is given.

    Objects with too many different keys for columns come as one map column, `map_column`.
    """
    schema = schema if schema is not None else json_schema(strings, column, most_fields)
    if isinstance(schema, T.MapType):
        return strings.select(F.from_json(column, schema).alias(map_column))
    return strings.select(F.from_json(column, schema).alias("_row")).select("_row.*")
