"""Change events and quotes; every function takes a batch or a streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.messages import envelope_schema, payload_text

PAYLOAD_PARTS = ["before", "after", "source", "op"]

# Columns of a price quote message.
QUOTE_SCHEMA = "symbol string, date date, open double, high double, low double, close double, volume int"


def change_rows(messages: DataFrame, row_schema: T.StructType, charset: str = "UTF-8", value: str = "value",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope messages as `before`, `after`, `source` and `op` columns, typed by the declared schema.

    `keep` names columns of the message, such as its key, offset or timestamp, that stay in front.
    """
    event = F.from_json(payload_text(value, charset), envelope_schema(row_schema))
    return messages.select(*keep, event.alias("_event")).select(*keep, "_event.payload.*")


def change_parts_text(messages: DataFrame, charset: str = "UTF-8", value: str = "value",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """The four payload parts as JSON text, for rows whose schema is not known; `keep` as in `change_rows`."""
    payload = messages.select(*keep, F.json_tuple(payload_text(value, charset), "payload").alias("payload"))
    return payload.select(*keep, F.json_tuple("payload", *PAYLOAD_PARTS).alias(*PAYLOAD_PARTS))


def changed_to(changes: DataFrame, op: str | None = None) -> DataFrame:
    """Row state after each change, of one operation code if given."""
    if op is not None:
        changes = changes.where(F.col("op") == op)
    return changes.select("op", "after.*")


def keyed_changes(changes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The row after each change with a column `deleted`; for a deletion, the row that it removes."""
    row = F.coalesce("after", "before")
    return changes.select(*keep, row.alias("_row"), (F.col("op") == "d").alias("deleted")).select(
        *keep, "_row.*", "deleted")


def json_tour(frame: DataFrame, column: str, field: str, sample: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON field read four ways, the text written back, and the schema of a sample."""
    as_map = F.from_json(column, T.MapType(T.StringType(), T.StringType()))
    read = frame.select(*keep, column, as_map.alias("_map"), F.json_tuple(column, field).alias("via_tuple"))
    return read.select(
        *keep, F.try_element_at("_map", F.lit(field)).alias("via_map"), "via_tuple",
        F.get_json_object(column, f"$.{field}").alias("via_path"),
        F.from_json(column, f"{field} bigint")[field].alias("via_struct"),
        F.to_json("_map").alias("as_text"), F.schema_of_json(F.lit(sample)).alias("sample_schema"))


def quotes(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Quote messages as typed columns; `keep` as in `change_rows`."""
    read = messages.select(*keep, F.from_json(F.col(value).cast("string"), QUOTE_SCHEMA).alias("_q"))
    return read.select(*keep, "_q.*")
