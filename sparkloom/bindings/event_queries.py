"""Message jobs over events, in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.bindings.inputs import (CHANGED_ROW, READINGS, change_messages, click_messages, quote_messages,
                                       reading_messages, table, wide)
from sparkloom.functions.messages import array_rows, delimited_fields, parse_json_strings
from sparkloom.operators.setops import union_distinct
from sparkloom.plans import events as ev

CLICK_ROW = "serial_id bigint, studentid bigint, url string, time string, itemtype string, quantity double"


def click_type(spark):
    return spark.createDataFrame([], CLICK_ROW).schema


def unpacked(messages):
    """Changes as flat columns."""
    changes = ev.change_rows(messages, CHANGED_ROW)
    return changes.select("op", F.col("before.event_id").alias("before_id"), "after.*",
                          F.try_element_at("source", F.lit("table")).alias("origin"))


def _messages(spark, folder):
    return change_messages(table(spark, folder, "events"))


def _with_key(spark, folder):
    """Changes beside the key of their message."""
    messages = change_messages(table(spark, folder, "events"), keep=("event_id",)).withColumnRenamed("event_id", "key")
    return ev.change_rows(messages, CHANGED_ROW, keep=("key",)).select("key", "op", F.col("after.value").alias("value"))


def _devices(spark, folder):
    return array_rows(reading_messages(table(spark, folder, "events")), READINGS, "data.devices",
                      fields=("sender", "sent"), keep=("event_id",))


def _big_numbers(spark, folder):
    """Whole numbers of 20 digits keep them all."""
    number = F.concat(F.lit('{"n": 1234567890'), F.lpad(F.col("event_id").cast("string"), 10, "0"), F.lit("}"))
    parsed = parse_json_strings(table(spark, folder, "events").select(number.alias("j")), "j")
    return parsed.select(F.col("n").cast("string").alias("n"))


def _parts_text(spark, folder):
    return ev.change_parts_text(_messages(spark, folder)).select("op", "before", "after", "source")


def _json_tour(spark, folder):
    return ev.json_tour(table(spark, folder, "events"), "props", "k", '{"k": 1}', keep=("event_id",))


def first_half(events):
    return events.where("event_type IN ('click', 'view')")


def _quote_merge(spark, folder):
    events = table(spark, folder, "events")
    existing = ev.quotes(quote_messages(first_half(events)))
    return wide(union_distinct(existing, ev.quotes(quote_messages(events))))


QUERIES = {
    "cdc_unpack": lambda s, d: unpacked(_messages(s, d)),
    "cdc_with_key": _with_key,
    "device_readings": _devices,
    "json_big_numbers": _big_numbers,
    "cdc_reads": lambda s, d: ev.changed_to(ev.change_rows(_messages(s, d), CHANGED_ROW, "iso-8859-1"), "r"),
    "cdc_parts_text": _parts_text,
    "json_function_tour": _json_tour,
    "delimited_messages": lambda s, d: delimited_fields(click_messages(table(s, d, "events")), click_type(s)),
    "quote_merge": _quote_merge,
}

_OP = """CASE event_type WHEN 'error' THEN 'd' WHEN 'purchase' THEN 'u' WHEN 'signup' THEN 'c' ELSE 'r' END"""
_ROW = """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"value":' || value || '}'"""

UNPACKED_SQL = f"""SELECT {_OP} AS op, CASE WHEN event_type IN ('error', 'purchase') THEN event_id END AS before_id,
    CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
    CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
    CASE WHEN event_type <> 'error' THEN value END AS value, 'events' AS origin FROM events"""
QUOTES_SQL = """SELECT DISTINCT event_type AS symbol, cast(ts AS date) AS date, value AS open, value + 2 AS high,
    value / 2 AS low, value + 1 AS close, user_id AS volume FROM events"""

ORACLES = {
    "cdc_unpack": UNPACKED_SQL,
    "cdc_with_key": f"""SELECT event_id AS key, {_OP} AS op, CASE WHEN event_type <> 'error' THEN value END AS value
        FROM events""",
    "device_readings": """SELECT event_id, cast(user_id AS varchar) AS sender, cast(ts AS varchar) AS sent, device,
            CASE device WHEN 'inner' THEN event_id ELSE event_id + user_id END AS reading, event_type AS state
        FROM events, (VALUES ('inner'), ('outer')) d(device) WHERE event_type <> 'error'""",
    "json_big_numbers": "SELECT '1234567890' || lpad(cast(event_id AS varchar), 10, '0') AS n FROM events",
    "cdc_reads": "SELECT 'r' AS op, event_id, user_id, value FROM events WHERE event_type IN ('click', 'view')",
    "cdc_parts_text": f"""SELECT {_OP} AS op, CASE WHEN event_type IN ('error', 'purchase') THEN {_ROW} END AS before,
        CASE WHEN event_type <> 'error' THEN {_ROW} END AS after, '{{"table":"events"}}' AS source FROM events""",
    "json_function_tour": """SELECT event_id, json_extract_string(props, '$.k') AS via_map,
        json_extract_string(props, '$.k') AS via_tuple, json_extract_string(props, '$.k') AS via_path,
        cast(json_extract_string(props, '$.k') AS bigint) AS via_struct,
        '{"k":"' || json_extract_string(props, '$.k') || '"}' AS as_text,
        'STRUCT<k: BIGINT>' AS sample_schema FROM events""",
    "delimited_messages": """SELECT user_id AS serial_id, event_id AS studentid, event_type AS url,
        cast(ts AS varchar) AS time, event_type AS itemtype,
        CASE WHEN event_type <> 'signup' THEN value END AS quantity FROM events WHERE event_type <> 'error'""",
    "quote_merge": QUOTES_SQL,
}
