"""Keyed tables of changes, files split within records, and inference with a bounded number of names."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.bindings.inputs import CHANGED_ROW, change_messages, file_count, table, wide
from sparkloom.bindings.stream_queries import stream_of
from sparkloom.functions.messages import parse_json_strings
from sparkloom.plans import events as ev
from sparkloom.sinks import files as sink
from sparkloom.sources import records
from sparkloom.streaming.changes import ChangeTable
from sparkloom.streaming.runner import for_each_batch
from sparkloom.workspace import new_folder

_ROW = "event_id bigint, user_id bigint, value double"


def _apply_changes(spark, folder):
    """Changes of users arrive out of order in six batches and are then delivered again, all in other batches."""
    events = table(spark, folder, "events")
    target = ChangeTable(new_folder(spark, "users"), _ROW, "user_id", ("event_id",), buckets=4, fanout=2)

    def changes(messages):
        return ev.keyed_changes(ev.change_rows(messages, CHANGED_ROW))

    checkpoint = new_folder(spark, "checkpoint")
    stream = changes(change_messages(stream_of(spark, folder, "events", 6)))
    for_each_batch(stream, lambda batch, number: target.apply(batch, number), checkpoint)
    target.apply(changes(change_messages(events.where("event_type = 'view'"))), 5)  # a number that was applied before
    target.apply(changes(change_messages(events)), 0, "again")
    return target.read(spark)


def _csv_split(spark, folder):
    """Values with line breaks, in files that many tasks read: those of a large table are larger than a task's part."""
    path = new_folder(spark, "documents-csv")
    documents = table(spark, folder, "documents").select(
        "doc_id", F.concat("source", F.lit(', "'), "lang", F.lit('"')).alias("label"),
        F.when(F.col("lang") == "de", F.lit("")).when(F.col("lang") != "fr", F.col("text")).alias("text"))
    sink.write_delimited(documents, path, files=file_count(spark, folder, "documents", 2, 3))
    return records.read_delimited_split(spark, path, documents.schema)


def _json_split(spark, folder):
    """Indented arrays of documents, in files that many tasks read."""
    path = new_folder(spark, "customer-json")
    customers = table(spark, folder, "customer")
    grouped = customers.groupBy(F.floor(F.col("c_custkey") / 500).alias("file")).agg(
        F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value"))
    broken = F.replace(F.replace("value", F.lit("},{"), F.lit("},\n{")), F.lit(',"c_'), F.lit(',\n  "c_'))
    grouped.select("file", broken.alias("value")).write.partitionBy("file").text(path)
    return wide(records.read_documents_split(spark, f"{path}/file=*", customers.schema))


def _many_keys(spark, folder):
    """Objects whose keys are identifiers come as one map."""
    message = F.concat(F.lit('{"event-'), "event_id", F.lit('": {"user": '), "user_id", F.lit("}}"))
    strings = table(spark, folder, "events").select("event_id", message.alias("j"))
    parsed = parse_json_strings(strings, "j", map_column="events", most_fields=50)
    return parsed.select(F.explode("events").alias("name", "seen")).select("name", "seen.user")


QUERIES = {
    "keyed_apply_changes": _apply_changes,
    "csv_split_hard": _csv_split,
    "json_documents_split": _json_split,
    "json_strings_map": _many_keys,
}

ORACLES = {
    "keyed_apply_changes": """SELECT event_id, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""",
    "csv_split_hard": """SELECT doc_id, source || ', "' || lang || '"' AS label,
        CASE WHEN lang = 'de' THEN '' WHEN lang <> 'fr' THEN text END AS text FROM documents""",
    "json_documents_split": "SELECT * REPLACE (c_nationkey::bigint AS c_nationkey) FROM customer",
    "json_strings_map": "SELECT 'event-' || event_id AS name, user_id AS \"user\" FROM events",
}
