"""Streaming jobs, run to the end of the available data.

Each starts from an empty checkpoint in the shared folder; those that say so are run twice, so that the
second run has to go on where the first ended.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.bindings.event_queries import QUOTES_SQL, UNPACKED_SQL, first_half, unpacked
from sparkloom.bindings.inputs import change_messages, click_messages, file_count, quote_messages, table, wide
from sparkloom.functions.messages import delimited_fields
from sparkloom.plans import events as ev
from sparkloom.plans.text import lines
from sparkloom.sinks.files import write_lines
from sparkloom.sources.files import stream_lines, stream_parquet
from sparkloom.streaming import quotes, word_counts
from sparkloom.streaming.keyed import CLICK_SCHEMA, KeyedTable, click_rows
from sparkloom.streaming.runner import for_each_batch, to_parquet
from sparkloom.workspace import new_folder


BATCHES = 3


def stream_of(spark, folder, name, batches=BATCHES):
    """A whole table as a stream of several batches: its rows are dealt over files, and a batch takes its share of
    them, one file of a small table."""
    path, rows = new_folder(spark, f"{name}-in"), table(spark, folder, name)
    files = file_count(spark, folder, name, batches)
    rows.repartition(files).write.parquet(path)
    return stream_parquet(spark, path, rows.schema, files_per_batch=files // batches)


def _to_files(spark, folder):
    """The second run begins where the first one ended and finds the rest of the files."""
    path, checkpoint, source = (new_folder(spark, label) for label in ("events-out", "checkpoint", "events-in"))
    events, files = table(spark, folder, "events"), file_count(spark, folder, "events", BATCHES)
    for step, predicate in enumerate(("event_type = 'click'", "event_type <> 'click'")):
        events.where(predicate).repartition(files).write.parquet(f"{source}/step={step}")
        to_parquet(stream_parquet(spark, f"{source}/*", events.schema, files_per_batch=files // BATCHES), path,
                   checkpoint)
    return spark.read.schema(events.schema).parquet(path)


def _cdc(spark, folder):
    path, checkpoint = new_folder(spark, "changes-out"), new_folder(spark, "checkpoint")
    rows = unpacked(change_messages(stream_of(spark, folder, "events")))
    to_parquet(rows, path, checkpoint)
    return spark.read.schema(rows.schema).parquet(path)


def _per_batch(spark, folder):
    """English documents arrive as the first batch of text files, all others as the second."""
    source, path, checkpoint = (new_folder(spark, label) for label in ("text-in", "counts", "checkpoint"))
    documents = table(spark, folder, "documents")
    for step, predicate in enumerate(("lang = 'en'", "lang <> 'en'")):
        write_lines(lines(documents.where(predicate)).select("value"), f"{source}/{step}")
        word_counts.count_per_batch(stream_lines(spark, f"{source}/*"), path, checkpoint)
    return word_counts.read_per_batch(spark, path)


def _running(spark, folder):
    path, folded = new_folder(spark, "totals"), new_folder(spark, "totals")
    word_counts.count_running(stream_of(spark, folder, "documents"), path, new_folder(spark, "checkpoint"), "text")
    word_counts.fold_running(spark, path, folded)
    return word_counts.read_running(spark, folded)


def _running_complete(spark, folder):
    path = new_folder(spark, "totals")
    word_counts.count_running_complete(stream_of(spark, folder, "documents"), path, new_folder(spark, "checkpoint"), "text")
    return word_counts.read_last_snapshot(spark, path)


def _upsert(spark, folder):
    clicks = delimited_fields(click_messages(stream_of(spark, folder, "events")),
                              spark.createDataFrame([], CLICK_SCHEMA).schema)
    target = KeyedTable(new_folder(spark, "clicks"), "row_key", ("clickinfo.time", "clickinfo.studentid"))
    for_each_batch(click_rows(clicks), target.put, new_folder(spark, "checkpoint"))
    target = target.compact(spark, new_folder(spark, "clicks"))
    return target.read(spark).select("row_key", "clickinfo.*", "iteminfo.*")


def _quote_merge(spark, folder):
    path, checkpoint = new_folder(spark, "quotes"), new_folder(spark, "checkpoint")
    quotes.open_quotes(spark, path, buckets=1)  # a date's quotes are few
    quotes.add_quotes(ev.quotes(quote_messages(first_half(table(spark, folder, "events")))), path)
    quotes.stream_quotes(ev.quotes(quote_messages(stream_of(spark, folder, "events"))), path, checkpoint)
    return wide(quotes.read_quotes(spark, path))


QUERIES = {
    "stream_to_files": _to_files,
    "cdc_unpack_stream": _cdc,
    "stream_word_count_per_batch": _per_batch,
    "stream_word_count_running": _running,
    "stream_word_count_running_complete": _running_complete,
    "stream_keyed_upsert": _upsert,
    "quote_merge_stream": _quote_merge,
}

# A replaced row may not depend on the cut into batches: the newest time counts, whichever batch brings it.
_PARTS = """lines AS (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents),
     parts AS (SELECT lang, unnest(string_split(line, ' ')) AS word FROM lines)"""
_RUNNING = f'WITH {_PARTS} SELECT word, count(*) AS "count" FROM parts GROUP BY word'

ORACLES = {
    "stream_to_files": "SELECT * FROM events",
    "cdc_unpack_stream": UNPACKED_SQL,
    "stream_word_count_per_batch": f"""WITH {_PARTS} SELECT CASE WHEN lang = 'en' THEN 0::bigint ELSE 1::bigint END
        AS batch_id, word, count(*) AS "count" FROM parts GROUP BY 1, 2""",
    "stream_word_count_running": _RUNNING,
    "stream_word_count_running_complete": _RUNNING,
    "stream_keyed_upsert": """SELECT 'click' || user_id AS row_key, cast(event_id AS varchar) AS studentid,
            event_type AS url, cast(ts AS varchar) AS time, event_type AS itemtype,
            CASE WHEN event_type = 'signup' THEN 'none' ELSE cast(value AS varchar) END AS quantity
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, cast(event_id AS varchar) DESC) AS rn
              FROM events WHERE event_type <> 'error') WHERE rn = 1""",
    "quote_merge_stream": QUOTES_SQL,
}
