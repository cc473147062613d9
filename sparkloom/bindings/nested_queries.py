"""Nested-document jobs over conversations, events, documents and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.bindings.inputs import conversation_shows, event_shows, stamp_text, table, wide
from sparkloom.functions.maps import map_value, row_map
from sparkloom.functions.messages import parse_json_strings
from sparkloom.plans import shows
from sparkloom.sinks.files import write_json
from sparkloom.sources.files import read_json
from sparkloom.workspace import new_folder


def _schema_scan(spark, folder):
    path = new_folder(spark, "shows-json")
    documents = event_shows(spark, folder)
    write_json(documents.select(F.struct(F.col("items").alias("episodes")).alias("_embedded")), path)
    read = read_json(spark, path, shows.episode_schema(), strict=True)
    episode = read.select(F.explode("_embedded.episodes").alias("e"))
    return episode.select(F.col("e.id").alias("id"), F.col("e.airdate").alias("airdate"),
                          F.unix_timestamp("e.airstamp").alias("airstamp"), F.col("e.airtime").alias("airtime"),
                          F.col("e.number").alias("number"), F.col("e.image.medium").alias("medium"))


def _explode(spark, folder):
    return shows.explode_items(conversation_shows(spark, folder), ["conv_id"]).select("conv_id", "item.*")


def _collect(spark, folder):
    line = F.transform("items", lambda i: F.concat_ws(":", i["turn"].cast("string"), i["role"], i["text"]))
    return conversation_shows(spark, folder).select("conv_id", "part", F.array_join(line, "|").alias("episodes"))


def _array_ops(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.array("lang", "source").alias("genres"))
    tour = shows.array_tour(documents, "genres", ["en", "fr", "de"], keep=("doc_id",))
    return wide(tour.select(*[F.array_join(f.name, ",").alias(f.name) if isinstance(f.dataType, T.ArrayType)
                              else F.col(f.name) for f in tour.schema.fields]))


def _map_ops(spark, folder):
    mapped = table(spark, folder, "documents").select("doc_id", row_map(["lang", "source", "n_chars"]).alias("mapped"))
    return mapped.select("doc_id", map_value("mapped", "lang").alias("by_lookup"),
                         F.col("mapped.source").alias("by_dot"), F.col("mapped")["n_chars"].alias("by_index"),
                         map_value("mapped", "none").alias("absent"))


def _pack(spark, folder):
    packed = shows.packed(table(spark, folder, "documents"), ["lang", "source", "n_chars"], keep=("doc_id",), has_watched=True)
    return packed.select("doc_id", "info.*")


def _projection(spark, folder):
    arrays = shows.nested_arrays(conversation_shows(spark, folder), ["role", "turn"], keep=("conv_id", "part"))
    return arrays.select("conv_id", "part", F.array_join("role", ",").alias("roles"),
                         F.array_join(F.transform("turn", lambda t: t.cast("string")), ",").alias("turns"))


def _table_map(spark, folder):
    maps = shows.table_map(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                           [F.floor(F.col("s_suppkey") / 100).alias("bucket")])
    return maps.select("bucket", F.explode("map").alias("s_suppkey", "s_name"))


def _tenure_flat(spark, folder):
    events = table(spark, folder, "events").select("user_id", F.substring(stamp_text(), 1, 10).cast("date").alias("day"))
    return wide(shows.tenure_days_flat(events, "user_id", "day"))


QUERIES = {
    "nested_schema_scan": _schema_scan,
    "json_strings_infer": lambda s, d: parse_json_strings(table(s, d, "events"), "props"),
    "array_ops": _array_ops,
    "map_ops": _map_ops,
    "explode_episodes": _explode,
    "posexplode_map": lambda s, d: wide(shows.key_value_rows(conversation_shows(s, d), "turn", "role", keep=("conv_id",), part="part")),
    "collect_episodes": _collect,
    "struct_pack": _pack,
    "series_tenure": lambda s, d: shows.tenure_seconds(event_shows(s, d), "airstamp", keep=("user_id",), part="part"),
    "series_tenure_dates": lambda s, d: wide(shows.tenure_days(event_shows(s, d), "airdate", keep=("user_id",), part="part")),
    "series_tenure_flat": _tenure_flat,
    "nested_projection": _projection,
    "map_from_table": _table_map,
}

ORACLES = {
    "nested_schema_scan": """SELECT cast(event_id AS varchar) AS id, cast(ts AS date) AS airdate,
        cast(floor(epoch(ts)) AS bigint) AS airstamp, strftime(ts, '%H:%M') AS airtime, event_id AS number,
        cast(NULL AS varchar) AS medium FROM events""",
    "json_strings_infer": "SELECT cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events",
    "array_ops": """SELECT doc_id, lang AS first_genre, 'en,fr,de' AS some_genres,
        concat_ws(',', lang, lang, lang, lang, lang) AS repeated_genres, 3::bigint AS some_size,
        5::bigint AS repeated_size, 'en,fr,de' AS some_distinct, lang AS repeated_distinct,
        CASE WHEN lang IN ('en', 'fr', 'de') THEN lang ELSE '' END AS genres FROM documents""",
    "map_ops": """SELECT doc_id, lang AS by_lookup, source AS by_dot, cast(n_chars AS varchar) AS by_index,
        cast(NULL AS varchar) AS absent FROM documents""",
    "explode_episodes": "SELECT conv_id, turn, role, text FROM conversations",
    "posexplode_map": """SELECT conv_id, turn, role,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations""",
    "collect_episodes": """SELECT conv_id, turn // 1000 AS part,
        string_agg(cast(turn AS varchar) || ':' || role || ':' || text, '|' ORDER BY turn) AS episodes
        FROM conversations GROUP BY 1, 2""",
    "struct_pack": "SELECT doc_id, lang, source, n_chars, true AS has_watched FROM documents",
    "series_tenure": """SELECT user_id, cast(floor(epoch(arg_max(ts, event_id))) - floor(epoch(arg_min(ts, event_id))) AS bigint) AS duration_seconds
        FROM events GROUP BY user_id""",
    "series_tenure_dates": """SELECT user_id,
        date_diff('day', min(cast(ts AS date)), max(cast(ts AS date))) AS tenure_days FROM events GROUP BY user_id""",
    "series_tenure_flat": """SELECT user_id, date_diff('day', min(cast(ts AS date)), max(cast(ts AS date))) AS tenure_days
        FROM events GROUP BY 1""",
    "nested_projection": """SELECT conv_id, turn // 1000 AS part, string_agg(role, ',' ORDER BY turn) AS roles,
        string_agg(cast(turn AS varchar), ',' ORDER BY turn) AS turns FROM conversations GROUP BY 1, 2""",
    "map_from_table": "SELECT s_suppkey // 100 AS bucket, s_suppkey, s_name FROM supplier",
}
