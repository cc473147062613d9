"""File round trips, tidying, profiling and tolerant conversion."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkloom.bindings.inputs import clock_text, stamp_text, table, wide
from sparkloom.functions import scalars
from sparkloom.functions.maps import map_pairs, map_value, pairs_map, row_map
from sparkloom.operators import shaping, summaries
from sparkloom.plans.text import lines
from sparkloom.sinks import files as sink
from sparkloom.sources import files as source
from sparkloom.workspace import new_folder


def _csv_pipe(spark, folder):
    path = new_folder(spark, "orders-csv")
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
                                                   "o_totalprice", "o_orderpriority")
    sink.write_delimited(orders, path, sep="|")
    return source.read_delimited(spark, path, schema=orders.schema, sep="|", date_format="yyyy-MM-dd")


def _csv_quote(spark, folder):
    path = new_folder(spark, "supplier-csv")
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", F.concat("s_name", F.lit(", nation "), "s_nationkey").alias("s_label"), "s_acctbal")
    sink.write_delimited(suppliers, path, quote="$")
    return source.read_delimited(spark, path, schema=suppliers.schema, quote="$")


def _csv_untyped(spark, folder):
    path = new_folder(spark, "supplier-csv")
    sink.write_delimited(table(spark, folder, "supplier"), path, overwrite=True)
    return source.read_delimited(spark, path)


def _text_roundtrip(spark, folder):
    path = new_folder(spark, "lines")
    sink.write_lines(lines(table(spark, folder, "documents")).select("value"), path)
    return source.read_lines(spark, path).groupBy("value").agg(F.count("*").alias("copies"))


def _json_roundtrip(spark, folder):
    path = new_folder(spark, "customer-json")
    customers = table(spark, folder, "customer")
    sink.write_json(customers, path)
    return wide(source.read_json(spark, path, customers.schema, strict=True))


def _parquet_roundtrip(spark, folder):
    path = new_folder(spark, "orders-parquet")
    orders = table(spark, folder, "orders")
    sink.write_parquet(orders, path, overwrite=True, partition_by=["o_orderstatus"])
    return source.read_parquet(spark, path).select(*orders.columns)


def _table_roundtrip(spark, folder):
    name = f"orders_{uuid.uuid4().hex}"
    sink.write_table(table(spark, folder, "orders"), name, new_folder(spark, "orders-table"))
    return source.read_table(spark, name)


def _duration_seconds(spark, folder):
    events = table(spark, folder, "events").select("event_id", clock_text().alias("duration"))
    return wide(events.withColumn("duration_seconds", scalars.duration_seconds("duration")))


def _duration_parts(spark, folder):
    clock = table(spark, folder, "events").select(clock_text().alias("duration"))
    return wide(clock.select(scalars.clock_part("duration", 1).alias("dur_hours"),
                             scalars.clock_part("duration", 4).alias("dur_minutes"),
                             scalars.clock_part("duration", 7).alias("dur_seconds")).distinct())


def _column_tidy(spark, folder):
    orders = table(spark, folder, "orders")
    return shaping.tidy(orders.toDF(*[name.upper() for name in orders.columns]), "key")


def _profile_basic(spark, folder):
    profile = summaries.profile_basic(table(spark, folder, "lineitem"))
    return profile.withColumns({name: F.round(name, 6) for name in ("mean", "stddev")})


def _profile_quantiles(spark, folder):
    return summaries.profile_quantiles(table(spark, folder, "lineitem"), fractions=(0.1, 0.25, 0.5, 0.75, 0.9))


def _profile_summary(spark, folder):
    profile = summaries.profile_summary(table(spark, folder, "lineitem"))
    return profile.withColumns({name: F.round(name, 6) for name in ("mean", "stddev")})


def _csv_hard(spark, folder):
    """Line breaks, quotes, empty strings and nulls."""
    path = new_folder(spark, "documents-csv")
    documents = table(spark, folder, "documents").select(
        "doc_id", F.concat("source", F.lit(', "'), "lang", F.lit('"')).alias("label"),
        F.when(F.col("lang") == "de", F.lit("")).when(F.col("lang") != "fr", F.col("text")).alias("text"))
    sink.write_delimited(documents, path)
    return source.read_delimited(spark, path, schema=documents.schema, multi_line=True)


def _csv_inferred(spark, folder):
    path = new_folder(spark, "supplier-csv")
    sink.write_delimited(table(spark, folder, "supplier"), path, sep=";")
    return wide(source.read_delimited(spark, path, sep=";", infer=True))


def _text_glob(spark, folder):
    """Two directories of text files, read by one pattern."""
    path = new_folder(spark, "lines")
    documents = table(spark, folder, "documents")
    for name, predicate in (("english", "lang = 'en'"), ("other", "lang <> 'en'")):
        sink.write_lines(lines(documents.where(predicate)).select("value"), f"{path}/{name}")
    return source.read_lines(spark, f"{path}/*/part-*").groupBy("value").agg(F.count("*").alias("copies"))


def _json_documents(spark, folder):
    """One JSON document per file: an array of up to 500 customers, written over several lines."""
    path = new_folder(spark, "customer-json")
    customers = table(spark, folder, "customer")
    grouped = customers.groupBy(F.floor(F.col("c_custkey") / 500).alias("file")).agg(
        F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value"))
    grouped.select("file", F.replace("value", F.lit("},{"), F.lit("},\n{")).alias("value")).write.partitionBy("file").text(path)
    return wide(source.read_json(spark, f"{path}/file=*", customers.schema, whole_file=True, strict=True))


def _cast_by_prefix(spark, folder):
    customers = table(spark, folder, "customer")
    text = customers.select(*[F.col(name).cast("string").alias(name) for name in customers.columns])
    renamed = text.withColumnsRenamed({"c_custkey": "smart_key", "c_acctbal": "smart_balance", "c_name": "smart_name"})
    return shaping.cast_by_prefix(renamed, "smart", "bigint")


def _safe_convert(spark, folder):
    events = table(spark, folder, "events")
    mixed = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("user_id").cast("string"))
    day = F.when(F.col("event_type") == "click", "2024-13-45").otherwise(F.substring(stamp_text(), 1, 10))
    return events.select("event_id", "ts", mixed.alias("number"), day.alias("day")).select(
        "event_id", scalars.safe_convert("number", "bigint").alias("number"),
        scalars.safe_convert("day", "date").alias("day"),
        scalars.or_default(scalars.safe_convert("number", "bigint"), -1).alias("number_or_default"),
        scalars.text_or_empty(scalars.safe_convert("number", "bigint")).alias("number_text"),
        scalars.safe_convert("ts", "date").alias("stamp_day"))


def _scaled_text(spark, folder):
    mixed = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return table(spark, folder, "events").select("event_id", mixed.alias("value")).select(
        "event_id", scalars.scaled_text("value", 1).alias("one"), scalars.scaled_text("value", 3).alias("three"))


def _null_safe_aggregates(spark, folder):
    cents = F.when(F.col("event_type") != "error", F.round(F.col("value") * 100).cast("bigint"))
    events = table(spark, folder, "events").select("user_id", "event_id", cents.alias("cents"))
    return summaries.null_safe_summary(events, "user_id", "cents", "event_id")


def _map_pairs(spark, folder):
    nations = table(spark, folder, "customer").select(
        "c_custkey", row_map(["c_name", "c_mktsegment", "c_nationkey"]).alias("m"))
    there_and_back = nations.select("c_custkey", map_pairs("m").alias("pairs")).withColumn("m", pairs_map("pairs"))
    return there_and_back.select(
        "c_custkey", F.array_join(F.transform("pairs", lambda p: F.concat_ws("=", p["key"], p["value"])), ";").alias("pairs"),
        map_value("m", "c_name").alias("name"), map_value("m", "absent").alias("absent"))


QUERIES = {
    "csv_roundtrip_pipe": _csv_pipe,
    "csv_quote": _csv_quote,
    "csv_untyped": _csv_untyped,
    "csv_roundtrip_hard": _csv_hard,
    "csv_inferred": _csv_inferred,
    "text_glob": _text_glob,
    "json_documents": _json_documents,
    "text_roundtrip": _text_roundtrip,
    "jsonl_roundtrip": _json_roundtrip,
    "parquet_roundtrip": _parquet_roundtrip,
    "table_roundtrip": _table_roundtrip,
    "duration_seconds": _duration_seconds,
    "duration_parts": _duration_parts,
    "column_tidy": _column_tidy,
    "profile_basic": _profile_basic,
    "profile_quantiles": _profile_quantiles,
    "profile_summary": _profile_summary,
    "cast_by_prefix": _cast_by_prefix,
    "safe_convert": _safe_convert,
    "scaled_text": _scaled_text,
    "null_safe_aggregates": _null_safe_aggregates,
    "map_pairs": _map_pairs,
}

_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEXTS = ["l_returnflag", "l_linestatus"]


def _basic_sql() -> str:
    numbers = [f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, cast(min({c}) AS varchar) AS "min", cast(max({c}) AS varchar) AS "max"
        FROM lineitem""" for c in _NUMBERS]
    texts = [f"""SELECT '{c}', count({c}), cast(NULL AS double), cast(NULL AS double), min({c}), max({c})
        FROM lineitem""" for c in _TEXTS]
    return " UNION ALL ".join(numbers + texts)


def _quantile_sql() -> str:
    def one(c: str) -> str:
        marks = ", ".join(f"cast(quantile_disc({c}, {p / 100}) AS double) AS p{p}" for p in (10, 25, 50, 75, 90))
        return f"""SELECT '{c}' AS "column", cast(min({c}) AS double) AS "min", {marks},
            cast(max({c}) AS double) AS "max" FROM lineitem"""
    return " UNION ALL ".join(one(c) for c in _NUMBERS)


def _summary_sql() -> str:
    marks = ", ".join(f"q.p{p}" for p in (25, 50, 75))
    return f"""WITH b AS ({_basic_sql()}), q AS ({_quantile_sql()})
        SELECT b.*, {marks} FROM b LEFT JOIN q ON b."column" = q."column\""""


ORACLES = {
    "csv_roundtrip_pipe": """SELECT o_orderkey, cast(o_orderdate AS date) AS o_orderdate, o_totalprice,
        o_orderpriority FROM orders""",
    "csv_quote": """SELECT s_suppkey, s_name || ', nation ' || cast(s_nationkey AS varchar) AS s_label, s_acctbal
        FROM supplier""",
    "csv_untyped": """SELECT cast(s_suppkey AS varchar) AS s_suppkey, s_name,
        cast(s_nationkey AS varchar) AS s_nationkey, cast(s_acctbal AS varchar) AS s_acctbal FROM supplier""",
    "csv_roundtrip_hard": """SELECT doc_id, source || ', "' || lang || '"' AS label,
        CASE WHEN lang = 'de' THEN '' WHEN lang <> 'fr' THEN text END AS text FROM documents""",
    "csv_inferred": "SELECT s_suppkey, s_name, cast(s_nationkey AS bigint) AS s_nationkey, s_acctbal FROM supplier",
    "text_glob": """SELECT value, count(*) AS copies
        FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""",
    "json_documents": """SELECT c_custkey, c_name, cast(c_nationkey AS bigint) AS c_nationkey, c_acctbal,
        c_mktsegment FROM customer""",
    "text_roundtrip": """SELECT value, count(*) AS copies
        FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""",
    "jsonl_roundtrip": """SELECT c_custkey, c_name, cast(c_nationkey AS bigint) AS c_nationkey, c_acctbal,
        c_mktsegment FROM customer""",
    "parquet_roundtrip": "SELECT * FROM orders",
    "table_roundtrip": "SELECT * FROM orders",
    "duration_seconds": """SELECT event_id, strftime(ts, '%H:%M:%S') AS duration,
        hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS duration_seconds FROM events""",
    "duration_parts": """SELECT DISTINCT hour(ts) AS dur_hours, minute(ts) AS dur_minutes, second(ts) AS dur_seconds
        FROM events""",
    "column_tidy": "SELECT o_orderdate, o_orderpriority, o_orderstatus, o_totalprice FROM orders",
    "profile_basic": _basic_sql(),
    "profile_quantiles": _quantile_sql(),
    "profile_summary": _summary_sql(),
    "cast_by_prefix": """SELECT c_custkey AS smart_key, cast(NULL AS bigint) AS smart_name,
        cast(c_nationkey AS varchar) AS c_nationkey, cast(NULL AS bigint) AS smart_balance, c_mktsegment
        FROM customer""",
    "safe_convert": """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS number,
        CASE WHEN event_type <> 'click' THEN cast(ts AS date) END AS day,
        CASE WHEN event_type <> 'error' THEN user_id ELSE -1 END AS number_or_default,
        CASE WHEN event_type <> 'error' THEN cast(user_id AS varchar) ELSE '' END AS number_text,
        cast(ts AS date) AS stamp_day FROM events""",
    "scaled_text": """SELECT event_id, CASE WHEN event_type <> 'error' THEN printf('%.1f', value) ELSE '' END AS one,
        CASE WHEN event_type <> 'error' THEN printf('%.3f', value) ELSE '' END AS three FROM events""",
    "null_safe_aggregates": """WITH e AS (SELECT user_id, event_id,
            CASE WHEN event_type <> 'error' THEN cast(round(value * 100) AS bigint) END AS cents FROM events)
        SELECT user_id, cast(sum(cents) AS bigint) AS "sum", avg(cents) AS "avg", count(cents) AS "count",
            min(cents) AS "min", max(cents) AS "max",
            arg_min(cents, event_id) FILTER (WHERE cents IS NOT NULL) AS "first",
            arg_max(cents, event_id) FILTER (WHERE cents IS NOT NULL) AS "last"
        FROM e GROUP BY user_id""",
    "map_pairs": """SELECT c_custkey, 'c_mktsegment=' || c_mktsegment || ';c_name=' || c_name
        || ';c_nationkey=' || cast(c_nationkey AS varchar) AS pairs, c_name AS name,
        cast(NULL AS varchar) AS absent FROM customer""",
}
