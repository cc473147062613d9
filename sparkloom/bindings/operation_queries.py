"""Running jobs day by day: bad records, schema versions, bucketed layouts, state, progress, profiles, catalogs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.bindings.inputs import table, wide
from sparkloom.bindings.stream_queries import _RUNNING, stream_of
from sparkloom.operators import shaping, summaries
from sparkloom.plans import catalog
from sparkloom.plans.text import part_count
from sparkloom.sinks import files as sink
from sparkloom.sources import files as source
from sparkloom.sources import quarantine
from sparkloom.streaming import word_counts
from sparkloom.streaming.progress import run_until_idle
from sparkloom.workspace import new_folder

_EVENT = "event_id bigint, user_id bigint, event_type string, value double"


def _event_lines(spark, folder, files=3):
    """Events as JSON lines in a folder; sign-ups are cut off, and errors have a text where the number should be."""
    path = new_folder(spark, "lines")
    events = table(spark, folder, "events")
    text = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    torn = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'))
    wrong = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"value":"none"}'))
    line = F.when(F.col("event_type") == "signup", torn).when(F.col("event_type") == "error", wrong).otherwise(text)
    sink.write_lines(events.select(line.alias("value")), path, files=files)
    return path


def _both(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Good and bad rows as one frame; a bad one must have a file."""
    kept = good.select("event_id", "user_id", "event_type", "value", F.lit(None).cast("string").alias("raw"))
    return kept.unionByName(bad.where("file LIKE '%part-%' AND start >= 0 AND place >= 0").select("raw"),
                            allowMissingColumns=True)


def _quarantine(spark, folder):
    typed = quarantine.json_lines(source.read_lines(spark, _event_lines(spark, folder)), _EVENT)
    good, bad = new_folder(spark, "good"), new_folder(spark, "bad")
    quarantine.store(typed, good, bad)
    return _both(spark.read.parquet(good), spark.read.parquet(bad))


def _quarantine_stream(spark, folder):
    """A file a batch; then the last batch is stored once more, as after a crash."""
    path, good, bad = _event_lines(spark, folder), new_folder(spark, "good"), new_folder(spark, "bad")
    quarantine.store_stream(source.stream_lines(spark, path, 1), lambda lines: quarantine.json_lines(lines, _EVENT),
                            good, bad, new_folder(spark, "checkpoint"))
    last = spark.read.parquet(bad).where("batch_id = 2").select(F.first("file")).first()[0]
    quarantine.store(quarantine.json_lines(source.read_lines(spark, last), _EVENT), good, bad, 2)
    return _both(spark.read.parquet(good), spark.read.parquet(bad))


def _csv_quarantine(spark, folder):
    """Orders as delimited lines; those of one status lack their last value."""
    path, orders = new_folder(spark, "lines"), table(spark, folder, "orders")
    whole = F.concat_ws(",", "o_orderkey", "o_totalprice", "o_orderpriority")
    short = F.concat_ws(",", "o_orderkey", "o_totalprice")
    sink.write_lines(orders.select(F.when(F.col("o_orderstatus") == "P", short).otherwise(whole).alias("value")), path)
    typed = quarantine.delimited_lines(source.read_lines(spark, path),
                                       "o_orderkey bigint, o_totalprice double, o_orderpriority string")
    return (quarantine.good_rows(typed).select("o_orderkey", "o_orderpriority", F.lit(True).alias("good"))
            .unionByName(quarantine.bad_rows(typed).select(F.split("raw", ",")[0].cast("bigint").alias("o_orderkey"),
                                                           F.lit(None).cast("string").alias("o_orderpriority"),
                                                           F.lit(False).alias("good"))))


def _bucketed(spark, folder):
    """Lines and orders laid out by order: neither the join nor the sums by order move a line."""
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    sink.write_bucketed(table(spark, folder, "lineitem"), names[0], "l_orderkey", 8, new_folder(spark, "bucketed"))
    sink.write_bucketed(table(spark, folder, "orders"), names[1], "o_orderkey", 8, new_folder(spark, "bucketed"))
    return bucketed_totals(*(source.read_table(spark, name) for name in names))


def bucketed_totals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    joined = lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderpriority").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
                                                               F.count("*").alias("n_lines"))


def _state(spark, folder):
    """The stream emits nothing at all; its totals are read from its state."""
    checkpoint = new_folder(spark, "checkpoint")
    counted = part_count(stream_of(spark, folder, "documents"), "text")
    counted.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
    return word_counts.read_state(spark, checkpoint)


def _interval(spark, folder):
    """A stream at an interval, a file a batch, that stops by itself: rows by its log, files, and their rows."""
    path = new_folder(spark, "events-out")
    writer = (stream_of(spark, folder, "events").writeStream.format("parquet").outputMode("append").option("path", path))
    log = run_until_idle(spark, writer, new_folder(spark, "checkpoint"), "100 milliseconds")
    none = F.lit(0).cast("long")
    stored = spark.read.parquet(path).select(none.alias("input_rows"), none.alias("batch"), F.lit(1).cast("long").alias("stored"),
                                             F.lit(None).cast("long").alias("milliseconds"))
    both = log.select("input_rows", F.lit(1).cast("long").alias("batch"), none.alias("stored"), "milliseconds").unionByName(stored)
    return both.agg(F.sum("input_rows").alias("logged"), F.sum("batch").alias("batches"), F.sum("stored").alias("stored"),
                    (F.min("milliseconds") > 0).alias("timed"))


def _versions(spark, folder):
    """Orders as three releases of a writer stored them, read in the widest schema."""
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    releases = [
        orders.where(key % 3 == 0).select(key.cast("int").alias("id"), F.col("o_totalprice").alias("price")),
        orders.where(key % 3 == 1).select(F.col("o_totalprice").cast("float").alias("price").cast("double"),
                                          key.alias("id"), F.struct(F.col("o_custkey").cast("int").alias("customer")).alias("by")),
        orders.where(key % 3 == 2).select(F.struct(F.col("o_orderpriority").alias("urgency"), F.col("o_custkey").alias(
            "customer")).alias("by"), key.alias("id")),
    ]
    stored = []
    for release in releases:
        path = new_folder(spark, "release")
        sink.write_parquet(release, path)
        stored.append((path, catalog.schema_to_text(release.schema)))
    return catalog.read_versions(spark, stored).select("id", F.round("price", 0).alias("price"), "by.customer", "by.urgency")


_FRACTIONS = (0.1, 0.5, 0.9)


def _sketch(spark, folder):
    """Whether each sketched quantile is a value whose rank is within the stated error."""
    lines = table(spark, folder, "lineitem")
    found = {row["column"]: row for row in  # a row for each column
             summaries.profile_sketch(lines, fractions=_FRACTIONS, accuracy=100).collect()}
    checks, counted = [], []
    for name in ("l_quantity", "l_extendedprice", "l_orderkey"):
        for fraction in _FRACTIONS:
            place, value = len(checks), F.lit(float(found[name][f"p{fraction * 100:g}"]))
            counted += [F.sum((F.col(name) < value).cast("bigint")).alias(f"below{place}"),
                        F.sum((F.col(name) <= value).cast("bigint")).alias(f"upto{place}")]
            rank, error = F.col("total") * fraction, F.ceil(F.col("total") / 100) + 1
            checks.append(F.struct(F.lit(name).alias("column"), F.lit(fraction).alias("fraction"), "total", (
                (F.col(f"below{place}") <= rank + error) & (F.col(f"upto{place}") >= rank - error)).alias("within")))
    return lines.agg(F.count("*").alias("total"), *counted).select(F.inline(F.array(*checks)))


def _typed_quantiles(spark, folder):
    """Whole numbers beyond 2^53 and a decimal of 30 digits."""
    lines = table(spark, folder, "lineitem").select(
        (F.lit(1 << 53) + F.col("l_orderkey")).alias("large"),
        (F.lit("123456789012345678901234").cast("decimal(30,2)") + F.col("l_quantity").cast("decimal(10,2)"))
        .cast("decimal(30,2)").alias("exact"))
    return summaries.profile_quantiles(lines, fractions=(0.25, 0.5), as_text=True)


def _column_chunks(spark, folder):
    """Orders cut into groups of columns and put together again by their key."""
    orders = table(spark, folder, "orders")
    keyed = [name for name in orders.columns if name != "o_orderkey"]
    chunks = shaping.column_chunks(keyed, 3)
    parts = [orders.select("o_orderkey", *chunk) for chunk in chunks]
    return reduce(lambda a, b: a.join(b, "o_orderkey"), parts)


def _file_count(spark, folder):
    """Rows of each of four files, added up: a set number of files holds all rows."""
    path = new_folder(spark, "four")
    sink.write_parquet(table(spark, folder, "orders"), path, files=4)
    found = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return found.agg(F.count("*").alias("files"), F.sum("n").alias("n_rows"))


def _views(spark, folder):
    """A view is listed, queried, dropped, and then a query of it says why it fails."""
    name = f"orders_{uuid.uuid4().hex}"
    catalog.register(table(spark, folder, "orders"), name)
    listed = name in catalog.view_names(spark)
    text = f"SELECT o_orderstatus, count(*) AS n FROM {name} WHERE o_totalprice > :least GROUP BY o_orderstatus"
    found, _ = catalog.try_query(spark, text, {"least": 1000.0})
    counted = found.select("o_orderstatus", "n", F.lit(listed).alias("listed"))
    stored = new_folder(spark, "counts")
    counted.write.parquet(stored)
    catalog.drop_view(spark, name)
    _, reason = catalog.try_query(spark, text, {"least": 1000.0})
    return (spark.read.parquet(stored).withColumn("gone", F.lit(name not in catalog.view_names(spark)))
            .withColumn("refused", F.lit(reason is not None and "TABLE_OR_VIEW_NOT_FOUND" in reason)))


def _schema_document(spark, folder):
    """Orders read with a schema that went to JSON text and back."""
    orders = table(spark, folder, "orders")
    text = catalog.schema_to_text(orders.schema)
    again = catalog.schema_from_text(text)
    path = new_folder(spark, "orders-json")
    sink.write_json(orders, path)
    return wide(source.read_json(spark, path, again, strict=True))


def _persistent(spark, folder):
    """A managed table in the catalog that the session has, found again by its name in the list of tables."""
    name = f"kept_{uuid.uuid4().hex}"
    sink.write_table(table(spark, folder, "nation"), name, new_folder(spark, "kept"))
    found = [t.name for t in spark.catalog.listTables() if not t.isTemporary]
    return source.read_table(spark, name).where(F.lit(name in found))


QUERIES = {
    "json_quarantine": _quarantine,
    "json_quarantine_stream": _quarantine_stream,
    "csv_quarantine": _csv_quarantine,
    "join_bucketed": _bucketed,
    "stream_word_count_from_state": _state,
    "stream_interval_batches": _interval,
    "schema_versions_union": _versions,
    "profile_sketch_ranks": _sketch,
    "profile_quantiles_typed": _typed_quantiles,
    "column_chunks": _column_chunks,
    "file_count": _file_count,
    "catalog_views": _views,
    "schema_document": _schema_document,
    "catalog_table": _persistent,
}

_BOTH = """SELECT event_id, user_id, event_type, value, NULL::varchar AS raw FROM events
    WHERE event_type NOT IN ('signup', 'error')
    UNION ALL SELECT NULL, NULL, NULL, NULL, CASE event_type
        WHEN 'signup' THEN '{"event_id":' || event_id || ',"user_id":' ELSE '{"event_id":' || event_id || ',"value":"none"}'
        END FROM events WHERE event_type IN ('signup', 'error')"""


def _nth(value: str, fraction: float, of: str) -> str:
    return f"cast(list_sort(list({value}))[cast(ceil({fraction} * count(*)) AS bigint)] AS varchar) AS {of}"


ORACLES = {
    "json_quarantine": _BOTH,
    "json_quarantine_stream": _BOTH,
    "csv_quarantine": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority,
        o_orderstatus <> 'P' AS good FROM orders""",
    "join_bucketed": """SELECT o_orderkey, o_orderpriority, sum(l_quantity::bigint)::bigint AS quantity, count(*) AS n_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "stream_word_count_from_state": _RUNNING,
    "stream_interval_batches": "SELECT count(*) AS logged, 3::bigint AS batches, count(*) AS stored, true AS timed FROM events",
    "schema_versions_union": """SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN round(o_totalprice, 0)
            WHEN 1 THEN round(cast(cast(o_totalprice AS float) AS double), 0) END AS price,
        CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS customer,
        CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS urgency FROM orders""",
    "profile_sketch_ranks": """SELECT c AS "column", f::double AS fraction, n AS total, true AS within
        FROM (SELECT count(*) AS n FROM lineitem), (VALUES ('l_quantity'), ('l_extendedprice'), ('l_orderkey')) a(c),
             (VALUES (0.1), (0.5), (0.9)) b(f)""",
    "profile_quantiles_typed": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", cast(min({value}) AS varchar) AS min, {_nth(value, 0.25, 'p25')},
            {_nth(value, 0.5, 'p50')}, cast(max({value}) AS varchar) AS max FROM lineitem"""
        for name, value in (("large", "(9007199254740992 + l_orderkey)"),
                            ("exact", "cast(123456789012345678901234::decimal(30,2) + l_quantity::decimal(10,2) AS decimal(30,2))"))),
    "column_chunks": "SELECT * FROM orders",
    "file_count": "SELECT 4::bigint AS files, count(*) AS n_rows FROM orders",
    "catalog_views": """SELECT o_orderstatus, count(*) AS n, true AS listed, true AS gone, true AS refused
        FROM orders WHERE o_totalprice > 1000 GROUP BY 1""",
    "schema_document": "SELECT * FROM orders",
    "catalog_table": "SELECT * FROM nation",
}
