"""Programme-log jobs over line items, suppliers, parts, orders and nations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.bindings.inputs import (COMMERCIAL, PARTIAL, log_categories, log_channels, log_classes, log_facts,
                                       log_identifiers, table, wide)
from sparkloom.operators import joins
from sparkloom.plans import star


def _log(spark, folder, categories=False, channels=False):
    return star.full_log(
        log_facts(spark, folder), log_identifiers(spark, folder), log_classes(spark, folder),
        log_categories(spark, folder) if categories else None, log_channels(spark, folder) if channels else None)


def _class_ratio(spark, folder):
    return star.commercial_ratio(_log(spark, folder), COMMERCIAL)


def _channel_ratio(spark, folder):
    return star.channel_ratio(_log(spark, folder, channels=True), COMMERCIAL)


def _weighted(spark, folder):
    return star.channel_ratio(_log(spark, folder, channels=True), COMMERCIAL, PARTIAL)


def _histogram(spark, folder):
    shares = star.commercial_share(_log(spark, folder, channels=True), ["channel_id", "channel_name"],
                                   COMMERCIAL, PARTIAL)
    return star.ratio_histogram(shares)


def _orders_customers(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "custkey")
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "custkey")
    return orders, customers


def _documents_labels(spark, folder):
    return table(spark, folder, "documents"), table(spark, folder, "labels")


def _spread(spark, folder):
    """Events with their type's mean value; each of the few types is a hot key."""
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    means = events.groupBy("event_type").agg(F.count("*").alias("events"), F.min("value").alias("lowest"))
    return joins.lookup_join(events, means, "event_type", hot=joins.hot_keys(events, "event_type"))


QUERIES = {
    "star_duration_by_class": lambda s, d: star.duration_by_class(_log(s, d)),
    "star_duration_by_category": lambda s, d: star.duration_by(_log(s, d, categories=True), "class_code", "category_name"),
    "commercial_ratio": _class_ratio,
    "commercial_ratio_dropna": lambda s, d: star.known_ratios(_class_ratio(s, d)),
    "commercial_ratio_filled": lambda s, d: star.filled_ratios(_class_ratio(s, d)),
    "channel_ratio": lambda s, d: wide(_channel_ratio(s, d)),
    "weighted_channel_ratio": lambda s, d: wide(_weighted(s, d)),
    "ratio_histogram": _histogram,
    "join_disambiguation": lambda s, d: wide(joins.lookup_join(*_orders_customers(s, d), "custkey")),
    "join_by_reference": lambda s, d: wide(joins.join_on_reference(*_orders_customers(s, d), "custkey", "custkey")),
    "join_by_alias": lambda s, d: wide(joins.join_on_alias(*_orders_customers(s, d), "custkey", "custkey")),
    "join_spread": _spread,
    "anti_join": lambda s, d: joins.keys_without_match(*_documents_labels(s, d), "doc_id"),
    "anti_join_null_form": lambda s, d: joins.keys_without_match_by_null(*_documents_labels(s, d), "doc_id"),
}

_LOG = """log AS (SELECT CASE WHEN l.l_linenumber = 7 THEN 0 ELSE cast(l.l_quantity AS bigint) END AS duration, s.s_nationkey AS channel_id,
        n.n_name AS channel_name, p.p_type AS class_code, p.p_brand AS class_name, o.o_orderpriority AS category_name
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey AND s.s_acctbal > 5000
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey AND l.l_linenumber <> 7)"""
_FULL = "coalesce(sum(CASE WHEN class_code IN ('PROMO', 'SMALL') THEN duration ELSE 0 END), 0)"
_CLASSES = f"""WITH {_LOG}, sums AS (SELECT class_code, class_name,
        cast({_FULL} AS bigint) AS duration_commercial, cast(sum(duration) AS bigint) AS duration_total
    FROM log GROUP BY class_code, class_name)
    SELECT *, duration_commercial / nullif(duration_total, 0) AS commercial_ratio FROM sums"""
_WEIGHTED = """sum(CASE WHEN class_code IN ('PROMO', 'SMALL') THEN cast(duration AS double)
    WHEN class_code = 'ECONOMY' THEN duration * 0.75::double ELSE 0 END)"""


def _channels(commercial: str) -> str:
    return f"""WITH {_LOG}, sums AS (SELECT cast(channel_id AS bigint) AS channel_id, channel_name,
        {commercial} AS duration_commercial, cast(sum(duration) AS bigint) AS duration_total
    FROM log GROUP BY channel_id, channel_name),
    shares AS (SELECT *, coalesce(duration_commercial / nullif(duration_total, 0), 0) AS commercial_ratio FROM sums)"""


_JOINED = """SELECT o_custkey AS custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    c_name, cast(c_nationkey AS bigint) AS c_nationkey, c_acctbal, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey"""
_UNMATCHED = """SELECT DISTINCT doc_id FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

ORACLES = {
    "star_duration_by_class": f"""WITH {_LOG} SELECT class_code, class_name,
        cast(sum(duration) AS bigint) AS duration_total FROM log GROUP BY class_code, class_name""",
    "star_duration_by_category": f"""WITH {_LOG} SELECT class_code, category_name,
        cast(sum(duration) AS bigint) AS duration_total FROM log GROUP BY class_code, category_name""",
    "commercial_ratio": _CLASSES,
    "commercial_ratio_dropna": f"SELECT * FROM ({_CLASSES}) WHERE commercial_ratio IS NOT NULL",
    "commercial_ratio_filled": f"""SELECT class_code, class_name, coalesce(duration_commercial, 0) AS duration_commercial,
        coalesce(duration_total, 0) AS duration_total, coalesce(commercial_ratio, 0) AS commercial_ratio FROM ({_CLASSES})""",
    "channel_ratio": f"{_channels(f'cast({_FULL} AS bigint)')} SELECT * FROM shares",
    "weighted_channel_ratio": f"{_channels(_WEIGHTED)} SELECT * FROM shares",
    "ratio_histogram": f"""{_channels(_WEIGHTED)} SELECT round(commercial_ratio, 1) AS ratio, count(*) AS "count"
        FROM shares GROUP BY 1""",
    "join_disambiguation": _JOINED,
    "join_by_reference": _JOINED,
    "join_by_alias": _JOINED,
    "join_spread": """SELECT event_id, event_type, value, count(*) OVER (PARTITION BY event_type) AS events,
        min(value) OVER (PARTITION BY event_type) AS lowest FROM events""",
    "anti_join": _UNMATCHED,
    "anti_join_null_form": _UNMATCHED,
}
