"""Unit-reliability jobs over line items joined to parts, and group counts over parts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkloom.bindings.inputs import sold_units, table, unit_stats, wide
from sparkloom.operators.setops import union_common_columns
from sparkloom.plans import catalog
from sparkloom.plans import reliability as rel
from sparkloom.sinks.files import write_delimited
from sparkloom.sources.files import read_delimited_sets
from sparkloom.workspace import new_folder


def _elements(spark, folder):
    return table(spark, folder, "part").select(F.col("p_type").alias("phase"), F.col("p_size").alias("period"))


def _union(spark, folder):
    """Orders as three delimited sets whose columns differ in number and order."""
    orders = table(spark, folder, "orders")
    sets = [orders.where("o_orderstatus = 'F'").drop("o_orderpriority"),
            orders.where("o_orderstatus = 'O'").select("o_totalprice", "o_custkey", "o_orderkey", "o_orderstatus"),
            orders.where("o_orderstatus NOT IN ('F', 'O')").withColumn("extra", F.lit("x"))]
    paths = [new_folder(spark, "orders-set") for _ in sets]
    for frame, path in zip(sets, paths):
        write_delimited(frame, path)
    read = read_delimited_sets(spark, paths)
    merged = union_common_columns(read, ("o_orderkey", "o_custkey", "o_totalprice"))
    return merged.selectExpr("try_cast(o_orderkey AS bigint) AS o_orderkey", "try_cast(o_custkey AS bigint) AS o_custkey",
                             "o_orderstatus", "try_cast(o_totalprice AS double) AS o_totalprice")


def _reliable(spark, folder):
    return rel.reliable_for_capacity(rel.capacity_failure_rates(unit_stats(spark, folder)), 30.0, 0.25, 3)


def _normalised(spark, folder):
    return rel.normalise_capacity(sold_units(spark, folder))


QUERIES = {
    "failed_serials": lambda s, d: rel.failed_units(unit_stats(s, d), "status = 'R'"),
    "capacity_range_by_model": lambda s, d: rel.capacity_range_by_model(unit_stats(s, d)),
    "capacity_range_by_model_sql": lambda s, d: rel.capacity_range_by_model_sql(unit_stats(s, d)),
    "failure_counts_left": lambda s, d: rel.failure_counts(unit_stats(s, d)),
    "failure_counts_left_views": lambda s, d: rel.failure_counts_by_views(unit_stats(s, d), f"unit_{uuid.uuid4().hex}"),
    "failure_rate": lambda s, d: rel.failure_rate(unit_stats(s, d)),
    "failure_rate_subquery": lambda s, d: rel.failure_rate_by_subquery(unit_stats(s, d)),
    "failure_rate_cte": lambda s, d: rel.failure_rate_by_cte(unit_stats(s, d)),
    "failure_rate_single_pass": lambda s, d: rel.failure_rate_all_models(unit_stats(s, d)),
    "capacity_failure_rates": lambda s, d: rel.capacity_failure_rates(unit_stats(s, d)),
    "reliable_for_capacity": _reliable,
    "average_unit_age": lambda s, d: rel.average_unit_age(unit_stats(s, d)),
    "first_of_month_capacity": lambda s, d: rel.first_of_month_capacity(unit_stats(s, d)),
    "modal_capacity": lambda s, d: rel.modal_capacity(sold_units(s, d)),
    "normalise_capacity": _normalised,
    "union_common_columns": _union,
    "phase_counts": lambda s, d: wide(catalog.group_counts(_elements(s, d), "PROMO")),
    "phase_counts_sql": lambda s, d: wide(catalog.group_counts_sql(_elements(s, d), "PROMO", f"elements_{uuid.uuid4().hex}")),
}

_STATS = """stats AS (SELECT l_partkey AS serial_number, cast(l_shipdate AS date) AS date, p_brand AS model,
        cast(p_size AS bigint) * 1073741824 AS capacity_bytes, 
        CASE WHEN l_returnflag = 'R' AND p_brand NOT LIKE '%5' THEN 1 ELSE 0 END AS failure, l_returnflag AS status
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_RANGE = f"""WITH {_STATS} SELECT model, min(capacity_bytes / pow(1024, 3)) AS min_gb,
    max(capacity_bytes / pow(1024, 3)) AS max_gb FROM stats GROUP BY model HAVING min_gb <> max_gb"""
_LEFT = f"""WITH {_STATS} SELECT model, drive_days, failures
    FROM (SELECT model, count(*) AS drive_days FROM stats GROUP BY model)
    LEFT JOIN (SELECT model, count(*) AS failures FROM stats WHERE failure = 1 GROUP BY model) USING (model)"""
_RATE = f"""WITH {_STATS} SELECT model, failures / drive_days AS failure_rate
    FROM (SELECT model, count(*) AS drive_days FROM stats GROUP BY model)
    JOIN (SELECT model, count(*) AS failures FROM stats WHERE failure = 1 GROUP BY model) USING (model)"""
_RATES = f"""{_STATS}, rates AS (SELECT model, capacity_bytes / pow(1024, 3) AS "capacity_GB",
        sum(failure) / count(*) AS failure_rate FROM stats GROUP BY model, capacity_bytes)"""
_MODAL = f"""{_STATS}, units AS (SELECT DISTINCT serial_number, model, capacity_bytes FROM stats),
    counts AS (SELECT model, capacity_bytes, count(*) AS n FROM units GROUP BY ALL),
    modal AS (SELECT model, capacity_bytes FROM counts
              WHERE (model, n) IN (SELECT (model, max(n)) FROM counts GROUP BY model))"""
_PHASE = """SELECT cast(p_size AS bigint) AS period, count(*) AS "count" FROM part
    WHERE p_type = 'PROMO' GROUP BY p_size"""

ORACLES = {
    "failed_serials": f"WITH {_STATS} SELECT serial_number FROM stats WHERE status = 'R'",
    "capacity_range_by_model": _RANGE,
    "capacity_range_by_model_sql": _RANGE,
    "failure_counts_left": _LEFT,
    "failure_counts_left_views": _LEFT,
    "failure_rate": _RATE,
    "failure_rate_subquery": _RATE,
    "failure_rate_cte": _RATE,
    "failure_rate_single_pass": f"""WITH {_STATS} SELECT model, cast(sum(failure) AS bigint) AS failures,
        count(*) AS drive_days, sum(failure) / count(*) AS failure_rate FROM stats GROUP BY model""",
    "capacity_failure_rates": f"WITH {_RATES} SELECT * FROM rates",
    "reliable_for_capacity": f"""WITH {_RATES} SELECT * FROM rates
        WHERE "capacity_GB" BETWEEN 30.0 / 1.25 AND 30.0 * 1.25
        ORDER BY failure_rate, "capacity_GB" DESC, model LIMIT 3""",
    "average_unit_age": f"""WITH {_STATS}, units AS (SELECT serial_number, model, capacity_bytes,
            date_diff('day', min(date), max(date)) AS age FROM stats GROUP BY ALL)
        SELECT model, capacity_bytes / pow(1024, 3) AS "capacity_GB", avg(age) AS avg_age
        FROM units GROUP BY model, capacity_bytes""",
    "first_of_month_capacity": f"""WITH {_STATS} SELECT date, sum(capacity_bytes) / pow(1024, 4) AS "capacity_TB"
        FROM stats WHERE extract(day FROM date) = 1 GROUP BY date""",
    "modal_capacity": f"WITH {_MODAL} SELECT * FROM modal",
    "normalise_capacity": f"""WITH {_MODAL} SELECT serial_number, model, modal.capacity_bytes
        FROM units JOIN modal USING (model)""",
    "union_common_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "phase_counts": _PHASE,
    "phase_counts_sql": _PHASE,
}
