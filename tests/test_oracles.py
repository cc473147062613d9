"""Every registered query against its SQL on DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, connect
from sparkloom.bindings import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(tables):
    return connect(tables)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_equals_sql(spark, connection, tables, key):
    assert compare(spark, connection, tables, key) is None


def test_rules_bite(spark, tables):
    """Inputs that make a rule visible: an unknown ratio, a model without failures, a tie."""
    table = {key: queries()[key](spark, tables).collect() for key in
             ("commercial_ratio", "commercial_ratio_dropna", "failure_counts_left", "modal_capacity")}
    assert len(table["commercial_ratio_dropna"]) == len(table["commercial_ratio"]) - 1
    assert 0 < sum(row.failures is None for row in table["failure_counts_left"]) < len(table["failure_counts_left"])
    assert len({row.model for row in table["modal_capacity"]}) < len(table["modal_capacity"])
