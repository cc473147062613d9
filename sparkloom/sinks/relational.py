"""Append to a relational table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparkloom.sources.relational import Connection


def append_options(connection: Connection, table: str, connections: int = 8, batch_size: int = 10_000) -> dict[str, str]:
    """`connections` bounds how many tasks write at once, whatever the frame's partition count."""
    return {**connection.options(), "dbtable": table, "numPartitions": str(connections),
            "batchsize": str(batch_size)}


def append_relation(frame: DataFrame, connection: Connection, table: str, connections: int = 8) -> None:
    """Append all rows. Each task commits its own transaction, so a retried task may repeat rows: append
    to a staging table and merge there when the target has no unique key."""
    (frame.write.format("jdbc").options(**append_options(connection, table, connections))
     .mode("append").save())
