"""Relational tables over JDBC. The caller supplies the address and credentials; none are stored here."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    url: str
    driver: str
    user: str | None = None
    password: str | None = None

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return options


@dataclass(frozen=True)
class Slices:
    """Split a read into parallel range queries on a number, date or timestamp column.

    The bounds only place the cuts: rows outside them are still read, by the first and last slice.
    """
    column: str
    lower: str | int
    upper: str | int
    count: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower),
                "upperBound": str(self.upper), "numPartitions": str(self.count)}


def read_options(connection: Connection, table: str, slices: Slices | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {**connection.options(), "dbtable": table, "fetchsize": str(fetch_size)}
    if slices:
        options.update(slices.options())
    return options


def read_relation(spark: SparkSession, connection: Connection, table: str, slices: Slices | None = None) -> DataFrame:
    """Table over JDBC; without slices it is read through one connection by one task."""
    return spark.read.format("jdbc").options(**read_options(connection, table, slices)).load()
