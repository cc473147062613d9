"""A keyed table where a later put replaces an earlier one.

Each batch is one folder holding the last row per key, so a put costs the size of the batch and not of
the table, and replaying a batch rewrites its own folder only. Reading keeps the newest row per key, by the
order columns first and by the batch only between equal ones, so the cut into batches does not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLD = -1  # the batch number of folded rows, below every batch

# Key prefix and the two column groups of a click record.
CLICK_KEY_PREFIX = "click"
CLICK_SCHEMA = "serial_id string, studentid string, url string, time string, itemtype string, quantity string"
CLICK_GROUPS = {"clickinfo": ["studentid", "url", "time"], "iteminfo": ["itemtype", "quantity"]}


def click_rows(clicks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Click messages as keyed rows with one struct per column group."""
    key = F.concat(F.lit(CLICK_KEY_PREFIX), "serial_id").alias("row_key")
    return clicks.select(key, *[F.struct(*names).alias(group) for group, names in CLICK_GROUPS.items()], *keep)


def newest(frame: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The last row of each key by `order`; Spark keeps one row a key in each task before the shuffle."""
    latest = Window.partitionBy(key).orderBy(F.struct(*order).desc())
    return frame.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")


@dataclass(frozen=True)
class KeyedTable:
    path: str
    key: str
    order: tuple[str, ...]

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch; the same id again replaces what that batch stored before."""
        newest(batch, self.key, list(self.order)).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession, schema: str | T.StructType | None = None) -> DataFrame:
        """The newest row of each key; with a schema, also of a table that no batch was put into yet."""
        return self._newest(spark, schema).drop("batch_id")

    def compact(self, spark: SparkSession, path: str) -> KeyedTable:
        """Fold all batches into one, in a new folder; later batches go on there.

        The fold is stored below every batch number, so that no batch that Spark replays can overwrite it.
        """
        target = KeyedTable(path, self.key, self.order)
        self._newest(spark).drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={FOLD}")
        return target

    def _newest(self, spark: SparkSession, schema: str | T.StructType | None = None) -> DataFrame:
        if schema is not None:
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            if not self._has_batches(spark):
                return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(FOLD))
        return newest(spark.read.parquet(self.path), self.key, [*self.order, "batch_id"])

    def _has_batches(self, spark: SparkSession) -> bool:
        try:
            return bool(spark.read.parquet(self.path).columns)
        except AnalysisException as problem:
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
