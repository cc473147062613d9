"""Word counts over a stream of texts, in their two meanings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.plans.text import part_count
from sparkloom.streaming.runner import for_each_batch

FOLD = -1  # the batch number of folded totals, below every batch


def count_per_batch(lines: DataFrame, path: str, checkpoint: str, **timing) -> None:
    """Each micro-batch counted by itself: totals do not carry over."""
    def store(batch: DataFrame, batch_id: int) -> None:
        part_count(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    for_each_batch(lines, store, checkpoint, "append", **timing)


def read_per_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(F.col("batch_id").cast("bigint"), "word", "count")


def count_running(texts: DataFrame, path: str, checkpoint: str, column: str = "value", **timing) -> None:
    """Totals over the whole stream, where each batch emits only the words whose total changed.

    The vocabulary is state: the session's default keeps it in RocksDB and not in the heap.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    for_each_batch(part_count(texts, column), store, checkpoint, "update", **timing)


def read_running(spark: SparkSession, path: str) -> DataFrame:
    """Latest total per word: totals only grow, so it is the largest one stored."""
    return spark.read.parquet(path).groupBy("word").agg(F.max("count").alias("count"))


def fold_running(spark: SparkSession, path: str, target: str) -> None:
    """Write the totals so far to a new folder, where the stream may go on; the old one can then be deleted."""
    read_running(spark, path).write.mode("overwrite").parquet(f"{target}/batch_id={FOLD}")


def count_running_complete(texts: DataFrame, path: str, checkpoint: str, column: str = "value", **timing) -> None:
    """Totals over the whole stream, where each batch writes every word as a new snapshot.

    Two folders take turns, so that a snapshot replaces the one before the last and only two are ever kept.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("snapshot", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{path}/turn={batch_id % 2}"))

    for_each_batch(part_count(texts, column), store, checkpoint, "complete", **timing)


def read_last_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot; its number is looked up first."""
    snapshots = spark.read.parquet(path)
    last = snapshots.agg(F.max("snapshot")).first()[0]
    return snapshots.where(F.col("snapshot") == last).drop("snapshot", "turn")


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Totals as the stopped query of a checkpoint holds them in its state, without any file that it emitted.

    After the last finished batch; the state is read as one partition for each of its own.
    """
    return spark.read.format("statestore").load(checkpoint).select("key.word", "value.count")
