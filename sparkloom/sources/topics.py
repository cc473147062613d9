"""Message topics through Spark's Kafka connector, bounded or unbounded, with the same options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(servers: str, topics: str | list[str], start: str = "earliest", end: str | None = None,
                  min_partitions: int | None = None, max_per_batch: int | None = None) -> dict[str, str]:
    """Connector options. `start` and `end` are earliest, latest or a JSON offset map.

    `min_partitions` splits large topic partitions into several tasks.
    """
    options = {"kafka.bootstrap.servers": servers,
               "subscribe": topics if isinstance(topics, str) else ",".join(topics),
               "startingOffsets": start}
    if end:
        options["endingOffsets"] = end
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bounded read: everything between the start and end offsets, `value` being binary."""
    return spark.read.format("kafka").options(**options).load()


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded read of the same topics."""
    return spark.readStream.format("kafka").options(**options).load()
