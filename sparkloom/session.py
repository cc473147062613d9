"""Session builder with the settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins and coalesces partitions from real sizes. Forcing the skew rewrite lets it split
# a hot join partition even where that costs one more exchange before the next aggregate.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # Streaming state outside the heap; each batch checkpoints its changes only.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None,
                  hive: bool = False, extra: dict[str, str] | None = None) -> SparkSession:
    """Build or fetch a session.

    `hive=True` asks for a persistent catalog; the default is Spark's in-memory catalog, which needs
    no metastore. Leave `shuffle_partitions` unset on a cluster and let its own configuration decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
