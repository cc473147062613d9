"""A keyed table that takes creations, updates and deletions, in any order and more than once.

Every batch is a run: the last change of each of its keys, a deletion being kept as a mark. A run is dealt into
buckets by the key's hash, sorted by key, and written as Parquet with a Bloom filter on the key, so that minimum,
maximum and filter of each file say whether a key can be in it. Runs have levels: when a level has `fanout` of them
they are merged into one run of the next, so a read meets at most `fanout - 1` runs of each level, and a change is
rewritten once a level. The runs that are the table are named by a manifest (see `manifest`).

Changes are ordered by the order columns and not by their batch, so neither the cut into batches nor late or repeated
ones matter. A batch that has been applied is recognised by its number and left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.streaming.manifest import Manifest, Version
from sparkloom.workspace import Store


@dataclass(frozen=True)
class ChangeTable:
    """`schema` (DDL) has the row's columns, the key and the order columns among them; `buckets` never changes."""

    path: str
    schema: str
    key: str
    order: tuple[str, ...]
    buckets: int = 16
    fanout: int = 4

    def apply(self, changes: DataFrame, batch_id: int, stream: str = "changes") -> bool:
        """Store a batch of rows with a boolean column `deleted`; false if the batch was applied before.

        Batch numbers of a stream must grow. Of equal keys with equal order columns a deletion wins, then the row
        with the larger values. Rows below the floor (see `compact`) are left out.
        """
        spark, manifest = changes.sparkSession, Manifest(self.path)
        before = manifest.current(spark)
        content = dict(before.content)
        if batch_id <= content.get("batches", {}).get(stream, -1):
            return False
        rows = changes.select(*self._names(), F.coalesce("deleted", F.lit(False)).alias("deleted"))
        if content.get("floor") is not None:
            rows = rows.where(~self._below(content["floor"]))
        name = f"runs/run={stream}-{batch_id}"
        runs, retired = content.get("runs", []), []
        if self._store(spark, self._newest(rows), name):
            runs, retired = self._levelled(spark, [*runs, {"name": name, "level": 0}], before.number + 1)
        content |= {"runs": runs, "batches": {**content.get("batches", {}), stream: batch_id}}
        manifest.publish(spark, before, content, retired)
        return True

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows that are not deleted, of the newest version or of one that is still kept."""
        return self._rows(self._newest(self._runs(spark, self._version(spark, version))))

    def lookup(self, spark: SparkSession, key, version: int | None = None) -> DataFrame:
        """The row of one key: only its bucket is opened, and in it only files that can hold the key."""
        value = F.lit(key).cast(self._types()[self.key].dataType)
        runs = self._runs(spark, self._version(spark, version))
        return self._rows(self._newest(runs.where((F.col("bucket") == self._bucket(value)) & (F.col(self.key) == value))))

    def compact(self, spark: SparkSession, floor=None) -> None:
        """Merge all runs into one.

        Marks of deletions stay, since an older change may yet come. With `floor`, those whose first order column is
        below it go, and changes below it that come later are left out. The floor is written as text.
        """
        manifest = Manifest(self.path)
        before = manifest.current(spark)
        runs, content = before.content.get("runs", []), dict(before.content)
        rows = self._newest(self._runs(spark, before))
        if floor is not None:
            rows = rows.where(~(F.col("deleted") & self._below(str(floor))))
            content["floor"] = str(floor)
        name, level = f"runs/run=compacted-{before.number + 1}", max((run["level"] for run in runs), default=0)
        kept = self._store(spark, rows, name)
        content["runs"] = [{"name": name, "level": level}] if kept else []
        manifest.publish(spark, before, content, [run["name"] for run in runs])

    def _version(self, spark: SparkSession, number: int | None) -> Version:
        manifest = Manifest(self.path)
        return manifest.current(spark) if number is None else manifest.at(spark, number)

    def _types(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    def _names(self) -> list[str]:
        return self._types().names

    def _below(self, floor: str) -> Column:
        first = self.order[0]
        return F.coalesce(F.col(first) < F.lit(floor).cast(self._types()[first].dataType), F.lit(True))

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The last change of each key; Spark keeps one row a key in each task before it shuffles them."""
        ties = [f.name for f in self._types().fields if isinstance(f.dataType, T.AtomicType) and f.name not in self.order]
        latest = Window.partitionBy(self.key).orderBy(*[F.col(name).desc_nulls_last() for name in
                                                        [*self.order, "deleted", *ties]])
        return rows.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")

    def _rows(self, newest: DataFrame) -> DataFrame:
        return newest.where(~F.col("deleted")).select(*self._names())

    def _store(self, spark: SparkSession, rows: DataFrame, name: str) -> bool:
        """Write a run; a run of the same name that no version names is replaced. False if it is empty."""
        bucketed = rows.select(*self._names(), "deleted", self._bucket(F.col(self.key)).alias("bucket"))
        (bucketed.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", self.key)
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .partitionBy("bucket").parquet(f"{self.path}/{name}"))
        return any(found.startswith("bucket=") for found in Store(spark, self.path).names(f"{self.path}/{name}"))

    def _runs(self, spark: SparkSession, version: Version, names: list[str] | None = None) -> DataFrame:
        names = [run["name"] for run in version.content.get("runs", [])] if names is None else names
        schema = f"{self.schema}, deleted boolean, bucket int"
        if not names:
            return spark.createDataFrame([], schema)
        return (spark.read.schema(f"{schema}, run string").option("basePath", f"{self.path}/runs")
                .parquet(*[f"{self.path}/{name}" for name in names]).drop("run"))

    def _levelled(self, spark: SparkSession, runs: list[dict], number: int) -> tuple[list[dict], list[str]]:
        """Merge levels with `fanout` runs; the runs afterwards, and the names of those that were merged."""
        retired, level = [], 0
        while level <= max(run["level"] for run in runs):
            full = [run["name"] for run in runs if run["level"] == level]
            if len(full) >= self.fanout:
                name = f"runs/run=merged-{number}-{level + 1}"
                self._store(spark, self._newest(self._runs(spark, Version(), full)), name)
                runs = [run for run in runs if run["level"] != level] + [{"name": name, "level": level + 1}]
                retired += full
            level += 1
        return runs, retired
