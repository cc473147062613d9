"""Price quotes without duplicates, as Parquet folders of a date and a symbol bucket, swapped by versions.

A batch rewrites the folders of its own dates and buckets, old rows and new ones together, under the number of the
next version; a manifest then names the newest folder of each date and bucket. So a folder is one file, or a few
where its rows are many; a reader sees a whole version; and neither reading nor writing lists the whole table. What
the driver holds is a number for each date and bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.plans.events import QUOTE_SCHEMA
from sparkloom.streaming.manifest import Manifest
from sparkloom.streaming.runner import for_each_batch
from sparkloom.workspace import passing

BUCKETS = 4  # of symbols, unless the table was opened with another number
MISSING = "none"  # the folder of quotes without a date


def open_quotes(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Publish an empty table, if there is none yet; the number of buckets of a date never changes."""
    manifest = Manifest(path)
    if manifest.current(spark).number < 0:
        manifest.publish(spark, manifest.current(spark), {"parts": {}, "buckets": buckets}, [])


def _placed(quotes: DataFrame, buckets: int) -> DataFrame:
    return quotes.withColumns({
        "quote_day": F.coalesce(F.col("date").cast("string"), F.lit(MISSING)),
        "quote_bucket": F.pmod(F.xxhash64("symbol"), F.lit(buckets)).cast("int")})


def _read(spark: SparkSession, path: str, parts: dict[str, dict[str, int]]) -> DataFrame:
    """The named folders: {day: {bucket: version}}."""
    folders = [f"{path}/v{number}/quote_day={day}/quote_bucket={bucket}"
               for day, buckets in sorted(parts.items()) for bucket, number in sorted(buckets.items())]
    return spark.read.schema(QUOTE_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], QUOTE_SCHEMA)


def read_quotes(spark: SparkSession, path: str, days: list[str] | None = None, version: int | None = None) -> DataFrame:
    """The table, or some of its days (`YYYY-MM-DD`): folders of other days are not even listed."""
    manifest = Manifest(path)
    content = (manifest.current(spark) if version is None else manifest.at(spark, version)).content
    parts = content.get("parts", {})
    return _read(spark, path, parts if days is None else {day: parts[day] for day in days if day in parts})


def add_quotes(new: DataFrame, path: str) -> None:
    """Put the quotes of a batch into the table, which need not be there yet; quotes that it holds stay single.

    Copies are dropped before rows are compared, so a heavily repeated quote moves once. Repeating a batch changes
    no row. The batch is written to the shared folder for as long as this runs.
    """
    spark, manifest = new.sparkSession, Manifest(path)
    before = manifest.current(spark)
    buckets = before.content.get("buckets", BUCKETS)
    with passing(_placed(new.select(*_names()).distinct(), buckets), "quotes") as fresh:
        touched = [(row["quote_day"], str(row["quote_bucket"])) for row in
                   fresh.select("quote_day", "quote_bucket").distinct().collect()]  # folders of one batch
        if not touched:
            return
        parts, retired, old = dict(before.content.get("parts", {})), [], {}
        number = before.number + 1
        for day, bucket in touched:
            was = parts.get(day, {}).get(bucket)
            if was is not None:
                old.setdefault(day, {})[bucket] = was
                retired.append(f"v{was}/quote_day={day}/quote_bucket={bucket}")
            parts[day] = {**parts.get(day, {}), bucket: number}
        whole = _placed(_read(spark, path, old).unionByName(fresh.select(*_names())).distinct(), buckets)
        (whole.hint("rebalance", "quote_day", "quote_bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("quote_day", "quote_bucket").parquet(f"{path}/v{number}"))
        manifest.publish(spark, before, {"parts": parts, "buckets": buckets}, retired)


def _names() -> list[str]:
    return [column.split(" ")[0] for column in QUOTE_SCHEMA.split(", ")]


def stream_quotes(quotes: DataFrame, path: str, checkpoint: str, **timing) -> None:
    """Merge every micro-batch of a quote stream into the table."""
    for_each_batch(quotes, lambda batch, _: add_quotes(batch, path), checkpoint, "update", **timing)
