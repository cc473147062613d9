"""Test tables in the shape the jobs expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.operators.joins import lookup_join
from sparkloom.plans.shows import collect_items


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


FILE_BYTES = 64 << 20  # of a table's files that go into one file dealt from it


def file_count(spark: SparkSession, folder: str, name: str, least: int, times: int = 1) -> int:
    """How many files a table is dealt over: a multiple of `least`, each of `times` FILE_BYTES of the table at most.

    A fixed number would leave each task a fixed share of a table of any size. Only the file listing is read.
    """
    sizes = spark.read.format("binaryFile").load(f"{folder}/{name}.parquet").select(F.sum("length"))
    return least * max(1, -(-(sizes.first()[0] or 0) // (FILE_BYTES * times * least)))


def wide(frame: DataFrame) -> DataFrame:
    """Integers as bigint, the one integer type the checks use."""
    narrow = (T.IntegerType, T.ShortType, T.ByteType)
    return frame.select(*[F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, narrow)
                          else F.col(f.name) for f in frame.schema.fields])


def clock_text(stamp: str = "ts") -> Column:
    """HH:MM:SS of a timestamp without zone, which casts to text unshifted."""
    return F.substring(F.col(stamp).cast("string"), 12, 8)


def stamp_text(stamp: str = "ts") -> Column:
    return F.col(stamp).cast("string")


# Programme log -------------------------------------------------------------------------------------

COMMERCIAL = ["PROMO", "SMALL"]
PARTIAL = ["ECONOMY"]


def log_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as programmes; a seventh line has no class and no duration, so that one total is zero."""
    last = F.col("l_linenumber") == 7
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("service_id"), F.when(~last, F.col("l_partkey")).alias("class_id"),
        F.col("l_orderkey").alias("category_id"),
        F.when(last, 0).otherwise(F.col("l_quantity").cast("bigint")).cast("bigint").alias("duration"))


def log_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("service_id"), F.col("s_nationkey").alias("channel_id"),
        (F.col("s_acctbal") > 5000).cast("int").alias("primary_flag"))


def log_classes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("class_id"), F.col("p_type").alias("class_code"),
        F.col("p_brand").alias("class_name"))


def log_categories(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("category_id"), F.col("o_orderpriority").alias("category_name"))


def log_channels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("channel_id"), F.col("n_name").alias("channel_name"))


# Unit statistics -----------------------------------------------------------------------------------

def unit_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as daily rows of parts. A returned one is a failure, but models that end in 5 never fail."""
    facts = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("serial_number"), F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("status"))
    units = table(spark, folder, "part").select(
        F.col("p_partkey").alias("serial_number"), F.col("p_brand").alias("model"),
        (F.col("p_size").cast("bigint") * F.lit(1024 ** 3)).alias("capacity_bytes"))
    failed = (F.col("status") == "R") & ~F.col("model").endswith("5")
    return lookup_join(facts, units, "serial_number", "inner").withColumn("failure", failed.cast("bigint"))


def sold_units(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each unit that has daily rows; few units share a model and capacity, so modes are often tied."""
    return unit_stats(spark, folder).select("serial_number", "model", "capacity_bytes").distinct()


# Nested documents ----------------------------------------------------------------------------------

def conversation_shows(spark: SparkSession, folder: str) -> DataFrame:
    """One document per conversation: its turns as an array of structs."""
    return collect_items(table(spark, folder, "conversations"), ["conv_id"], "turn", ["role", "text"])


def event_shows(spark: SparkSession, folder: str) -> DataFrame:
    """One document per user and run of event numbers: the events as an array of episodes."""
    stamp = F.replace(stamp_text(), F.lit(" "), F.lit("T"))
    episodes = table(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("number"), F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("name"), F.substring(stamp, 1, 10).alias("airdate"),
        F.concat(stamp, F.lit("Z")).alias("airstamp"), F.substring(clock_text(), 1, 5).alias("airtime"))
    return collect_items(episodes, ["user_id"], "number", ["id", "name", "airdate", "airstamp", "airtime"])


# Messages ------------------------------------------------------------------------------------------

CHANGED_ROW = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                            T.StructField("value", T.DoubleType())])


def change_messages(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as change messages: errors are deletions, purchases updates, sign-ups insertions, others reads."""
    row = F.struct("event_id", "user_id", "value")
    op = (F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "purchase", "u")
          .when(F.col("event_type") == "signup", "c").otherwise("r"))
    payload = F.struct(
        F.when(op.isin("d", "u"), row).alias("before"), F.when(op != "d", row).alias("after"),
        F.create_map(F.lit("table"), F.lit("events")).alias("source"), op.alias("op"))
    text = F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})
    return events.select(F.encode(text, "UTF-8").alias("value"), *keep)


READINGS = ("sender string, sent string, data STRUCT<devices: ARRAY<STRUCT<device: STRING, reading: BIGINT, "
            "state: STRING>>>")


def reading_messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages of a sender with one entry for each of two devices; errors have an empty list."""
    def device(name: str, reading) -> Column:
        return F.struct(F.lit(name).alias("device"), reading.alias("reading"), F.col("event_type").alias("state"))

    devices = F.array(device("inner", F.col("event_id")), device("outer", F.col("event_id") + F.col("user_id")))
    devices = F.when(F.col("event_type") != "error", devices).otherwise(F.slice(devices, 1, 0))
    message = F.struct(F.col("user_id").cast("string").alias("sender"), stamp_text().alias("sent"),
                       F.struct(devices.alias("devices")).alias("data"))
    return events.select(F.encode(F.to_json(message), "UTF-8").alias("value"), "event_id")


def click_messages(events: DataFrame) -> DataFrame:
    """Events as six comma-separated fields; errors lack the last two, and sign-ups carry no number."""
    quantity = F.when(F.col("event_type") == "signup", "none").otherwise(F.col("value").cast("string"))
    short = F.concat_ws(",", "user_id", "event_id", "event_type", stamp_text())
    whole = F.concat_ws(",", short, "event_type", quantity)
    return events.select(F.when(F.col("event_type") == "error", short).otherwise(whole).alias("value"))


def quote_messages(events: DataFrame) -> DataFrame:
    """Events as price quotes, one symbol per event type."""
    price = F.col("value")
    quote = F.struct(F.col("event_type").alias("symbol"), F.substring(stamp_text(), 1, 10).alias("date"),
                     price.alias("open"), (price + 2).alias("high"), (price / 2).alias("low"),
                     (price + 1).alias("close"), F.col("user_id").cast("int").alias("volume"))
    return events.select(F.to_json(quote).alias("value"))
