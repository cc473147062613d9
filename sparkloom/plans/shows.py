"""Nested show documents and their flat episode tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.scalars import first_item, item_count, last_item

PART_SIZE = 1_000


def explode_items(documents: DataFrame, keys: list[str], items: str = "items", name: str = "item") -> DataFrame:
    """One row per array entry; documents with a null or empty array disappear."""
    return documents.select(*keys, F.explode(items).alias(name))


def collect_items(flat: DataFrame, keys: list[str], ordinal: str, fields: list[str],
                  part_size: int = PART_SIZE) -> DataFrame:
    """Rows gathered into sorted arrays of structs, the inverse of `explode_items`.

    Together `keys` and `ordinal` must identify a row. Array `part` n holds the ordinals from
    n * part_size on, so a document of any length spreads over arrays of at most `part_size` entries;
    documents shorter than that are one row with part 0. Jobs that read the documents take the name of
    the part column and bring the parts together again.
    """
    part = F.expr(f"(`{ordinal}` - pmod(`{ordinal}`, {part_size}L)) div {part_size}L")
    entry = F.struct(ordinal, *[name for name in fields if name != ordinal])
    return (flat.groupBy(*keys, part.alias("part"))
            .agg(F.sort_array(F.collect_list(entry)).alias("items")))


def key_value_rows(documents: DataFrame, key: str, value: str, items: str = "items",
                   keep: tuple[str, ...] = (), part: str | None = None) -> DataFrame:
    """Two fields of an array of structs as a map, then one row per entry with its position from 0.

    Where documents come in parts (`part` names the column), positions run on from one part of the `keep` columns to
    the next; only the sizes of the parts are brought together for that.
    """
    more = [part] if part else []
    mapped = documents.select(*keep, *more, F.map_from_arrays(f"{items}.{key}", f"{items}.{value}").alias("_map"))
    rows = mapped.select(*keep, *more, F.posexplode("_map").alias("position", key, value))
    if not part:
        return rows
    earlier = Window.partitionBy(*keep).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = documents.select(*keep, part, item_count(items).alias("_n"))
    before = sizes.select(*keep, part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (rows.join(before, [*keep, part])
            .select(*keep, (F.col("position") + F.col("_before")).alias("position"), key, value))


def nested_arrays(documents: DataFrame, fields: list[str], items: str = "items", keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of an array of structs, each as an array."""
    return documents.select(*keep, *[F.col(f"{items}.{field}").alias(field) for field in fields])


def tenure_seconds(documents: DataFrame, stamp: str, items: str = "items", keep: tuple[str, ...] = (),
                   part: str | None = None) -> DataFrame:
    """Seconds between the first and the last array entry, by position, longest first.

    Where documents come in parts, the first entry of the first part and the last one of the last part of the `keep`
    columns count.
    """
    stamps = F.col(f"{items}.{stamp}")
    ends = documents.select(*keep, *([part] if part else []), F.try_to_timestamp(first_item(stamps)).alias("_first"),
                            F.try_to_timestamp(last_item(stamps)).alias("_last"))
    if part:
        ends = ends.groupBy(*keep).agg(F.min_by("_first", part).alias("_first"), F.max_by("_last", part).alias("_last"))
    return (ends.select(*keep, (F.unix_timestamp("_last") - F.unix_timestamp("_first")).alias("duration_seconds"))
            .orderBy(F.desc("duration_seconds"), *keep))


def tenure_days(documents: DataFrame, stamp: str, items: str = "items", keep: tuple[str, ...] = (),
                part: str | None = None) -> DataFrame:
    """Days between the earliest and the latest array entry, over all parts of a document."""
    stamps = F.col(f"{items}.{stamp}")
    ends = documents.select(*keep, F.array_min(stamps).alias("_first"), F.array_max(stamps).alias("_last"))
    if part:
        ends = ends.groupBy(*keep).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    return ends.select(*keep, F.datediff(F.col("_last").try_cast("date"),
                                         F.col("_first").try_cast("date")).alias("tenure_days"))


def tenure_days_flat(rows: DataFrame, key: str, stamp: str) -> DataFrame:
    """The same from a flat table, with no array built: partial minima and maxima are all that moves."""
    return rows.groupBy(key).agg(F.datediff(F.max(stamp), F.min(stamp)).alias("tenure_days"))


def array_tour(documents: DataFrame, genres: str, options: list[str], repeat: int = 5,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """First genre, a fixed list of options, their sizes, distinct forms and intersection."""
    built = documents.select(*keep, first_item(genres).alias("first_genre"),
                             F.array(*[F.lit(option) for option in options]).alias("some_genres"))
    built = built.withColumn("repeated_genres", F.array_repeat("first_genre", repeat))
    return built.select(
        *keep, "first_genre", "some_genres", "repeated_genres",
        item_count("some_genres").alias("some_size"), item_count("repeated_genres").alias("repeated_size"),
        F.array_distinct("some_genres").alias("some_distinct"),
        F.array_distinct("repeated_genres").alias("repeated_distinct"),
        F.array_intersect("some_genres", "repeated_genres").alias("genres"))


def packed(frame: DataFrame, fields: list[str], name: str = "info", keep: tuple[str, ...] = (), **literals) -> DataFrame:
    """Columns and constants packed into one struct."""
    constants = [F.lit(value).alias(key) for key, value in literals.items()]
    return frame.select(*keep, F.struct(*fields, *constants).alias(name))


def table_map(frame: DataFrame, key: str, value: str, group: list[str | Column]) -> DataFrame:
    """Rows as one map per group; a repeated or null key is an error.

    A map lives in one row, so choose groups of bounded size.
    """
    if not group:
        raise ValueError("a map of the whole table would be one row; name a group")
    entries = F.sort_array(F.collect_list(F.struct(key, value)))
    return frame.groupBy(*group).agg(F.map_from_entries(entries).alias("map"))


# Field names and types of the input format.
EPISODES = """_embedded STRUCT<episodes: ARRAY<STRUCT<
    _links: STRUCT<self: STRUCT<href: STRING>>,
    airdate: DATE, airstamp: TIMESTAMP, airtime: STRING, id: STRING,
    image: STRUCT<medium: STRING, original: STRING>,
    name: STRING, number: BIGINT, runtime: BIGINT, season: BIGINT, summary: STRING, url: STRING>>>"""


def episode_schema() -> T.StructType:
    """Declared schema of show documents: an array of episodes under `_embedded`."""
    return T.StructType.fromDDL(EPISODES)
