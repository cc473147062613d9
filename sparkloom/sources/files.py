"""File readers. Give a schema wherever one is known: inference costs a pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Schema = T.StructType | str


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text file, directory or glob as one `value` row per line."""
    return spark.read.text(path)


def read_delimited(spark: SparkSession, path: str | list[str], schema: Schema | None = None, sep: str = ",",
                   quote: str = '"', header: bool = True, infer: bool = False,
                   timestamp_format: str | None = None, date_format: str | None = None, null_mark: str = "\\N",
                   multi_line: bool = False) -> DataFrame:
    """Delimited file or directory of part files.

    Without a schema every column is a string, unless `infer` asks for the extra typing pass. A value that is
    `null_mark` or missing is null, a quoted empty one is an empty string. `multi_line` allows line breaks within
    quoted values; such a file cannot be split, so it is off unless asked for.
    """
    reader = (spark.read.option("sep", sep).option("quote", quote).option("header", header)
              .option("nullValue", null_mark).option("emptyValue", "").option("escape", quote)
              .option("multiLine", multi_line))
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_delimited_sets(spark: SparkSession, paths: list[str], **options) -> list[DataFrame]:
    """One lazy frame per path, ready for a union on their common columns."""
    return [read_delimited(spark, path, **options) for path in paths]


def read_json(spark: SparkSession, path: str | list[str], schema: Schema | None = None, strict: bool = False,
              whole_file: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """JSON Lines, or one document per file with `whole_file` (such a file cannot be split).

    `strict` fails at the first record that does not fit the schema. Otherwise the unfit field is null,
    and `corrupt_column`, if it is part of the schema, receives the raw record.
    """
    reader = spark.read.option("multiLine", whole_file).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_lines(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a directory as an unbounded line table."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory)


def stream_parquet(spark: SparkSession, path: str, schema: Schema, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files below a path as an unbounded table."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
