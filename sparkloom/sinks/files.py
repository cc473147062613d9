"""File and table writers. None forces a single output file; `files` is an explicit choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter

NULL_MARK = "\\N"


def _writer(frame: DataFrame, overwrite: bool, files: int | None) -> DataFrameWriter:
    if files:
        frame = frame.repartition(files)
    return frame.write.mode("overwrite" if overwrite else "errorifexists")


def write_delimited(frame: DataFrame, path: str, overwrite: bool = False, files: int | None = None,
                    sep: str = ",", quote: str = '"', header: bool = True, null_mark: str = NULL_MARK) -> None:
    """CSV directory; fails if present unless `overwrite`.

    A null is written as `null_mark`, an empty string as two quotes, so that both can be told apart when read back;
    a text equal to the mark is read back as null. White space around a value is kept. Values with line breaks are quoted and need a multi-line reader.
    """
    (_writer(frame, overwrite, files).option("sep", sep).option("quote", quote).option("header", header)
     .option("nullValue", null_mark).option("emptyValue", quote * 2).option("escape", quote)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_lines(frame: DataFrame, path: str, overwrite: bool = False, files: int | None = None) -> None:
    """Single string column as text lines."""
    _writer(frame, overwrite, files).text(path)


def write_json(frame: DataFrame, path: str, overwrite: bool = False, files: int | None = None) -> None:
    """JSON Lines; null fields are written so that every record has the same shape."""
    _writer(frame, overwrite, files).option("ignoreNullFields", False).json(path)


def write_parquet(frame: DataFrame, path: str, overwrite: bool = False, files: int | None = None,
                  partition_by: list[str] | None = None) -> None:
    """Parquet directory. With partition columns the rows are first gathered by them, and Spark splits a
    value that would make an oversized task."""
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    writer = _writer(frame, overwrite, files)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_table(frame: DataFrame, name: str, path: str | None = None) -> None:
    """Catalog table, replaced if present; `path` keeps its files outside the warehouse folder."""
    writer = frame.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_bucketed(frame: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalog table in `buckets` files by the hash of a key, each sorted by it; replaced if present.

    Tables with the same number of buckets of the join key are joined, and one is aggregated by it, without moving
    their rows. Rows are dealt to the buckets first, so that a bucket is one file.
    """
    writer = frame.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
