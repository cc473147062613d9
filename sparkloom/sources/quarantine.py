"""Records that do not fit their schema are kept beside the good ones, with the place they came from.

`json_lines` and `delimited_lines` type each line of text files (or of a stream of them) and put what cannot be typed
into a struct `bad`: the raw line, its file, the place in the file where the task's part began, and the line's number
in that task, which orders the bad lines of a part. Every line is either good or bad.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.streaming.runner import for_each_batch

BAD = "raw string, file string, start long, place long"
_RAW = "_raw_record"


def with_origin(lines: DataFrame) -> DataFrame:
    """Lines with their `file` and `start` as columns, which outlive the hidden ones of the reader."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("start"))


def _typed(lines: DataFrame, row: Column, names: list[str]) -> DataFrame:
    lines = lines if lines.columns == ["value", "file", "start"] else with_origin(lines)
    # The lower 33 bits of the running number count the rows of a task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    read = lines.select("value", row.alias("_row"), F.col("file").alias("_file"), F.col("start").alias("_start"),
                        place.alias("_place"))
    bad = F.when(F.col("_row").isNull() | F.col(f"_row.{_RAW}").isNotNull(), F.struct(
        F.col("value").alias("raw"), F.col("_file").alias("file"), F.col("_start").alias("start"),
        F.col("_place").alias("place")))
    return read.select(*[F.col(f"_row.`{name}`").alias(name) for name in names], bad.alias("bad"))


def _with_raw(schema: T.StructType | str) -> tuple[T.StructType, list[str], str]:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [*schema.fields, T.StructField(_RAW, T.StringType())]
    return T.StructType(fields), schema.names, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def json_lines(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Lines as read by `read_lines`, or with their origin: the columns of the schema and `bad`.

    Bad are lines that are no JSON object, empty ones among them, and those with a value that does not fit its type.
    """
    whole, names, _ = _with_raw(schema)
    row = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW})
    return _typed(lines, row, names)


def delimited_lines(lines: DataFrame, schema: T.StructType | str, sep: str = ",", quote: str = '"',
                    null_mark: str = "\\N") -> DataFrame:
    """As `json_lines`, for delimited lines without a header.

    Bad are lines with another number of values or with a value that does not fit its type.
    """
    _, names, ddl = _with_raw(schema)
    row = F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW, "sep": sep,
                                    "quote": quote, "escape": quote, "nullValue": null_mark, "emptyValue": ""})
    return _typed(lines, row, names)


def good_rows(typed: DataFrame) -> DataFrame:
    return typed.where("bad IS NULL").drop("bad")


def bad_rows(typed: DataFrame) -> DataFrame:
    return typed.where("bad IS NOT NULL").select("bad.*")


def store(typed: DataFrame, good: str, bad: str, batch_id: int = 0) -> None:
    """Write both outputs of a batch, each to the folder of its number; the same number again replaces them."""
    for rows, path in ((good_rows(typed), good), (bad_rows(typed), bad)):
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def store_stream(lines: DataFrame, typed: Callable[[DataFrame], DataFrame], good: str, bad: str, checkpoint: str,
                 **timing) -> None:
    """Type every micro-batch of a stream of lines and write both outputs; a batch that is replayed rewrites its own
    folders only."""
    for_each_batch(with_origin(lines), lambda batch, number: store(typed(batch), good, bad, number), checkpoint, **timing)
