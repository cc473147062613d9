"""Files whose records span lines, read by many tasks: quoted CSV with line breaks, and JSON arrays of documents.

Spark splits such files no further than one task a file, since a byte range alone does not say whether it begins
within a record. Here a file is read as lines, which can be split, in two passes:

1. Every range (a file and the place where a task's part begins) is summed up by one number: for CSV the parity of its
   quote characters, for JSON the change of its nesting depth. A running exclusive-or, or sum, over the ranges of a file
   is the state in which each range begins. There is one row a range.
2. Each task joins the lines of its range to records, from the state it begins in. Lines that belong to a record of an
   earlier range are fragments, which are put behind it by a small join.

Records go to Spark's own `from_csv` and `from_json`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.workspace import written

# What a task makes of a range: records with their number, and at number 0 the lines before the first. `edge` marks
# that fragment and the last record, which fragments of later ranges may belong to.
_PIECES = "file string, start long, number long, text string, edge boolean"
NAMES = ["file", "start", "number", "text", "edge"]
MOST_RANGES = 1 << 21  # of about 100 bytes each, told to all tasks; 256 TB in ranges of 128 MB


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, line): lines are cut at line feeds only, so that nothing of a record is lost."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"))


def _with_state(lines: DataFrame, change: Column, total: Callable[[Column], Column]) -> DataFrame:
    """Lines with the state in which their range begins. Runs the first pass at once."""
    ranges = lines.groupBy("file", "start").agg(total(F.sum(change)).alias("change"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = written(ranges.select("file", "start", total(F.coalesce(F.sum("change").over(before), F.lit(0)))
                                   .cast("long").alias("state")), "ranges")
    if states.count() > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    found = lines.join(F.broadcast(states), ["file", "start"], "left")  # at most MOST_RANGES short rows
    known = F.coalesce("state", F.raise_error(F.lit("the ranges of the files changed while they were read")).cast("long"))
    return found.select("file", "start", known.alias("state"), "line")


def _joined(first_line: Callable[[pa.Array, int], tuple[np.ndarray, int]],
            batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of consecutive lines. `first_line(lines, state)` says which lines begin one, and the state afterwards."""
    file, start, state, number, held = None, None, 0, 0, []

    def piece(last: bool = False):
        return (file, start, number, "\n".join(held), last or number == 0)

    for batch in batches:
        out = []
        files, starts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        cuts = [0, *[k for k in range(1, len(files)) if files[k] != files[k - 1] or starts[k] != starts[k - 1]], len(files)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if (files[a], starts[a]) != (file, start):
                if held:
                    out.append(piece(True))
                file, start, number, held = files[a], int(starts[a]), 0, []
                state = batch.column(2)[a].as_py()
            lines = batch.column(3).slice(a, b - a)
            begins, state = first_line(lines, state)
            texts = lines.to_pylist()
            places = [*np.flatnonzero(begins).tolist(), len(texts)]
            held.extend(texts[:places[0]])
            for p, q in zip(places, places[1:]):
                if held:
                    out.append(piece())
                number, held = number + 1, texts[p:q]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in out], kind) for k, kind in enumerate(
                (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))], names=NAMES)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([value]) for value in piece(True)], names=NAMES)


def _records(pieces: DataFrame) -> DataFrame:
    """(file, start, number, text): fragments at the beginning of ranges go behind the last record before them.

    Only edges move, two a range at most.
    """
    whole = pieces.where("NOT edge").drop("edge")
    edges = pieces.where("edge")
    order = Window.partitionBy("file").orderBy("start", "number")
    heads = F.max(F.when(F.col("number") > 0, F.struct("start", "number"))).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mended = (edges.withColumn("head", heads).groupBy("file", "head")
              .agg(F.array_join(F.sort_array(F.collect_list(F.struct("start", "number", "text")))["text"], "\n")
                   .alias("text"))
              .select("file", F.coalesce("head.start", F.lit(0)).alias("start"),
                      F.coalesce("head.number", F.lit(0)).alias("number"), "text"))
    return whole.unionByName(mended)


def delimited_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """(file, start, number, text) of each record of CSV files, where quoted values may hold line breaks.

    A quote within a quoted value is written twice. Line feeds end lines; a carriage return before one is dropped at
    the end of a record and kept within a value. The last number of a file's first range is not known to others:
    records are ordered by (file, start, number).
    """
    def parity(lines: pa.Array, state: int) -> tuple[np.ndarray, int]:
        after = (state + np.cumsum(pc.count_substring(lines, quote).to_numpy(zero_copy_only=False))) % 2
        return np.append(state, after[:-1]) == 0, int(after[-1])

    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    lines = _with_state(_lines(spark, path), quotes, lambda n: n % 2)
    records = _records(lines.mapInArrow(lambda batches: _joined(parity, batches), _PIECES))
    return records.withColumn("text", F.regexp_replace("text", "\r$", ""))


def read_delimited_split(spark: SparkSession, path: str | list[str], schema: T.StructType | str, sep: str = ",",
                         quote: str = '"', header: bool = True, timestamp_format: str | None = None,
                         date_format: str | None = None, null_mark: str = "\\N", keep_place: bool = False) -> DataFrame:
    """`read_delimited(..., multi_line=True)` of files of any size, each read by as many tasks as it has ranges.

    Empty lines between records are no records. With `keep_place` the columns `file`, `start` and `number` stay in
    front, which order the records. Both passes read the files; nothing is shuffled but a few rows for each range.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"sep": sep, "quote": quote, "escape": quote, "nullValue": null_mark, "emptyValue": "",
               "multiLine": "true"}
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    if date_format:
        options["dateFormat"] = date_format
    records = delimited_records(spark, path, quote).where("text <> ''")
    if header:  # the first record of a file
        records = records.where("NOT (start = 0 AND number = 1)")
    place = ["file", "start", "number"] if keep_place else []
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    return records.select(*place, F.from_csv("text", ddl, options).alias("_row")).select(*place, "_row.*")


def document_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, number, text) of stretches of files that hold one JSON array of objects each.

    A stretch begins with a line on which the depth is the array's, and `text` is an array of its objects: one object
    where each begins on a line of its own, as indented and one-object-a-line writers have it, else as many as it
    takes to the next such line. (JSON strings hold no line feed.) A file that is no array of objects fails.
    """
    def depth(lines: pa.Array, state: int) -> tuple[np.ndarray, int]:
        after = state + np.cumsum([_depth(line) for line in lines.to_pylist()])
        return np.append(state, after[:-1]) <= 1, int(after[-1])

    bare = F.regexp_replace("line", _STRING.pattern, "")
    change = F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))
    lines = _with_state(_lines(spark, path), change, lambda n: n)
    records = _records(lines.mapInArrow(lambda batches: _joined(depth, batches), _PIECES))
    objects = F.regexp_extract("text", r"(?s)^[\s,]*\[?[\s,]*(\{.*\})[\s,]*\]?\s*$", 1)
    wrong = ~F.col("text").rlike(r"^[\s,\[\]]*$") & (objects == "")
    failed = F.raise_error(F.concat(F.col("file"), F.lit(" is not an array of objects")))
    return (records.withColumn("text", F.when(wrong, failed).otherwise(objects)).where("text <> ''")
            .withColumn("text", F.concat(F.lit("["), "text", F.lit("]"))))


_STRING = re.compile(r'"(?:\\.|[^"\\])*"')


def _depth(line: str) -> int:
    bare = _STRING.sub("", line)
    return bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")


def read_documents_split(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """The objects of files that hold one JSON array each, as typed rows; a file is read by as many tasks as it has
    ranges (see `document_records`)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = document_records(spark, path).select(F.explode(F.from_json("text", T.ArrayType(schema))).alias("_row"))
    return rows.select("_row.*")
