"""Small helpers shared by the operators of this subpackage.

Conventions that hold for every operator here, unless its docstring says otherwise:

* `id_col` names a long column, `text_col` a string column; no other column of the input is read, so extra
  columns may have any name.
* A null text is an empty text. A null identifier is an identifier below every other; it comes back as null.
* Rows that are repeated are answered one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOWEST = -(2**63)
ENTRY = 220  # bytes of a dictionary entry with its two objects, besides their contents
BATCH_BYTES, DEFAULT_BATCH = 8 << 20, "67108864b"  # the second as Spark shows its default


def bounded_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES) -> None:
    """Let Python workers get rows in Arrow batches of about `most_bytes`, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == DEFAULT_BATCH:
        spark.conf.set(name, str(most_bytes))


_KEPT: dict = {}


def kept(group: str, key: object, make: Callable[[], object]):
    """What a Python process keeps between batches for one group of operators; what it kept for another is dropped.

    Processes outlive queries and serve all of them, so without this each would gather the memories of all operators.
    """
    if _KEPT.get("group") != group:
        _KEPT.clear()
        _KEPT["group"] = group
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


class BoundedMemory(dict):
    """A memory of `make(key)` that forgets all when its entries come to about `most_bytes`."""

    def __init__(self, make: Callable, most_bytes: int):
        super().__init__()
        self._make, self._most, self._held = make, most_bytes, 0

    def __missing__(self, key):
        value = self._make(key)
        self._held += len(key) + (len(value) if isinstance(value, bytes) else 0) + ENTRY
        if self._held > self._most:
            self.clear()
            self._held = len(key) + ENTRY
        self[key] = value
        return value


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for columns of our own beside the caller's, which may be called anything (case does not count)."""
    taken, out = {name.lower() for name in frame.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns every operator reads, as `doc_id` (never null) and `text` (never null)."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def outer_id(name: str = "doc_id") -> Column:
    """The identifier as the caller gave it: null again where it was null."""
    return F.when(F.col(name) != LOWEST, F.col(name)).alias(name)


def sliced(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the string column of a piece holds about `most_bytes`; a longer single row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        first = held = 0
        for k, size in enumerate(sizes):
            held += size or 0
            if held >= most_bytes:
                yield batch.slice(first, k + 1 - first)
                first, held = k + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)
