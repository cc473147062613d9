"""Packing of token pieces into sequences of fixed capacity by matching large pieces and best-fitting small ones.

The plan needs nothing but how many pieces there are of each length, at most `capacity` numbers, whatever the size
of the corpus. On that histogram pieces above a third of the capacity are matched greedily, the longest first, each
with the longest partner that still fits, so that a sequence has two of them at most; then the others, the longest
first, go where they leave the smallest gap. All sequences alike are filled together, so the number of steps depends
on the capacity only (a kind of gap at least halves each time it is filled). The plan says for each run of pieces of
one length where they go; pieces are numbered within their length, in salted parts, and placed by their number.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, outer_id, sliced
from sparkloom.llm.tokens import library_words, packed_ids, vocabulary_at
from sparkloom.workspace import written


class Run(NamedTuple):
    """Pieces `first_piece` onwards of a length: `per` in each sequence from `sequence` on, starting at `offset`."""

    length: int
    first_piece: int
    per: int
    sequence: int
    offset: int


class _Plan:
    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(histogram)
        self.used = dict.fromkeys(histogram, 0)
        self.runs: list[Run] = []
        self.sequences = 0
        self.gaps: list[int] = []  # sorted sizes of gaps, and for each the (first sequence, how many) that have it
        self.bins: dict[int, list[tuple[int, int]]] = {}

    def place(self, length: int, count: int, per: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, self.used[length], per, sequence, offset))
        self.used[length] += count
        self.left[length] -= count

    def offer(self, gap: int, sequence: int, count: int) -> None:
        if gap and count:
            if gap not in self.bins:
                bisect.insort(self.gaps, gap)
            self.bins.setdefault(gap, []).append((sequence, count))

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def match_large(self) -> None:
        large = sorted(length for length in self.left if 3 * length > self.capacity)
        while large:
            longest = large[-1]
            if not self.left[longest]:
                large.pop()
                continue
            k = bisect.bisect_right(large, self.capacity - longest) - 1
            while k >= 0 and (not self.left[large[k]] or large[k] == longest and self.left[longest] < 2):
                k -= 1
            if k < 0:
                count = self.left[longest]
                first = self.open(count)
                self.place(longest, count, 1, first, 0)
                self.offer(self.capacity - longest, first, count)
                continue
            partner = large[k]
            count = self.left[longest] // 2 if partner == longest else min(self.left[longest], self.left[partner])
            first = self.open(count)
            self.place(longest, count, 1, first, 0)
            self.place(partner, count, 1, first, longest)
            self.offer(self.capacity - longest - partner, first, count)

    def fill_small(self) -> None:
        for length in sorted((n for n, count in self.left.items() if count), reverse=True):
            while self.left[length]:
                k = bisect.bisect_left(self.gaps, length)
                if k == len(self.gaps):
                    count = -(-self.left[length] // (self.capacity // length))
                    self.offer(self.capacity, self.open(count), count)
                    continue
                gap = self.gaps[k]
                sequence, count = self.bins[gap].pop()
                if not self.bins[gap]:
                    del self.bins[gap], self.gaps[k]
                per, start = gap // length, self.capacity - gap
                full = min(count, self.left[length] // per)
                if full:
                    self.place(length, full * per, per, sequence, start)
                    self.offer(gap - per * length, sequence, full)
                if full < count:
                    rest = self.left[length]
                    if rest:
                        self.place(length, rest, rest, sequence + full, start)
                        self.offer(gap - rest * length, sequence + full, 1)
                    self.offer(gap, sequence + full + bool(rest), count - full - bool(rest))


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs of pieces, ordered by length and first piece, and the number of sequences."""
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths must be within 1 and {capacity}")
    made = _Plan(histogram, capacity)
    made.match_large()
    made.fill_small()
    return sorted(made.runs), made.sequences


def _cut(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary, words, end = vocabulary_at(path), library_words(path), end_id.to_bytes(4, "little")
    for batch in sliced(batches, 1):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = packed_ids(vocabulary, words, text) + end
            count = len(ids) // 4
            stops = range(count % capacity or capacity, count + 1, capacity)
            for piece, stop in enumerate(stops):
                start = stop - capacity if piece else 0
                rows.append((doc_id, piece, start, stop - start, ids[4 * start:4 * stop]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in
             zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
            ["doc_id", "piece", "start", "length", "ids"])


def cut(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): the tokens of each row and an end token, cut only beyond the capacity.

    All pieces but the first are full; `start` counts the row's tokens before the piece. `ids` are little-endian
    unsigned 32-bit integers. An empty text is a piece of the end token alone.
    """
    return documents_of(docs, id_col, text_col).mapInArrow(
        functools.partial(_cut, path, end_id, capacity),
        "doc_id long, piece int, start long, length long, ids binary").withColumn("doc_id", outer_id())


def _locate(runs: dict[int, np.ndarray], names: list[str], batches: Iterator[pa.RecordBatch]
            ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
        numbers = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            mine = np.flatnonzero(lengths == length)
            first, per, bins, starts = runs[int(length)]
            at = np.searchsorted(first, numbers[mine], "right") - 1
            inside = numbers[mine] - first[at]
            sequence[mine] = bins[at] + inside // per[at]
            offset[mine] = starts[at] + inside % per[at] * length
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence), pa.array(offset)],
                                         [*names, "sequence_id", "offset"])


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length") -> DataFrame:
    """All columns of `pieces`, and `sequence_id` and `offset` (replaced if they exist).

    Lengths are whole numbers of 1 to `capacity`; a null length is an error, as any other. Sequences are gapless
    from offset 0. Equal rows are placed one by one. Runs two jobs at once: one writes the pieces, one counts them
    by length.
    """
    pieces = pieces.drop("sequence_id", "offset")
    length = F.col(length_col).cast("long")
    names = [f"__c{k}" for k in range(len(pieces.columns))]  # whatever the caller's names are
    # Maps have no hash; rows that differ in them alone are dealt as equal ones are.
    hashable = [n for n, f in zip(names, pieces.schema.fields) if "map<" not in f.dataType.simpleString()
                and "variant" not in f.dataType.simpleString()]
    spark = pieces.sparkSession
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = written(pieces.withColumn("__length", length).toDF(*names, "__length")
                     .withColumn("__order", F.xxhash64(*hashable) if hashable else F.lit(0).cast("long")), "pieces")
    salted = stored.withColumn("__salt", F.pmod("__order", F.lit(salts)))
    counted = salted.groupBy("__length").count().collect()  # one row for each length, `capacity` at most
    runs, _ = plan({row["__length"] or 0: row["count"] for row in counted}, capacity)
    by_length: dict[int, list[Run]] = {}
    for run in runs:
        by_length.setdefault(run.length, []).append(run)
    arrays = {length: np.array([run[1:] for run in own], np.int64).T for length, own in by_length.items()}
    before = Window.partitionBy("__length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = (salted.groupBy("__length", "__salt").count()
             .select("__length", "__salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before")))
    within = Window.partitionBy("__length", "__salt").orderBy("__order")
    numbered = (salted.withColumn("__row", F.row_number().over(within)).join(parts, ["__length", "__salt"])
                .select(*names, "__length",
                        (F.col("__before") + F.col("__row") - 1).alias("__number")))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, pieces.schema.fields))
    placed = numbered.mapInArrow(functools.partial(_locate, arrays, names),
                                 f"{schema}, sequence_id long, offset long")
    return placed.toDF(*pieces.columns, "sequence_id", "offset")
