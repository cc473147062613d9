"""Vector code compression: product codes, whose codebooks are refined with cover trees.

Vectors are scaled to integers and cut into parts; each part position has a codebook of its own, refined by rounds of
assignment to the nearest entry and replacement of each entry by the mean of its parts.

Vectors are dealt into blocks of at most `BLOCK` rows. A block holds a cover tree for each part position, built once
over its distinct points and written with it: every node stands for a ball around one of its points, children lie
within half their parent's reach and apart from each other, and the points below a node are neighbours in one list
with cumulative counts and sums. In a round a ball whose nearest entry is nearer than any other by more than the
ball's diameter goes to it as a whole, by two lookups in the cumulative sums (triangle inequality). Only other balls
are opened, down to single points, whose integer distances decide, ties by the lower index.

A round sends one row for each part position, entry and task through a shuffle, and the codebooks, whose size does
not depend on the data, through the driver.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import LOWEST, bounded_batches, outer_id
from sparkloom.workspace import written

BLOCK = 4096
LIMIT = 2**27  # integers below it have squared distances that fit a long
EXACT = 2**22  # below it sums of products of eight are exact in floating point


class CoverTree(NamedTuple):
    """Distinct points in tree order, their rows, and nodes: `centre` (a place among the points), `reach` (largest
    distance of the node's points from it), `first` and `last` place, and the range of its children (none: a leaf).
    """

    points: np.ndarray
    counts: np.ndarray
    place_of_row: np.ndarray
    centre: np.ndarray
    reach: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    child_end: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of equally many points, as 64-bit integers."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def build(rows: np.ndarray, leaf: int = 8) -> CoverTree:
    """A cover tree over the distinct rows, level by level for all open balls at once.

    A ball with at most `leaf` points or without extent is not divided. Any other is covered by balls of half its
    reach: the first centre is its own, then each point that no centre covers becomes a centre in turn.
    """
    if rows.shape[1]:
        points, place_of_row, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    else:  # parts without a component are all equal
        points, place_of_row, counts = rows[:1], np.zeros(len(rows), np.int64), np.full(min(1, len(rows)), len(rows))
    points, n = points.astype(np.int64), len(points)
    far = np.sqrt(squared(points, points[:1]).astype(float)) if n else np.zeros(0)
    # Nodes in order of creation: centre, reach, number of points, parent.
    centre, reach = [np.zeros(1, np.int64)], [np.array([far.max(initial=0.0)])]
    amount, parent = [np.array([n])], [np.array([-1])]
    owner, made = np.zeros(n, np.int64), 1  # the last node that holds each point; nodes so far
    while True:
        centres, reaches, amounts = centre[-1], reach[-1], amount[-1]
        base = made - len(centres)
        wide = (amounts > leaf) & (reaches > 0)
        member = np.flatnonzero((owner >= base) & wide[np.maximum(owner - base, 0)])
        group = owner[member] - base
        order = np.argsort(group, kind="stable")
        member, group = member[order], group[order]
        halves = reaches[group] / 2
        new_centre, new_parent, new_owner = [], [], np.full(len(member), -1)
        rest, picked = np.arange(len(member)), centres[group]
        total = 0
        while len(rest):  # each turn gives every ball that still has uncovered points one more centre
            heads = np.flatnonzero(np.append(True, group[rest][1:] != group[rest][:-1]))
            if total:
                picked = np.repeat(member[rest][heads], np.diff(np.append(heads, len(rest))))
            gap = np.sqrt(squared(points[member[rest]], points[picked]).astype(float))
            number = total + np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(rest))))
            covered = gap <= halves[rest]
            new_owner[rest[covered]] = number[covered]
            new_centre.append(picked[heads])
            new_parent.append(group[rest][heads] + base)
            total += len(heads)
            rest, picked = rest[~covered], picked[~covered]
        if not total:
            break
        new_centre, new_parent = np.concatenate(new_centre), np.concatenate(new_parent)
        gap = np.sqrt(squared(points[member], points[new_centre[new_owner]]).astype(float))
        new_reach = np.zeros(total)
        np.maximum.at(new_reach, new_owner, gap)
        centre.append(new_centre)
        reach.append(new_reach)
        amount.append(np.bincount(new_owner, minlength=total))
        parent.append(new_parent)
        owner[member] = made + new_owner
        made += total
    return _ordered(points, counts, place_of_row.ravel(), owner, *map(np.concatenate, (centre, reach, amount, parent)))


def _ordered(points: np.ndarray, counts: np.ndarray, place_of_row: np.ndarray, owner: np.ndarray, centre: np.ndarray,
             reach: np.ndarray, amount: np.ndarray, parent: np.ndarray) -> CoverTree:
    """Number the nodes by levels, siblings together, and the points so that each node's are neighbours."""
    nodes = len(centre)
    first, last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    child, child_end = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    order, level = [np.zeros(1, np.int64)], np.zeros(1, np.int64)
    by_parent = np.argsort(parent, kind="stable")  # creation order is by level already
    starts = np.searchsorted(parent[by_parent], np.arange(nodes + 1))
    last[0] = len(points)
    placed = 1
    while len(level):
        sizes = starts[level + 1] - starts[level]
        child[level] = placed + np.cumsum(sizes) - sizes
        child_end[level] = child[level] + sizes
        below = by_parent[np.repeat(starts[level], sizes) + _within(sizes)]
        # Siblings share out their parent's places one after another.
        run = np.cumsum(amount[below]) - amount[below]
        heads = np.repeat(np.cumsum(sizes) - sizes, sizes)
        first[below] = np.repeat(first[level], sizes) + run - (run[heads] if len(below) else run)
        last[below] = first[below] + amount[below]
        order.append(below)
        placed += len(below)
        level = below
    numbering = np.concatenate(order)
    sequence = np.argsort(first[owner], kind="stable")  # leaves hold their points in any order
    place = np.empty(len(points), np.int64)
    place[sequence] = np.arange(len(points))
    return CoverTree(points[sequence], counts[sequence], place[place_of_row], place[centre[numbering]] if len(points)
                     else centre, reach[numbering], first[numbering], last[numbering], child[numbering],
                     child_end[numbering])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within runs of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def all_squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries, as integers (held in floats where these are exact)."""
    if max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) < EXACT and points.shape[1] <= 8:
        a, b = points.astype(float), entries.astype(float)
        return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.stack([squared(points, entry[None]) for entry in entries], 1)


def assign(tree: CoverTree, entries: np.ndarray, blocked: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of places and the entry that all points in them are nearest to: (first, last, entry)."""
    out = [(np.zeros(0, np.int64),) * 3]
    waiting = [np.zeros(1, np.int64)] if len(tree.points) else []
    while waiting:
        nodes = waiting.pop()
        if len(nodes) > blocked:
            waiting.append(nodes[blocked:])
            nodes = nodes[:blocked]
        distance = all_squared(tree.points[tree.centre[nodes]], entries)
        best = distance.argmin(1)
        near = distance[np.arange(len(nodes)), best].astype(float)
        distance[np.arange(len(nodes)), best] = np.inf if distance.dtype == float else np.iinfo(np.int64).max
        second = np.sqrt(distance.min(1).astype(float)) if len(entries) > 1 else np.full(len(nodes), np.inf)
        # A ball of no extent has been decided by integers; for others rounding is on the side of opening them.
        whole = (tree.reach[nodes] == 0) | (second > (np.sqrt(near) + 2 * tree.reach[nodes]) * (1 + 1e-9) + 1e-6)
        out.append((tree.first[nodes[whole]], tree.last[nodes[whole]], best[whole]))
        split = nodes[~whole]
        sizes = tree.child_end[split] - tree.child[split]
        leaves = split[sizes == 0]
        below = np.repeat(tree.child[split], sizes) + _within(sizes)
        if len(below):
            waiting.append(below)
        for k in range(0, len(leaves), blocked):
            some = leaves[k:k + blocked]
            amounts = tree.last[some] - tree.first[some]
            places = np.repeat(tree.first[some], amounts) + _within(amounts)
            out.append((places, places + 1, all_squared(tree.points[places], entries).argmin(1)))
    return tuple(np.concatenate(column) for column in zip(*out))


def sums(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry the number and the componentwise sum of the rows that are nearest to it."""
    first, last, entry = assign(tree, entries)
    weighted = np.zeros((len(tree.points) + 1, tree.points.shape[1] + 1), np.int64)
    np.cumsum(np.column_stack([tree.counts, tree.points * tree.counts[:, None]]), axis=0, out=weighted[1:])
    total = np.zeros((len(entries), weighted.shape[1]), np.int64)
    np.add.at(total, entry, weighted[last] - weighted[first])
    return total[:, 0], total[:, 1:]


def codes(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each row and its squared distance."""
    first, last, entry = assign(tree, entries)
    chosen = np.zeros(len(tree.points), np.int64)
    sizes = last - first
    chosen[np.repeat(first, sizes) + _within(sizes)] = np.repeat(entry, sizes)
    error = squared(tree.points, entries[chosen])
    return chosen[tree.place_of_row], error[tree.place_of_row]


def edges(width: int, parts: int) -> list[int]:
    """Borders of consecutive parts, equal where the width is a multiple of their number."""
    return [k * width // parts for k in range(parts + 1)]


def _packed(tree: CoverTree) -> bytes:
    """A tree as one byte string: lengths, then its arrays."""
    head = np.array([*tree.points.shape, len(tree.place_of_row), len(tree.centre)], "<i8")
    small = [tree.points.astype("<i4").ravel(), *(a.astype("<i4") for a in (
        tree.counts, tree.place_of_row, tree.centre, tree.first, tree.last, tree.child, tree.child_end))]
    return b"".join([head.tobytes(), tree.reach.astype("<f8").tobytes(), *(a.tobytes() for a in small)])


def _unpacked(data: bytes) -> CoverTree:
    n, width, rows, nodes = np.frombuffer(data, "<i8", 4).tolist()
    reach = np.frombuffer(data, "<f8", nodes, 32)
    at, out = 32 + 8 * nodes, []
    for size in (n * width, n, rows, nodes, nodes, nodes, nodes, nodes):
        out.append(np.frombuffer(data, "<i4", size, at).astype(np.int64))
        at += 4 * size
    points, counts, place_of_row, centre, first, last, child, child_end = out
    return CoverTree(points.reshape(n, width), counts, place_of_row, centre, reach, first, last, child, child_end)


def _planted(parts: int, width: int, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors as cover trees, one byte string for each part position."""
    borders = edges(width, parts)

    def made(ids: pa.Array, labels: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
        trees = [_packed(build(vectors[:, a:b])) for a, b in zip(borders, borders[1:])]
        return pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                                           pa.array([labels.to_pylist()], pa.list_(labels.type)),
                                           pa.array([trees], pa.list_(pa.binary()))],
                                          names=["vec_ids", "labels", "trees"])

    held, count = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, block):
            part = batch.slice(first, block)
            if count + part.num_rows > block:
                yield made(*_joined(held, width))
                held, count = [], 0
            held.append(part)
            count += part.num_rows
    if count:
        yield made(*_joined(held, width))


def _joined(batches: list[pa.RecordBatch], width: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    ids, labels, vectors = (table.column(k).combine_chunks() for k in range(3))
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    return ids, labels, np.floor(256 * values).astype(np.int64)


def _totals(books: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part position and entry the number and sums of its parts in this task."""
    counts = [np.zeros(len(book), np.int64) for book in books]
    added = [np.zeros(book.shape, np.int64) for book in books]
    seen = False
    for batch in batches:
        for trees in batch.column(0):
            seen = True
            for k, tree in enumerate(trees.as_py()):
                number, total = sums(_unpacked(tree), books[k])
                counts[k] += number
                added[k] += total
    if seen:
        rows = [(k, entry, int(counts[k][entry]), added[k][entry].tolist())
                for k in range(len(books)) for entry in np.flatnonzero(counts[k]).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in list(zip(*rows))[:3]]
                                         + [pa.array([row[3] for row in rows], pa.list_(pa.int64()))],
                                         names=["part", "entry", "n", "sums"])


def _coded(books: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, trees in zip(*(batch.column(k) for k in range(3))):
            chosen, error = zip(*(codes(_unpacked(tree), book) for tree, book in zip(trees.as_py(), books)))
            digits = np.stack(chosen, 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [ids.values, labels.values, pa.array([row.tobytes().hex() for row in digits]),
                 pa.array(np.sum(error, axis=0))], names=["vec_id", "label", "code", "error"])


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all numbers by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def refined(books: list[np.ndarray], rows: list) -> list[np.ndarray]:
    """The codebooks with each used entry replaced by the floor of its mean; `rows` as `_totals` adds them up."""
    out = [book.copy() for book in books]
    for row in rows:
        for k, total in enumerate(row["sums"]):
            out[row["part"]][row["entry"], k] = int(total) // row["n"]
    return out


def encode(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
           vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) for each vector that is kept.

    Components become floor(256 x). Dropped are vectors that are null or empty, hold null, NaN or an infinite
    component or one beyond +-2^19 (whose squared errors no long can hold), or are not of the most frequent length
    (the longest of several). Each codebook starts as the parts of the vectors with the `entries` (at most 256)
    smallest identifiers, of equal ones those with the smaller components; a null identifier is below every other.
    `code` has two hexadecimal digits for each part; `error` is the squared distance to the coded vector, and
    `label_error` its sum over all rows with the label, nulls together. A width that is no multiple of `parts` is
    cut as evenly as can be. Repeated rows are coded one by one.

    Writes the trees and the codes to the shared folder; runs rounds + 4 jobs at once. The driver gets `entries`
    vectors and, in each round, a sum for each part position and entry.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two digits counts 256 entries at most")
    bounded_batches(vectors.sparkSession)
    kept = (vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("vec_id"),
                           F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < LIMIT / 256)) & (F.size("vector") > 0)))
    lengths = kept.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).take(1)
    width = lengths[0]["width"] if lengths else 0
    kept = kept.where(F.size("vector") == width)
    borders = edges(width, parts)
    first = kept.orderBy("vec_id", "vector").limit(entries).collect()
    seeds = np.floor(256 * np.array([row["vector"] for row in first], float)).astype(np.int64).reshape(len(first), width)
    books = [seeds[:, a:b] for a, b in zip(borders, borders[1:])]
    label_type = kept.schema["label"].dataType.simpleString()
    trees = written(kept.mapInArrow(functools.partial(_planted, parts, width, block),
                                    f"vec_ids array<bigint>, labels array<{label_type}>, trees array<binary>"),
                    "cover-trees")
    for _ in range(rounds):
        added = (trees.select("trees").mapInArrow(functools.partial(_totals, books),
                                                  "part long, entry long, n long, sums array<long>")
                 .select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
                 .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
                 .groupBy("part", "entry").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(
                     F.struct("place", "total")))["total"].alias("sums")))
        books = refined(books, added.collect())  # parts x entries rows at most
    coded = written(trees.select("vec_ids", "labels", "trees").mapInArrow(
        functools.partial(_coded, books),
        f"vec_id bigint, label {label_type}, code string, error bigint"), "vector-codes")
    by_label = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    renamed = by_label.select(F.col("label").alias("of"), "label_error")
    return (coded.join(renamed, F.col("label").eqNullSafe(F.col("of")))
            .select(outer_id("vec_id"), "label", "code", "error", "label_error",
                    F.lit(digest(books)).alias("codebooks_sha256")))

