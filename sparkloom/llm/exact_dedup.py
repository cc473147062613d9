"""Exact duplicates: Patricia tries over whole texts name the owner of each group of equal texts.

1. Each task of the scan inserts the texts of its rows into a compressed radix trie. A terminal node stands for one
   text; it holds the identifiers met there. When the labels of the trie exceed a budget, the largest subtree below
   the root is spilled: its terminals are put out as "spots" and forgotten (an equal text that comes later opens
   another spot). So a text crosses the network once for each spot and not once for each copy.
2. Spots are partitioned by length and content hash, and each partition inserts their full byte strings into tries
   again. The terminal keeps the smallest (or largest) identifier and the number of rows. Spots arrive sorted by
   length and hash, so the trie can be put out between two hashes whenever it is over budget.
3. Rows learn the verdict of their spot by a join on the spot's number; a spot has at most the rows of one task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, outer_id, sliced
from sparkloom.workspace import written

BUDGET = 64 << 20


class Node:
    """A node of the trie: the bytes on the edge to it, its children by first byte, and what its text holds."""

    __slots__ = ("label", "children", "held")

    def __init__(self, label: bytes):
        self.label, self.children, self.held = label, {}, None


class PatriciaTrie:
    """Compressed radix trie over byte strings; `size` counts the bytes of labels and 8 for each held item."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def add(self, text: bytes, item) -> None:
        """Append the item to the list held at the text."""
        node, at, self.size = self.root, 0, self.size + 8
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(child.label) + 200
            elif not text.startswith(child.label, at):
                child = self._split(node, child, text, at)
            node, at = child, at + len(child.label)
        if node.held is None:
            node.held = []
        node.held.append(item)

    def _split(self, parent: Node, child: Node, text: bytes, at: int) -> Node:
        label, low, high = child.label, 1, min(len(child.label), len(text) - at)
        while low < high:  # the longest common start of the label and the rest of the text
            middle = (low + high + 1) // 2
            if text.startswith(label[:middle], at):
                low = middle
            else:
                high = middle - 1
        upper = parent.children[label[0]] = Node(label[:low])
        child.label = label[low:]
        upper.children[child.label[0]] = child
        self.size += 200
        return upper

    def drain(self, node: Node | None = None, start: bytes = b"") -> Iterator[tuple[bytes, list]]:
        """All (text, items) below a node, the whole trie by default; the part that was drained is gone."""
        top = node or self.root
        stack = [(top, start)]
        while stack:
            here, before = stack.pop()
            text = before + here.label
            if here.held is not None:
                self.size -= 8 * len(here.held)
                yield text, here.held
            self.size -= len(here.label) + 200 * (here is not self.root)
            stack.extend((child, text) for child in here.children.values())
        if node is None:
            self.root, self.size = Node(b""), 0
        else:
            del self.root.children[node.label[0]]

    def spill(self) -> Iterator[tuple[bytes, list]]:
        """Drain the largest subtree below the root, and the root's own text."""
        if self.root.held is not None:
            held, self.root.held = self.root.held, None
            self.size -= 8 * len(held)
            yield b"", held
        if self.root.children:
            yield from self.drain(max(self.root.children.values(), key=_weight))


def _weight(top: Node) -> int:
    total, stack = 0, [top]
    while stack:
        node = stack.pop()
        total += len(node.label) + 8 * len(node.held or ())
        stack.extend(node.children.values())
    return total


SPOTS = "doc_id long, spot long, own boolean, text_sha256 string, length long, hash long, text binary, n_rows long"


def _spot_rows(spot: int, text: bytes, ids: list[int], best) -> tuple[list, ...]:
    digest = hashlib.sha256(text)
    first, short = ids.index(best(ids)), int.from_bytes(digest.digest()[:8], "little", signed=True)
    count = len(ids)
    return (ids, [spot] * count, [k == first for k in range(count)], [digest.hexdigest()] * count,
            [len(text)] * count, [short] * count, [text if k == first else None for k in range(count)], [count] * count)


def _batches(rows: Iterator[tuple[list, ...]], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    columns, held = [[] for _ in schema], 0
    for row in rows:
        for column, values in zip(columns, row):
            column.extend(values)
        held += 100 * len(row[0]) + sum(len(v) for v in row[6] if v) if len(row) > 6 else 100 * len(row[0])
        if held >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns, held = [[] for _ in schema], 0
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


SPOT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("spot", pa.int64()), ("own", pa.bool_()),
                         ("text_sha256", pa.string()), ("length", pa.int64()), ("hash", pa.int64()),
                         ("text", pa.binary()), ("n_rows", pa.int64())])
VERDICT_SCHEMA = pa.schema([("spot", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
                            ("wins", pa.bool_())])


def _spots(largest: bool, budget: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best, spot = (max if largest else min), TaskContext.get().partitionId() << 40
    trie = PatriciaTrie()

    def rows():
        nonlocal spot
        for batch in sliced(batches, 1):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                trie.add(text, doc_id)
            while trie.size > budget:
                for text, ids in trie.spill():
                    yield _spot_rows(spot, text, ids, best)
                    spot += 1
        for text, ids in trie.drain():
            yield _spot_rows(spot, text, ids, best)
            spot += 1

    yield from _batches(rows(), SPOT_SCHEMA)


def _verdicts(largest: bool, budget: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, last = PatriciaTrie(), None

    def settled():
        for _, spots in trie.drain():
            keep = max(s[0] for s in spots) if largest else min(s[0] for s in spots)
            winner = min(s[1] for s in spots if s[0] == keep)
            size = sum(s[2] for s in spots)
            yield ([s[1] for s in spots], [keep] * len(spots), [size] * len(spots), [s[1] == winner for s in spots])

    def rows():
        nonlocal last
        for batch in sliced(batches, 4):
            for doc_id, spot, length, short, text, n_rows in zip(*(c.to_pylist() for c in batch.columns)):
                if (length, short) != last and trie.size > budget:
                    yield from settled()
                last = (length, short)
                trie.add(text, (doc_id, spot, n_rows))
        yield from settled()

    yield from _batches(rows(), VERDICT_SCHEMA)


def find_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
                budget: int = BUDGET) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row.

    Rows are copies when their texts are equal byte for byte; nothing is normalised. The row with the smallest (or
    largest) identifier of a group is kept; of several rows that have this identifier and text, one is kept.
    `keep_id` is null if the kept row's identifier is null. Runs one job at once, which writes the spots.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    largest = keep == "largest"
    spots = written(documents_of(docs, id_col, text_col).mapInArrow(functools.partial(_spots, largest, budget), SPOTS),
                    "spots")
    owners = spots.where("own").select("doc_id", "spot", "length", "hash", "text", "n_rows")
    verdicts = (owners.repartition("length", "hash").sortWithinPartitions("length", "hash")
                .mapInArrow(functools.partial(_verdicts, largest, budget),
                            "spot long, keep_id long, group_size long, wins boolean"))
    rows = spots.select("doc_id", "spot", "own", "text_sha256").join(verdicts, "spot")
    return rows.select(outer_id(), outer_id("keep_id"), "group_size", (F.col("own") & F.col("wins")).alias("kept"),
                       "text_sha256")
