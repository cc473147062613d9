"""Token files: a static range asymmetric numeral system over interleaved lanes.

Rows are put in ascending order of their identifier by a range partitioning and a sort; each partition writes its
documents, one after another, as a sequence of segments. A segment is the unit of storage, one binary value of the
written table, and is read on its own:

    magic, counts | documents (identifier, tokens) | frequency table | block directory | blocks | checksum

The frequency table counts all tokens of the segment and is shared by its blocks. A block holds a stretch of tokens
dealt over lanes, token t to lane t mod lanes, which share one stream of 32-bit words. At each checkpoint the block
stores the state of all lanes and the place in the stream, and the checksum of the tokens up to the next one, so
that every stretch between checkpoints can be decoded independently (`decode_span`). Blocks end where documents end
or not, as it comes; only segments end at the end of a document.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, outer_id, sliced
from sparkloom.llm.tokens import library_words, packed_ids, vocabulary_at
from sparkloom.workspace import new_folder

MAGIC = b"RANS0001"
LOWER = np.uint64(1 << 31)
WORD = np.uint64(32)
SEGMENT_TOKENS, BLOCK_TOKENS, LANES, STEPS = 1 << 21, 1 << 19, 1024, 128
HEAD = struct.Struct("<8sQIIIII")  # magic, tokens, documents, symbols, scale bits, blocks, bytes of the table
BLOCK_HEAD = struct.Struct("<QIII")  # tokens, lanes, steps between checkpoints, words


class Table:
    """Frequencies of the symbols that occur, scaled to a power of two, none below one."""

    def __init__(self, symbols: np.ndarray, scaled: np.ndarray, bits: int):
        self.symbols, self.scaled, self.bits = symbols, scaled, bits
        self.starts = np.cumsum(scaled) - scaled

    @classmethod
    def of(cls, tokens: np.ndarray) -> Table:
        symbols, counts = np.unique(tokens, return_counts=True)
        bits = min(30, max(12, int(len(symbols)).bit_length() + 5))
        total = 1 << bits
        scaled = np.maximum(1, counts * (total - len(symbols)) // max(1, counts.sum()))
        scaled[np.argmax(scaled)] += total - scaled.sum()
        return cls(symbols.astype(np.int64), scaled.astype(np.int64), bits)

    def pack(self) -> bytes:
        return zlib.compress(np.diff(self.symbols, prepend=0).astype("<u4").tobytes()
                             + self.scaled.astype("<u4").tobytes())

    @classmethod
    def unpack(cls, packed: bytes, bits: int) -> Table:
        deltas, scaled = np.frombuffer(zlib.decompress(packed), "<u4").reshape(2, -1).astype(np.int64)
        return cls(np.cumsum(deltas), scaled, bits)

    @functools.cached_property
    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.symbols), dtype=np.int32), self.scaled)


def encode_block(tokens: np.ndarray, table: Table, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """Encode the tokens, the last step first, so that decoding runs forwards."""
    lanes = max(1, min(lanes, len(tokens) // 64))
    codes = np.searchsorted(table.symbols, tokens)
    frequency, start = table.scaled[codes].astype(np.uint64), table.starts[codes].astype(np.uint64)
    bits = np.uint64(table.bits)
    limit = ((LOWER >> bits) << WORD) * frequency
    state = np.full(lanes, LOWER)
    chunks: list[np.ndarray] = []
    marks, words = [], 0
    total = -(-len(tokens) // lanes)
    for step in range(total - 1, -1, -1):
        here = slice(step * lanes, min((step + 1) * lanes, len(tokens)))
        x, f = state[:here.stop - here.start], frequency[here]
        over = x >= limit[here]
        if over.any():
            chunks.append(x[over].astype("<u4"))
            words += len(chunks[-1])
            x = np.where(over, x >> WORD, x)
        whole = x // f
        state[:here.stop - here.start] = (whole << bits) + (x - whole * f) + start[here]
        if step % steps == 0:
            marks.append((words, zlib.crc32(tokens[step * lanes:(step + steps) * lanes].astype("<u4").tobytes()),
                          state.astype("<u8").tobytes()))
    marks.reverse()
    stream = np.concatenate(chunks[::-1]).tobytes() if chunks else b""
    index = b"".join(struct.pack("<II", words - at, crc) + states for at, crc, states in marks)
    return BLOCK_HEAD.pack(len(tokens), lanes, steps, words) + index + stream


def spans_of(block: bytes) -> int:
    """How many stretches of a block can be decoded on their own."""
    count, lanes, steps, _ = BLOCK_HEAD.unpack_from(block)
    return -(-count // (lanes * steps))


def decode_span(block: bytes, table: Table, span: int) -> np.ndarray:
    """Tokens of one stretch, from its checkpoint on; raises ValueError if their checksum is wrong."""
    count, lanes, steps, words = BLOCK_HEAD.unpack_from(block)
    spans, width = spans_of(block), 8 + 8 * lanes
    at = BLOCK_HEAD.size + span * width
    place, crc = struct.unpack_from("<II", block, at)
    state = np.frombuffer(block, "<u8", lanes, at + 8).astype(np.uint64)
    stream = np.frombuffer(block, "<u4", words, BLOCK_HEAD.size + spans * width)
    first, last = span * steps * lanes, min((span + 1) * steps * lanes, count)
    codes = np.empty(last - first, np.int32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    scaled, starts, slots = table.scaled.astype(np.uint64), table.starts.astype(np.uint64), table.slots
    for low in range(0, last - first, lanes):
        wide = min(lanes, last - first - low)
        x = state[:wide]
        slot = x & mask
        code = slots[slot]
        codes[low:low + wide] = code
        x = scaled[code] * (x >> bits) + slot - starts[code]
        under = np.flatnonzero(x < LOWER)
        x[under] = (x[under] << WORD) | stream[place:place + len(under)].astype(np.uint64)
        place += len(under)
        state[:wide] = x
    tokens = table.symbols[codes].astype("<u4")
    if zlib.crc32(tokens.tobytes()) != crc:
        raise ValueError("wrong checksum of a stretch of tokens")
    return tokens


def encode_segment(doc_ids: list[int], counts: list[int], tokens: np.ndarray,
                   block_tokens: int = BLOCK_TOKENS) -> bytes:
    """One segment of whole documents; every document has a token at least."""
    table = Table.of(tokens)
    packed = table.pack()
    blocks = [encode_block(tokens[k:k + block_tokens], table) for k in range(0, len(tokens), block_tokens)]
    body = b"".join([HEAD.pack(MAGIC, len(tokens), len(doc_ids), len(table.symbols), table.bits, len(blocks),
                               len(packed)),
                     np.asarray(doc_ids, "<i8").tobytes(), np.asarray(counts, "<u8").tobytes(), packed,
                     np.asarray([len(b) for b in blocks], "<u8").tobytes(), *blocks])
    return body + struct.pack("<I", zlib.crc32(body))


def open_segment(segment: bytes) -> tuple[np.ndarray, np.ndarray, Table, list[bytes]]:
    """Identifiers, token counts, frequency table and blocks; raises ValueError if the checksum is wrong."""
    if segment[:8] != MAGIC or zlib.crc32(segment[:-4]) != struct.unpack("<I", segment[-4:])[0]:
        raise ValueError("not a whole segment")
    _, _, documents, _, bits, count, length = HEAD.unpack_from(segment)
    at = HEAD.size
    doc_ids = np.frombuffer(segment, "<i8", documents, at)
    counts = np.frombuffer(segment, "<u8", documents, at + 8 * documents).astype(np.int64)
    at += 16 * documents
    table = Table.unpack(segment[at:at + length], bits)
    sizes = np.frombuffer(segment, "<u8", count, at + length).astype(np.int64)
    starts = at + length + 8 * count + np.cumsum(sizes) - sizes
    return doc_ids, counts, table, [segment[s:s + n] for s, n in zip(starts.tolist(), sizes.tolist())]


def decode_segment(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Identifiers, token counts and all tokens of a segment."""
    doc_ids, counts, table, blocks = open_segment(segment)
    spans = [decode_span(block, table, span) for block in blocks for span in range(spans_of(block))]
    return doc_ids, counts, np.concatenate(spans) if spans else np.empty(0, "<u4")


def _write(path: str, end_id: int, segment_tokens: int, batches: Iterator[pa.RecordBatch]
           ) -> Iterator[pa.RecordBatch]:
    vocabulary, words, end = vocabulary_at(path), library_words(path), end_id.to_bytes(4, "little")
    part, number, held = TaskContext.get().partitionId(), 0, 0
    doc_ids: list[int] = []
    packed: list[bytes] = []

    def flush() -> pa.RecordBatch:
        nonlocal number, held
        counts = [len(ids) // 4 for ids in packed]
        segment = encode_segment(doc_ids, counts, np.frombuffer(b"".join(packed), "<u4"))
        row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                                          pa.array([sum(counts)], pa.int64()), pa.array([segment], pa.binary())],
                                         ["part", "segment", "n_tokens", "payload"])
        doc_ids.clear()
        packed.clear()
        number, held = number + 1, 0
        return row

    for batch in sliced(batches, 1):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            doc_ids.append(doc_id)
            packed.append(packed_ids(vocabulary, words, text) + end)
            held += len(packed[-1]) // 4
            if held >= segment_tokens:
                yield flush()
    if packed:
        yield flush()


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 0, segment_tokens: int = SEGMENT_TOKENS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the tokens of each row and an end token, in ascending order of the identifier (null first).

    Rows with one identifier are ordered by a hash of their text, and ranges are cut by both, so that rows without
    an identifier, or with a shared one, go to as many parts as others. The table has a row for each segment:
    (part, segment, n_tokens, payload); parts, and segments within them, follow the order of identifiers.
    """
    ordered = (documents_of(docs, id_col, text_col).withColumn("place", F.xxhash64("text"))
               .repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text"))
    ordered.mapInArrow(functools.partial(_write, path, end_id, segment_tokens),
                       "part int, segment int, n_tokens long, payload binary").write.parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            doc_ids, counts, tokens = decode_segment(batch.column(2)[k].as_py())
            starts, raw = np.cumsum(counts) - counts, tokens.tobytes()
            row = batch.slice(k, 1)
            step = max(1, len(doc_ids) // max(1, len(raw) >> 23))  # so that a batch stays at some MB
            for low in range(0, len(doc_ids), step):
                high = min(low + step, len(doc_ids))
                ids = [raw[4 * s:4 * (s + n)] for s, n in zip(starts[low:high].tolist(), counts[low:high].tolist())]
                size = high - low
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.column(0)[0].as_py()] * size, pa.int32()),
                     pa.array([row.column(1)[0].as_py()] * size, pa.int32()), pa.array(doc_ids[low:high], pa.int64()),
                     pa.array(starts[low:high], pa.int64()), pa.array(counts[low:high], pa.int64()),
                     pa.array(ids, pa.binary())], ["part", "segment", "doc_id", "start", "n_tokens", "ids"])


def read_tokens(stored: DataFrame) -> DataFrame:
    """(part, segment, doc_id, start, n_tokens, ids) for each document of the segments; `start` counts within its
    segment, `ids` are little-endian unsigned 32-bit integers. Raises if a checksum is wrong."""
    return stored.select("part", "segment", "payload").mapInArrow(
        _read, "part int, segment int, doc_id long, start long, n_tokens long, ids binary")


def token_positions(stored: DataFrame) -> DataFrame:
    """(part, segment, before): tokens of all segments before each one; sums by part first, then within parts."""
    sizes = stored.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("first"))
    return (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(starts, "part")
            .select("part", "segment", (F.col("first") + F.col("inside")).alias("before")))


def round_trip(docs: DataFrame, path: str, folder: str | None = None, **options) -> DataFrame:
    """Write the token files (by default to a new shared folder) and read them back:
    (doc_id, start, n_tokens, ids), where `start` counts the tokens of all documents before."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    write_tokens(docs, path, folder, **options)
    stored = spark.read.schema("part int, segment int, n_tokens long, payload binary").parquet(folder)
    return (read_tokens(stored).join(token_positions(stored), ["part", "segment"])
            .select(outer_id(), (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids"))
