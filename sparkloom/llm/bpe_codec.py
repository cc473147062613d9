"""BPE encoding and decoding with a contiguous array of ranks for each pre-token.

A pre-token is held as the list of its parts and, beside it, the list of the ranks of adjacent parts. The list of
ranks is scanned for its minimum, the boundary there is deleted, and the two ranks beside it are refreshed, until
no pair has a rank. Words beyond `SHORT` parts, for which repeated scans would be quadratic, take the same merges
from a heap. Each Python process remembers the pre-tokens it has met (at most `most` of them).
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkloom.llm.common import BoundedMemory, documents_of, kept, outer_id, sliced
from sparkloom.llm.tokens import Vocabulary, packed_ids, packed_words, vocabulary_at

SHORT = 256
NONE = 1 << 60


def merge_short(vocabulary: Vocabulary, parts: list[int]) -> list[int]:
    """Merge the parts of one word in place and return them."""
    rank, merged, span = vocabulary.rank.get, vocabulary.merged, vocabulary.span
    ranks = [rank(a * span + b, NONE) for a, b in zip(parts, parts[1:])]
    while ranks:
        least = min(ranks)
        if least == NONE:
            break
        k = ranks.index(least)
        parts[k] = merged[least]
        del parts[k + 1], ranks[k]
        if k < len(ranks):
            ranks[k] = rank(parts[k] * span + parts[k + 1], NONE)
        if k:
            ranks[k - 1] = rank(parts[k - 1] * span + parts[k], NONE)
    return parts


def merge_long(vocabulary: Vocabulary, parts: list[int]) -> list[int]:
    """The same merges for a word of any length: pairs wait in a heap, parts are linked to their neighbours."""
    rank, merged, span = vocabulary.rank.get, vocabulary.merged, vocabulary.span
    count = len(parts)
    before, after = list(range(-1, count - 1)), list(range(1, count + 1))
    heap = [(r, k) for k in range(count - 1) if (r := rank(parts[k] * span + parts[k + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        least, k = heapq.heappop(heap)
        right = after[k]
        if parts[k] < 0 or right >= count or rank(parts[k] * span + parts[right]) != least:
            continue
        parts[k], parts[right] = merged[least], -1
        after[k] = after[right]
        if after[k] < count:
            before[after[k]] = k
            if (r := rank(parts[k] * span + parts[after[k]])) is not None:
                heapq.heappush(heap, (r, k))
        if before[k] >= 0 and (r := rank(parts[before[k]] * span + parts[k])) is not None:
            heapq.heappush(heap, (r, before[k]))
    return [part for part in parts if part >= 0]


def encode_word(vocabulary: Vocabulary, word: bytes) -> list[int]:
    parts = vocabulary.symbols(word)
    return merge_short(vocabulary, parts) if len(parts) <= SHORT else merge_long(vocabulary, parts)


def _remembered(path: str) -> BoundedMemory:
    return kept(f"tokens of {path}", "merged words",
                lambda: packed_words(functools.partial(encode_word, vocabulary_at(path))))


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text the library gives: byte letters undone if the file has a decoder, else tokens joined by spaces."""
    tokens = map(vocabulary.tokens.__getitem__, ids.tolist())
    if vocabulary.library.decoder is None:
        return " ".join(tokens)
    byte_of, special, out = vocabulary.byte_of, vocabulary.special, bytearray()
    for token in tokens:
        out += token.encode() if token in special else bytes(map(byte_of.__getitem__, token))
    return out.decode("utf-8", "replace")


def _encode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary, words = vocabulary_at(path), _remembered(path)
    for batch in sliced(batches, 1):
        ids = [packed_ids(vocabulary, words, text) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])


def _decode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = vocabulary_at(path)
    for batch in sliced(batches, 1):
        texts = [decode_ids(vocabulary, np.frombuffer(ids, "<u4")) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                         ["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for each row; `ids` are little-endian unsigned 32-bit integers, none for an empty text.

    Strings of special tokens inside a text become their identifiers, as in the library's default; nothing is
    added, cut or padded. One pass, no shuffle.
    """
    return documents_of(docs, id_col, text_col).mapInArrow(
        functools.partial(_encode, path), "doc_id long, ids binary").select(outer_id(), "ids")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for rows of `encode`: the library's text of the identifiers, special tokens kept."""
    return encoded.select("doc_id", "ids").mapInArrow(
        functools.partial(_decode, path), "doc_id long, ids binary, decoded string")
