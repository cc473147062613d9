"""Token counts by merging many pre-tokens at once, one rank step for all of them.

New pre-tokens of a slice of texts are laid end to end in one ragged array of symbols. Each step looks up the ranks
of all adjacent symbols, takes the lowest rank of each sequence, merges that pair wherever it stands in its
sequence, and closes the gaps; sequences without a ranked pair leave. The number of symbols that survive is the
count. A merged symbol only takes part in pairs of higher rank, so merging all places of a pair in one step gives
what merging them one after another gives.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, kept, outer_id, sliced
from sparkloom.llm.tokens import Vocabulary, vocabulary_at, word_bytes

REMEMBERED = 400_000
NONE = np.iinfo(np.int64).max


class RankTable:
    """Merge rules as sorted arrays."""

    def __init__(self, vocabulary: Vocabulary):
        keys = np.fromiter(vocabulary.rank.keys(), np.int64, len(vocabulary.rank))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(vocabulary.rank.values(), np.int64, len(keys))[order]
        self.merged = np.asarray(vocabulary.merged, np.int64)
        self.first, self.last = np.asarray(vocabulary.first, np.int64), np.asarray(vocabulary.last, np.int64)
        self.span = vocabulary.span

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)


def surviving(table: RankTable, words: list[bytes]) -> np.ndarray:
    """Number of tokens of each word; no word may be empty."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(lengths)
    symbols = table.first[flat]
    symbols[ends - 1] = table.last[flat[ends - 1]]
    owner = np.repeat(np.arange(len(words)), lengths)
    counts = np.ones(len(words), np.int64)
    ranks = np.full(len(symbols), NONE)
    inside = owner[:-1] == owner[1:]
    ranks[:-1][inside] = table.of(symbols[:-1][inside], symbols[1:][inside])
    while len(symbols):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[heads, len(symbols)])
        least = np.minimum.reduceat(ranks, heads)
        active = least != NONE
        counts[owner[heads]] = sizes
        if not active.all():
            keep = np.repeat(active, sizes)
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            if not len(symbols):
                break
            sizes, least = sizes[active], least[active]
        hits = np.flatnonzero(ranks == np.repeat(least, sizes))
        # A run of hits is one symbol repeated: pairs overlap there, and every second one merges.
        runs = np.flatnonzero(np.r_[True, np.diff(hits) != 1])
        place = np.arange(len(hits)) - np.repeat(runs, np.diff(np.r_[runs, len(hits)]))
        hits = hits[place % 2 == 0]
        symbols[hits] = table.merged[ranks[hits]]
        stay = np.ones(len(symbols), bool)
        stay[hits + 1] = False
        moved = hits - np.arange(len(hits))
        symbols, owner, ranks = symbols[stay], owner[stay], ranks[stay]
        touched = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
        ranks[touched] = NONE
        inner = touched[touched + 1 < len(symbols)]
        inner = inner[owner[inner] == owner[inner + 1]]
        ranks[inner] = table.of(symbols[inner], symbols[inner + 1])
    return counts


def _state(path: str) -> tuple[RankTable, dict[str, int]]:
    return kept(f"tokens of {path}", "counts", lambda: (RankTable(vocabulary_at(path)), {}))


def count_texts(path: str, texts: list[str]) -> list[int]:
    vocabulary = vocabulary_at(path)
    table, known = _state(path)
    if len(known) >= REMEMBERED:
        known.clear()
    found = [list(vocabulary.pieces(text)) for text in texts]
    new = list(set().union(*(words for pieces in found for _, words in pieces)) - known.keys())
    if new:
        known.update(zip(new, surviving(table, [word_bytes(word) for word in new]).tolist()))
    return [sum(1 if special is not None else sum(map(known.__getitem__, words)) for special, words in pieces)
            for pieces in found]


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 1, 1 << 20):
        counts = count_texts(path, batch.column(1).to_pylist())
        sizes = pc.binary_length(batch.column(1)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64())],
                                         ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row; an empty or null text has 0 of both.

    `n_bytes` counts UTF-8 bytes, `over_limit` says whether there are more than `limit` tokens. One pass, no
    shuffle; a process remembers at most about `REMEMBERED` pre-tokens.
    """
    counted = documents_of(docs, id_col, text_col).mapInArrow(
        functools.partial(_count, path), "doc_id long, n_bytes long, n_tokens long")
    return counted.select(outer_id(), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
