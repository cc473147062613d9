"""Quality classifier: labelled documents near a document in a latent-semantic space vote on its label.

1. Terms of a text are its runs of three characters, with letters and digits reduced to their kinds (so that
   `fox %%` and `dog %%` share terms), hashed into `BUCKETS`; words that repeat the word before them; and the
   binary order of the text's length. Document frequencies count every document.
2. A bounded sample of labelled documents, `SAMPLE` of them by a hash of the identifier, is weighted by logarithmic
   term counts and inverse document frequencies; its leading `DIMENSIONS` singular directions are the latent space.
3. The labelled vectors go to every task. Blocks of documents are multiplied with all of them, which gives exact
   cosines; the `NEIGHBOURS` largest vote with their cosine as weight.

The label is the only thing that is learned from. Everything but the sample covers all documents and whole texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, outer_id, sliced

SAMPLE, BUCKETS, DIMENSIONS, NEIGHBOURS = 2048, 4096, 64, 9
ORDERS = 40  # binary orders of a text's length
TERMS = BUCKETS + 1 + ORDERS
ROWS, STRETCH = 256, 1 << 20  # documents and bytes worked on at once
SMALL, LARGE, DIGIT, WIDE, BREAK, SPACE = range(1, 7)


def _kinds() -> np.ndarray:
    """The kind of each byte: its class, or a number of its own for each mark."""
    kinds = np.zeros(256, np.uint32)
    kinds[ord("a"):ord("z") + 1], kinds[ord("A"):ord("Z") + 1], kinds[ord("0"):ord("9") + 1] = SMALL, LARGE, DIGIT
    kinds[128:], kinds[[9, 11, 12, 13, 32]], kinds[10] = WIDE, SPACE, BREAK
    marks = np.flatnonzero(kinds[:128] == 0)
    kinds[marks] = SPACE + 1 + np.arange(len(marks))
    return kinds


KINDS = _kinds()


def _repeats(data: np.ndarray) -> int:
    """Words, between spaces or line breaks, that equal the word before them (compared by 64 bits of a hash)."""
    blank = (KINDS[data] == SPACE) | (data == 10)
    inside = np.concatenate([[False], ~blank, [False]])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    if len(starts) < 2:
        return 0
    begun = np.zeros(len(data), np.int64)
    begun[starts] = starts
    place = (np.arange(len(data)) - np.maximum.accumulate(begun)).astype(np.uint64)  # within the word
    mixed = (data.astype(np.uint64) + np.uint64(1)) * (place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(12345))
    mixed ^= mixed >> np.uint64(29)
    mixed[blank] = 0
    hashes, sizes = np.add.reduceat(mixed, starts), ends - starts
    return int(((hashes[1:] == hashes[:-1]) & (sizes[1:] == sizes[:-1])).sum())


def term_counts(text: bytes) -> np.ndarray:
    """How often each term occurs in a text."""
    counts = np.zeros(TERMS, np.int64)
    counts[BUCKETS + 1 + min(len(text).bit_length(), ORDERS - 1)] = 1
    data = np.frombuffer(text, np.uint8)
    for first in range(0, max(0, len(data) - 2), STRETCH):  # the next stretch begins with the triple after the last
        kinds = KINDS[data[first:first + STRETCH + 2]]
        codes = (kinds[:-2] << 12) | (kinds[1:-1] << 6) | kinds[2:]
        counts[:BUCKETS] += np.bincount((codes * np.uint32(2654435761)) >> 20, minlength=BUCKETS)
    first = 0
    while first < len(data):  # stretches end behind a blank, where there is one
        last = min(len(data), first + STRETCH)
        if last < len(data):
            cut = max(text.rfind(b" ", first, last), text.rfind(b"\n", first, last))
            last = cut + 1 if cut >= first else last
        counts[BUCKETS] += _repeats(data[first:last])
        first = last
    return counts


class Space(NamedTuple):
    """Weights of terms, latent directions, and the labelled vectors with their labels."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * weights)


def fit(counts: np.ndarray, labels: np.ndarray, frequencies: np.ndarray, total: int,
        dimensions: int = DIMENSIONS) -> Space:
    """The latent space of labelled term counts (documents x terms), and the documents' places in it."""
    weights = np.log((1 + total) / (1 + frequencies)) + 1
    rows = _weighted(counts, weights)
    values, left = np.linalg.eigh(rows @ rows.T)  # the sample is smaller than the vocabulary
    chosen = np.argsort(-values)[:dimensions]
    chosen = chosen[values[chosen] > 1e-9]
    directions = rows.T @ (left[:, chosen] / np.sqrt(values[chosen]))
    return Space(weights, directions, _unit(rows @ directions), labels,
                 float(labels.mean()) if len(labels) else 0.5)


def votes(space: Space, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block of documents: mean label of the nearest labelled ones, weighted by cosine.

    Cosines count to six digits and equal ones go by the sample's order, so that a score does not depend on the
    block. Where no neighbour has a positive cosine the score is the share of label 1 in the sample.
    """
    if not len(space.labels):
        return np.full(len(counts), space.prior)
    cosines = _unit(_weighted(counts, space.weights) @ space.directions) @ space.vectors.T
    size = len(space.labels)
    keys = np.rint(cosines * 1e6).astype(np.int64) * size - np.arange(size)
    most = min(neighbours, size)
    nearest = np.argpartition(-keys, most - 1, axis=1)[:, :most]
    nearest.sort(axis=1)
    weight = np.maximum(0, np.rint(np.take_along_axis(cosines, nearest, 1) * 1e6))
    total = weight.sum(1)
    return np.where(total > 0, (weight * space.labels[nearest]).sum(1) / np.maximum(total, 1), space.prior)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most `ROWS` documents with their term counts."""
    for batch in sliced(batches, 1):
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part, np.array([term_counts(text) for text in part.column(1).cast(pa.binary()).to_pylist()])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(TERMS, np.int64), 0
    for part, counts in _blocks(batches):
        total += (counts > 0).sum(0)
        rows += part.num_rows
    if rows:
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1)), pa.array(np.append(total[met], rows))],
                                         names=["term", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, counts in _blocks(batches):
        met = [np.flatnonzero(row) for row in counts]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), pa.array([m.astype("<i4").tobytes() for m in met]),
             pa.array([row[m].astype("<i8").tobytes() for row, m in zip(counts, met)])],
            names=["doc_id", "label", "terms", "counts"])


def _scores(space: Space, neighbours: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, counts in _blocks(batches):
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(votes(space, counts, neighbours))],
                                         names=["doc_id", "score"])


def held_out(identifier: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row belongs to the fold that nothing is learned from; false without an identifier."""
    return F.coalesce(F.crc32(identifier.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Space:
    """Fit the space on at most `sample` labelled documents outside the held-out fold.

    Labels other than 0 and 1, and rows without an identifier, are not used; an identifier with several labels
    counts with their mean. Rows of `docs` that share a labelled identifier are labelled documents one by one.
    Without labelled documents every score is 0.5. Runs two jobs at once: one over all texts for the document
    frequencies, of which `TERMS` numbers reach the driver, and one for the sample, at most `sample` rows of at most
    `TERMS` counts.
    """
    texts = documents_of(docs, id_col, text_col)
    counted = texts.mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {row["term"]: row["n"] for row in counted}
    frequencies = np.array([found.get(term, 0) for term in range(TERMS)])
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col).cast("long")))
              .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.avg(label_col).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")  # `sample` rows
            .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample)
            .mapInArrow(_sparse, "doc_id long, label double, terms binary, counts binary").collect())
    counts = np.zeros((len(rows), TERMS))
    for k, row in enumerate(rows):
        counts[k, np.frombuffer(row["terms"], "<i4")] = np.frombuffer(row["counts"], "<i8")
    return fit(counts, np.array([row["label"] for row in rows], float), frequencies, found.get(-1, 0), dimensions)


def judge(docs: DataFrame, space: Space, threshold: float = 0.7, neighbours: int = NEIGHBOURS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row: one pass over the texts, no shuffle.

    `score` is between 0 and 1; `predicted` is 1 where it reaches `threshold`. An empty text has its length as
    only term, so other empty or very short texts are its neighbours.
    """
    scored = documents_of(docs, id_col, text_col).mapInArrow(
        functools.partial(_scores, space, neighbours), "doc_id long, score double")
    return scored.select(outer_id(), held_out(outer_id()).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))

