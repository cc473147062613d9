"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Base counts reject documents that are too short or repeat themselves. For the others the lines with a word form a
sequence; each has a few numbers (symbols, capitals, repeated words, ...), and the Viterbi path over line scores and
label transitions marks it as content or boilerplate. A document stays when enough of its words are in content lines.

The field is fitted on a bounded sample of labelled documents: `SAMPLE` documents by a hash of the identifier, at
most `LINES_EACH` lines in a row of each, from a place by a hash of the text, all lines of a document with its label.
Their numbers count what stands before them in the whole document. Everything else covers all data.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, outer_id

SAMPLE, LINES_EACH, SHARE = 1500, 32, 0.5
SPACE = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
DIGIT = re.compile(r"[0-9]")
FEATURES = ("bias", "log words", "mean word length", "symbols per word", "marks per word", "capital words",
            "digits per word", "distinct words", "repeated neighbours", "line met before", "bars per word")


class Field(NamedTuple):
    """Weights of the label `content` against `boilerplate`, and scores of label pairs (from, to)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray


def accept_all() -> Field:
    """The field that marks every line as content; used when there is nothing to learn from."""
    weights = np.zeros(len(FEATURES))
    weights[0] = 1.0
    return Field(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), weights, np.zeros((2, 2)))


def lines_of(text: str) -> list[tuple[str, list[str]]]:
    """Lines with a word, and their words."""
    return [(line, words) for line in text.split("\n") if (words := WORD.findall(line))]


def line_features(lines: list[tuple[str, list[str]]]) -> np.ndarray:
    rows, met = [], set()
    for line, words in lines:
        n = len(words)
        rows.append((1.0, np.log1p(n), sum(map(len, words)) / n, len(SYMBOL.findall(line)) / n, line.count("!") / n,
                     sum(map(str.isupper, words)) / n, len(DIGIT.findall(line)) / n, len(set(words)) / n,
                     sum(map(eq, words, words[1:])) / n, float(line in met), line.count("|") / n))
        met.add(line)
    return np.array(rows, float).reshape(-1, len(FEATURES))


def viterbi(scores: list[float], transitions: list[list[float]]) -> list[int]:
    """Best labels (1 content) for scores of `content`, where `boilerplate` scores 0."""
    (a, b), (c, d) = transitions
    low, high, back = 0.0, scores[0], []
    for score in scores[1:]:
        from_low, from_high = low + a >= high + c, low + b > high + d
        back.append((0 if from_low else 1, 0 if from_high else 1))
        low, high = (low + a if from_low else high + c), (low + b if from_high else high + d) + score
    label = int(high >= low)
    path = [label]
    for steps in reversed(back):
        label = steps[label]
        path.append(label)
    path.reverse()
    return path


def fit(sequences: list[np.ndarray], labels: list[int], rounds: int = 120, decay: float = 1e-3) -> Field:
    """Maximise the likelihood of the labels, each held by all lines of its sequence, by gradient ascent."""
    pairs = [(x, y) for x, y in zip(sequences, labels) if len(x)]
    if len({y for _, y in pairs}) < 2:
        return accept_all()
    longest = max(len(x) for x, _ in pairs)
    everything = np.concatenate([x for x, _ in pairs])
    mean, scale = everything.mean(0), everything.std(0)
    mean[0], scale[0] = 0.0, 1.0
    scale[scale < 1e-9] = 1.0
    x = np.zeros((len(pairs), longest, len(FEATURES)))
    held = np.zeros((len(pairs), longest))
    for k, (rows, _) in enumerate(pairs):
        x[k, :len(rows)] = (rows - mean) / scale
        held[k, :len(rows)] = 1
    y = np.array([label for _, label in pairs], float)
    # Both labels weigh the same, however many lines each has.
    weight = np.where(y == 1, 0.5 / max(1.0, held[y == 1].sum()), 0.5 / max(1.0, held[y == 0].sum()))
    steps = held[:, 1:] * held[:, :-1]
    theta, first, second = np.zeros(len(FEATURES) + 4), 0.0, 0.0
    for turn in range(1, rounds + 1):
        w, t = theta[:-4], theta[-4:].reshape(2, 2)
        emit = np.stack([np.zeros(held.shape), x @ w], -1) * held[..., None]
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for k in range(1, longest):
            grown = np.logaddexp.reduce(forward[:, k - 1, :, None] + t, 1) + emit[:, k]
            forward[:, k] = np.where(held[:, k, None] > 0, grown, forward[:, k - 1])
        for k in range(longest - 2, -1, -1):
            grown = np.logaddexp.reduce(t + (emit[:, k + 1] + backward[:, k + 1])[:, None, :], 2)
            backward[:, k] = np.where(held[:, k + 1, None] > 0, grown, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], -1)[:, None, None]
        marginal = np.exp(forward + backward - total) * held[..., None]
        pair = np.exp(forward[:, :-1, :, None] + t + (emit + backward)[:, 1:, None, :] - total[..., None])
        pair *= steps[..., None, None]
        gap = (y[:, None] - marginal[..., 1]) * held * weight[:, None]
        true = np.stack([(1 - y) * weight @ steps, y * weight @ steps], 0).sum(1)
        slope_t = np.diag(true) - (pair * weight[:, None, None, None]).sum((0, 1))
        slope = np.concatenate([np.einsum("nk,nkf->f", gap, x), slope_t.ravel()]) - decay * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta = theta + 0.1 * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return Field(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def content_share(field: Field, lines: list[tuple[str, list[str]]]) -> float:
    """Share of words in lines that the best path marks as content; 0 without a line."""
    if not lines:
        return 0.0
    scores = ((line_features(lines) - field.mean) / field.scale) @ field.weights
    path = viterbi(scores.tolist(), field.transitions.tolist())
    sizes = [len(words) for _, words in lines]
    return sum(n for n, label in zip(sizes, path) if label) / sum(sizes)


def repeated_words(words: list[str], span: int = 3) -> int:
    """Words that lie in a window of `span` words found twice or more."""
    if len(words) <= span:
        return 0
    number: dict[str, int] = {}
    codes = np.fromiter((number.setdefault(word, len(number)) for word in words), np.int64, len(words))
    keys = codes
    for k in range(1, span):  # re-numbering after each step keeps the numbers small for any length
        keys = np.unique(keys[:-1] * len(number) + codes[k:], return_inverse=True)[1]
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.bincount(keys)[keys] > 1)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + span, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_counts(text: str, lines: list[tuple[str, list[str]]]) -> tuple[int, int, int, int, int, bool]:
    words = [word for _, found in lines for word in found]
    met: set[str] = set()
    copies = 0
    for line, _ in lines:
        copies += line in met
        met.add(line)
    repeats = repeated_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    return (len(words), len(text) - sum(map(text.count, SPACE)), len(SYMBOL.findall(text)), copies, repeats, failed)


def stretch(text: str, count: int, most: int) -> slice:
    """At most `most` of `count` lines: one of the fewest parts of even length, so that each line is as likely."""
    parts = max(1, -(-count // most))
    part = zlib.crc32(text.encode("utf-8", "surrogatepass")) % parts
    return slice(part * count // parts, (part + 1) * count // parts)


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, content_share double, kept boolean")


def verdict(field: Field, share: float = SHARE) -> Callable[[Column], Column]:
    """A column function: the struct `VERDICT` of a text column (null: an empty text)."""

    @F.pandas_udf(VERDICT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            lines = lines_of(text)
            counts = base_counts(text, lines)
            content = content_share(field, lines)
            rows.append((*counts, content, not counts[-1] and content >= share))
        return pd.DataFrame(rows, columns=[part.split(" ")[0] for part in VERDICT.split(", ")])

    return judge


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines_each: int = LINES_EACH,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field:
    """Fit the field on at most `sample` labelled documents (label 1: content, 0: boilerplate, null: not used).

    Without documents of both labels the field marks every line as content. Runs one job at once, which brings the
    numbers of at most sample x lines_each lines to the driver.
    """

    def sampled(text: str) -> np.ndarray:
        rows = line_features(lines_of(text))
        return rows[stretch(text, len(rows), lines_each)].ravel()

    @F.pandas_udf("array<double>")
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series([sampled(text) for text in texts])

    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (documents_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # `sample` rows
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
            .select("label", numbers("text").alias("numbers")).collect())
    return fit([np.array(row["numbers"]).reshape(-1, len(FEATURES)) for row in rows], [row["label"] for row in rows])


def judge(docs: DataFrame, field: Field, share: float = SHARE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept).

    Words are runs of characters other than space and \\x09-\\x0D. `base_failed`: fewer than 50 words, or more than
    half of the words in repeated three-word windows. `kept`: not failed, and at least `share` of the words are in
    content lines. One pass, no shuffle.
    """
    judged = documents_of(docs, id_col, text_col).select(outer_id(), verdict(field, share)("text").alias("v"))
    return judged.select("doc_id", "v.*")


def keep_rows(docs: DataFrame, field: Field, share: float = SHARE, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `judge` keeps, with all their columns."""
    return docs.where(verdict(field, share)(F.col(text_col))["kept"])
