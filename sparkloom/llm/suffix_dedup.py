"""Repeated byte strings, found on Burrows-Wheeler transforms of the places that may repeat.

A window of `width` bytes is removed wherever it stands more than once in the collection. The work is cut by content:

1. Each window has an anchor, the place of the smallest hash of `GRAM` bytes in it; equal windows have equal anchors
   at the same place. Anchors that occur once in the collection, nearly all, belong to no repeated window.
2. Around each other anchor the bytes of all windows that it stands for are one string, at most 2 x width - GRAM
   bytes. Equal strings of one anchor are added up: a string that occurs twice is repeated as a whole.
3. An anchor with several different strings is refined: its windows are dealt to ranges of their distance from it,
   and the bytes that all windows of a range share become the new anchor. Most strings are then alone or equal.
4. Anchors that still have several are dealt out over tasks. A string is left out if it has no stretch in common with
   another one of its anchor that a shared window would give them. The tasks build the transform and the common
   prefixes of the others, column by column (`collection_bwt`), in blocks of bounded size. A window is repeated if it has its
   width in common with a neighbour. An anchor with more strings than a block should hold is refined to narrower
   ranges first. The last range is one window, whose strings are all equal, so no group stays too large, and no pair
   of strings is ever formed.
5. The repeated windows of a document are put together and cut out of it.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import operator
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.collection_bwt import repeated_starts
from sparkloom.llm.common import LOWEST, BoundedMemory, bounded_batches, documents_of, free_names, kept, outer_id, sliced
from sparkloom.workspace import written

GRAM = 128
BLOCK = 1 << 20  # bytes of strings in a transform
MOST = 1000  # different strings of an anchor before it is refined
STRETCH = 1 << 18  # windows of a text that are worked on at once
RANGES = (64, 8, 1)  # widths of the ranges of refinement
NARROW = 8  # width of the ranges by which strings are left out of a transform
CODE = 6  # bytes of a word's code
_FACTOR = 0x9E3779B97F4A7C15 | 1


MEMORY = 24 << 20  # bytes of words that a process remembers


def _code(word: bytes) -> bytes:
    """CODE ASCII characters, 7 bits of the word's hash each."""
    return bytes(b & 127 for b in hashlib.blake2b(word, digest_size=CODE).digest())


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def word_codes(text: str) -> bytes:
    """The codes of the words one after another; words are runs of bytes other than space and \\x09-\\x0D."""
    known = kept("word codes", "codes", lambda: BoundedMemory(_code, MEMORY))
    return b"".join(map(known.__getitem__, utf8(text).split()))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each `size` bytes, by doubling."""
    done, have, power, step = None, 0, data.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1), 1
    while True:
        if size & step:
            if done is None:
                done, have = power, step
            else:
                factor = np.uint64(pow(_FACTOR, step, 1 << 64))
                done = done[:len(power) - have] * factor + power[have:][:len(done)] if len(power) > have else done[:0]
                have += step
        if 2 * step > size:
            break
        if len(power) <= step:
            return np.empty(0, np.uint64)
        power = power[:-step] * np.uint64(pow(_FACTOR, step, 1 << 64)) + power[step:]
        step *= 2
    done = done ^ (done >> np.uint64(29))
    done = done * np.uint64(0xBF58476D1CE4E5B9)
    return done ^ (done >> np.uint64(32))


def anchors_of(data: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of the anchors of a text, in order; windows by their start.

    The anchor of a window is the place in it with the smallest hash, the first one of several. Hashes count without
    their lowest bits, the same for every text. Windows are worked on in stretches, so a long text needs little more
    than its anchors.
    """
    count, span = len(data) - width + 1, width - gram + 1
    if count <= 0:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    # The high bits of the hash and the place make one number, so that the least says where it stands.
    low = np.uint64((1 << (STRETCH + width).bit_length()) - 1)
    found: list[tuple[np.ndarray, ...]] = []
    before = -1
    for start in range(0, count, STRETCH):
        hashes = gram_hashes(data[start:start + STRETCH + width - 1], gram)
        least, have = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
        while 2 * have <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
        places = (least & low).astype(np.int64)
        first = np.flatnonzero(np.r_[start + places[0] != before, places[1:] != places[:-1]])
        before = start + int(places[-1])
        found.append((hashes[places[first]], start + places[first], start + first))
    hashes, places, first = map(np.concatenate, zip(*found))
    return hashes, places, first, np.r_[first[1:], count] - 1


ANCHORS = "anchor long, doc_id long, mark long, first long, ahead int, size int, times int"


def _once(raw: bytes, found: tuple[np.ndarray, ...], width: int) -> tuple[np.ndarray, ...]:
    """(hash, first window, bytes before the anchor, windows, times): neighbours with one string as one row.

    In a text that repeats itself over and over, anchors follow one another with equal strings; such a run is one row
    that counts `times`, and its windows are the same number of times as many.
    """
    hashes, places, first, last = found
    ahead, size = places - first, last - first + 1
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (ahead[1:] == ahead[:-1]) & (size[1:] == size[:-1])) + 1
    heads = np.ones(len(hashes), bool)
    for some in range(0, len(same), STRETCH):
        for k in same[some:some + STRETCH].tolist():
            a, b, length = int(first[k - 1]), int(first[k]), int(size[k]) - 1 + width
            heads[k] = raw[a:a + length] != raw[b:b + length]
    kept = np.flatnonzero(heads)
    times = np.diff(np.r_[kept, len(hashes)])
    return hashes[kept], first[kept], ahead[kept], size[kept], times


def _anchor_rows(width: int, gram: int, raw_of: Callable[[str], bytes], batches: Iterator[pa.RecordBatch]
                 ) -> Iterator[pa.RecordBatch]:
    """The anchors of each text: their first window, the bytes from there to the anchor, and how many windows."""
    for batch in sliced(batches, 1):
        columns: list[list[np.ndarray]] = [[] for _ in range(7)]
        for doc_id, text, mark in zip(*(c.to_pylist() for c in batch.columns)):
            raw = raw_of(text)
            hashes, first, ahead, size, times = _once(
                raw, anchors_of(np.frombuffer(raw, np.uint8), width, gram), width)
            for column, values in zip(columns, (
                    hashes.astype(np.int64), np.full(len(first), doc_id, np.int64), np.full(len(first), mark, np.int64),
                    first, ahead.astype(np.int32), size.astype(np.int32), times.astype(np.int32))):
                column.append(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns],
                                         [part.split(" ")[0] for part in ANCHORS.split(", ")])


STRINGS = "anchor long, doc_id long, mark long, first long, ahead int, size int, times int, sig binary, bytes binary"


def _string_rows(width: int, raw_of: Callable[[str], bytes], batches: Iterator[pa.RecordBatch]
                 ) -> Iterator[pa.RecordBatch]:
    """The strings of the chosen anchors; the bytes of a string are given once in a batch."""
    for batch in sliced(batches, 2, 1 << 20):
        met, rows = set(), []
        for doc_id, mark, text, chosen in zip(*(c.to_pylist() for c in batch.columns)):
            raw = raw_of(text)
            for one in chosen:
                anchor, first, size = one["anchor"], one["first"], one["size"]
                string = raw[first:first + size - 1 + width]
                sig = hashlib.blake2b(string, digest_size=16).digest()
                new = (anchor, sig) not in met
                met.add((anchor, sig))
                rows.append((anchor, doc_id, mark, first, one["ahead"], size, one["times"], sig,
                             string if new else None))
        if rows:
            kinds = (*[pa.int64()] * 4, *[pa.int32()] * 3, pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             [part.split(" ")[0] for part in STRINGS.split(", ")])


def _cores(ahead: int, string: bytes, width: int, step: int) -> Iterator[tuple[int, bytes]]:
    """(q, core): what all windows whose distance to the anchor is in [q x step, (q + 1) x step) have in common."""
    nearest = ahead - (len(string) - width)  # distance of the last window
    for q in range(nearest // step, ahead // step + 1):
        yield q, string[ahead - q * step:ahead - (q * step + step - 1) + width]


def _sharing(group: list[tuple[int, bytes, int, bytes]], width: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(anchor, sig, string) of the different strings of an anchor that may share a window with another one.

    Equal windows are equally far from the anchor, so they have a core of one narrow range in common, by its hash; a
    string without such a core has no repeated window.
    """
    cores = [[hash(core) for core in _cores(ahead, string, width, NARROW)] for _, _, ahead, string in group]
    times = Counter(itertools.chain.from_iterable(cores))
    for (anchor, sig, _, string), own in zip(group, cores):
        if any(times[core] > 1 for core in own):
            yield anchor, sig, string


def _found(width: int, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, sig, from, to): runs of repeated windows of the strings of whole anchors, by their start in the
    string."""
    held: list[tuple] = []
    size = 0

    def settled() -> pa.RecordBatch:
        rows = []
        for (anchor, sig, string), starts in zip(held, repeated_starts([h[2] for h in held], width)):
            if len(starts):
                cuts = np.flatnonzero(np.diff(starts) != 1) + 1
                rows += [(anchor, sig, int(run[0]), int(run[-1]) + 1) for run in np.split(starts, cuts)]
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(4)],
                                          ["anchor", "sig", "from", "to"])

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for _, group in itertools.groupby(rows, operator.itemgetter(0)):
        sharing = list(_sharing(list(group), width))
        held += sharing
        size += sum(len(string) for _, _, string in sharing)
        if size >= block:
            yield settled()
            held.clear()
            size = 0
    if held:
        yield settled()


PARTS = "anchor long, sig binary, part_anchor long, part_sig binary, at int, ahead int, size int"


def _parts(width: int, step: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of narrower ranges: windows whose distance to the anchor is in [q x step, (q + 1) x step)."""
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
    names = [part.split(" ")[0] for part in PARTS.split(", ")]
    for batch in batches:
        rows = []
        for anchor, sig, ahead, string in zip(*(c.to_pylist() for c in batch.columns)):
            nearest = ahead - (len(string) - width)  # distance of the last window
            for q, core in _cores(ahead, string, width, step):
                far, near = min(ahead, q * step + step - 1), max(nearest, q * step)
                part = string[ahead - far:ahead - near + width]
                key = hashlib.blake2b(core + q.to_bytes(4, "little"), digest_size=8).digest()
                rows.append((anchor, sig, int.from_bytes(key, "little", signed=True),
                             hashlib.blake2b(part, digest_size=16).digest(), ahead - far, far, far - near + 1))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _repeated(rows: DataFrame, texts: Callable[[DataFrame], DataFrame], width: int, ranges: tuple[int, ...],
              most: tuple[int, ...], block: int) -> DataFrame:
    """(anchor, sig, from, to) of repeated windows for written rows (anchor, sig, size, times): `times` occurrences.

    `texts` gives (anchor, sig, ahead, bytes, k) of the strings of wanted anchors (anchor, k). Anchors with more than
    the first of `most` strings are refined to the first of `ranges`; at the end of `ranges` none is.
    """
    strings = rows.groupBy("anchor", "sig").agg(F.sum("times").alias("n"), F.first("size").alias("size"))
    # A string that occurs twice is repeated as a whole; with another one of its anchor it may be so in part.
    found = strings.where("n > 1").select("anchor", "sig", F.lit(0).alias("from"), F.col("size").alias("to"))
    several = written(texts(strings.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1")), "suffix-strings")
    limit = most[0] if ranges else None
    if limit is None or limit > 1:
        runs = (several.where(F.col("k") <= limit if limit else F.lit(True)).select("anchor", "sig", "ahead", "bytes")
                .repartition("anchor").sortWithinPartitions("anchor")
                .mapInArrow(functools.partial(_found, width, block), "anchor long, sig binary, from int, to int"))
        found = found.unionByName(runs)
    if limit is None:
        return found
    large = several.where(F.col("k") > limit)
    if large.isEmpty():
        return found
    parts = written(large.select("anchor", "sig", "ahead", "bytes").mapInArrow(
        functools.partial(_parts, width, ranges[0]), PARTS), "suffix-parts")

    def part_texts(wanted: DataFrame) -> DataFrame:
        one = (parts.join(wanted.withColumnRenamed("anchor", "part_anchor"), "part_anchor")
               .dropDuplicates(["part_anchor", "part_sig"]))
        return (one.join(large.select("anchor", "sig", "bytes"), ["anchor", "sig"])
                .select(F.col("part_anchor").alias("anchor"), F.col("part_sig").alias("sig"), "ahead",
                        F.expr(f"substring(bytes, at + 1, size + {width - 1})").alias("bytes"), "k"))

    inner = _repeated(parts.select(F.col("part_anchor").alias("anchor"), F.col("part_sig").alias("sig"), "size",
                                   F.lit(1).alias("times")),
                      part_texts, width, ranges[1:], most[1:], block)
    back = (parts.select("anchor", "sig", "part_anchor", "part_sig", "at")
            .join(inner.select(F.col("anchor").alias("part_anchor"), F.col("sig").alias("part_sig"), "from", "to"),
                  ["part_anchor", "part_sig"])
            .select("anchor", "sig", (F.col("at") + F.col("from")).alias("from"),
                    (F.col("at") + F.col("to")).alias("to")))
    return found.unionByName(back)


def repeated_windows(docs: DataFrame, width: int = 400, gram: int | None = None, most: int = MOST,
                     block: int = BLOCK, raw_of: Callable[[str], bytes] = utf8) -> DataFrame:
    """(doc_id, mark, from, to): starts `from` .. `to` - 1 of windows that stand anywhere else in the collection.

    `docs` has doc_id, text (no nulls) and mark, a hash of the text; rows with equal doc_id and mark are copies.
    Windows are taken of the bytes that `raw_of` makes of a text. Runs may touch or come twice.
    """
    gram = gram or max(1, min(GRAM, width // 2))
    anchors = written(docs.select("doc_id", "text", "mark").mapInArrow(
        functools.partial(_anchor_rows, width, gram, raw_of), ANCHORS), "suffix-anchors")
    often = anchors.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    chosen = (anchors.join(often, "anchor").groupBy("doc_id", "mark")
              .agg(F.collect_set(F.struct("anchor", "first", "ahead", "size", "times")).alias("chosen")))
    rows = written(docs.join(chosen, ["doc_id", "mark"]).select("doc_id", "mark", "text", "chosen")
                   .mapInArrow(functools.partial(_string_rows, width, raw_of), STRINGS), "suffix-rows")

    def texts(wanted: DataFrame) -> DataFrame:
        return (rows.where("bytes IS NOT NULL").select("anchor", "sig", "ahead", "bytes").join(wanted, "anchor")
                .groupBy("anchor", "sig").agg(*[F.first(c).alias(c) for c in ("ahead", "bytes", "k")]))

    ranges = tuple(r for r in RANGES if r <= max(1, width - gram))
    runs = _repeated(rows.select("anchor", "sig", "size", "times"), texts, width, ranges,
                     (1, *[most] * (len(ranges) - 1)), block)
    # The windows of a string that stands several times in a row follow one another, and are all repeated.
    more = F.col("size") * (F.col("times") - 1)
    return (rows.select("anchor", "sig", "doc_id", "mark", "first", "size", "times").join(runs, ["anchor", "sig"])
            .select("doc_id", "mark", (F.col("first") + F.col("from")).alias("from"),
                    (F.col("first") + F.col("to") + more).alias("to")))


CUT = "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"


def _byte_spans(runs: Iterable[dict], width: int) -> list[tuple[int, int]]:
    return [(run["from"], run["to"] - 1 + width) for run in runs]


def _word_spans(raw: bytes, runs: list[dict], words: int) -> list[tuple[int, int]]:
    """The bytes of the passages of `words` words whose windows of codes are in the runs.

    Only windows that begin with a word count, so that chance equality of parts of codes adds nothing.
    """
    places = [found.span() for found in re.finditer(rb"[^ \t-\r]+", raw)] if runs else []
    starts = [(-(-run["from"] // CODE), (run["to"] - 1) // CODE) for run in runs]
    return [(places[first][0], places[last + words - 1][1]) for first, last in starts if first <= last]


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(start, stop) for start, stop in out]


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for span in spans for edge in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _cut(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    for batch in sliced(batches, 1):
        rows = []
        for doc_id, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
            raw, spans = utf8(text), _merged(_byte_spans(runs or (), width))
            rows.append((doc_id, len(raw), [{"start": a, "length": b - a} for a, b in spans], _kept(raw, spans)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), spans_type, pa.binary()))],
            ["doc_id", "n_bytes", "spans", "kept"])


def _runs(docs: DataFrame, width: int, **options) -> DataFrame:
    """(doc_id, mark, runs) of the documents (doc_id, text, mark) that have repeated windows."""
    return (repeated_windows(docs, width, **options).groupBy("doc_id", "mark")
            .agg(F.collect_set(F.struct("from", "to")).alias("runs")))


def cut_repeats(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for each row.

    Each byte of a text in UTF-8 that is covered by a string of `width` bytes which also starts anywhere else, in
    another row or the same one, is removed; strings are judged on the input. `spans` are the maximal removed runs,
    `kept` the bytes that remain, in order. Texts below `width` bytes stay whole. Rows that are repeated are each
    other's copies. Runs several jobs at once; intermediate tables go to the shared folder.
    """
    marked = documents_of(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    return (marked.join(_runs(marked, width, **options), ["doc_id", "mark"], "left").select("doc_id", "text", "runs")
            .mapInArrow(functools.partial(_cut, width), CUT).withColumn("doc_id", outer_id()))


def cut_rows(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text",
             words: int | None = None, **options) -> DataFrame:
    """The rows of `docs`, all columns, with the repeated strings cut out of their text as `cut_repeats` does.

    With `words`, passages of so many words that stand more than once are cut out too, however few bytes they have,
    from their first word to their last; white space between words need not be equal. Both are judged on the input.
    Words are compared by 42 bits of their hash, so that two passages that differ in one word are taken as equal with
    a chance of 2^-42. A cut may part a character; the bytes that are left of it are dropped. A null text stays null.
    """
    def shorter(text: str, runs: list[dict]) -> str:
        raw = utf8(text)
        spans = _byte_spans((run for run in runs if not run["coded"]), width)
        spans += _word_spans(raw, [run for run in runs if run["coded"]], words)
        return _kept(raw, _merged(spans)).decode("utf-8", "ignore")

    @F.pandas_udf("string")
    def shortened(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([text if found is None else shorter(text, found) for text, found in zip(texts, runs)],
                         dtype=object)

    bounded_batches(docs.sparkSession)
    own, mark, found = free_names(docs, "__id", "__mark", "__runs")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({own: F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)), mark: F.xxhash64(text)})
    marked = keyed.select(F.col(own).alias("doc_id"), text.alias("text"), F.col(mark).alias("mark"))
    windows = repeated_windows(marked, width, **options).withColumn("coded", F.lit(False))
    if words:
        windows = windows.unionByName(repeated_windows(marked, words * CODE, raw_of=word_codes, **options)
                                      .withColumn("coded", F.lit(True)))
    runs = (windows.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("coded", "from", "to")))
            .toDF(own, mark, found))
    joined = keyed.join(runs, [own, mark], "left")
    return joined.withColumn(text_col, F.when(F.col(found).isNull(), F.col(text_col)).otherwise(
        shortened(F.col(text_col), F.col(found)))).select(*[F.col(f"`{c}`") for c in docs.columns])
