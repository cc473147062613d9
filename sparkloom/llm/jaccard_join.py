"""Jaccard self-join of word n-gram sets: fixed-size subsets for small sets, inverted lists for large ones.

Equal sets are one class; classes are joined and rows only looked up. Two sets of n and m members are linked when
they share at least c(n, m) members, the smallest whole number that makes the Jaccard similarity high enough.

* Light side. Two small sets are linked exactly if they have a subset of c(n, m) members in common. Each small set
  puts out all such subsets, for each size a partner may have; sets that meet at a subset are linked by a star.
* Heavy side. A large set is looked up in inverted lists of its rarest members: linked sets of n and m members meet
  within the first n - ceil(s n) + 1 members of either, in any common order. Members are ordered by how many
  documents have them, read from a table of fixed size, so that lists of frequent members are left alone.
* The boundary is the size at which putting out subsets gets dearer than list entries, by a count of set sizes.

Long lists are cut into salted parts and worked off in stars, so that a large group of near copies costs entries and
not pairs. Only then are pairs of one list enumerated, those that are still in different components and that the
place in the lists and a parity bitmap of the sets do not rule out: both bounds are exact, so no link is lost.
Every candidate is checked on the whole sets.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import BoundedMemory, documents_of, kept, outer_id, sliced
from sparkloom.llm.components import components
from sparkloom.workspace import written

SLOT_BITS = 24  # the table of frequencies has 2^24 bytes, whatever the input
LONG_LIST = 10  # lists of members with 2^10 documents and more are salted
WIDEST = 64  # sizes that are considered for the boundary
BITMAP = 4  # longs


# ---------------------------------------------------------------- sets of a text

MEMORY = 56 << 20  # bytes of words that a process remembers


def _word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads them."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text; words are lower-cased (A-Z) runs without white space.

    A text with fewer words than `width` has the whole sequence as its only member, one without words has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = kept("shingles", "words", lambda: BoundedMemory(_word_hash, MEMORY))
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    grams = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        grams = mixed(grams * _MIX[0] + codes[k:len(codes) - span + 1 + k])
    return np.unique(grams)


# ---------------------------------------------------------------- exact sizes

class Similarity:
    """Whole-number arithmetic of a Jaccard bound of `percent` hundredths."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("the bound must be above 50 and at most 100 percent")
        self.percent = percent

    def shared(self, n: int, m: int) -> int:
        """Members that sets of n and m must share."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def largest(self, n: int) -> int:
        """Members of the largest set that one of n can be linked to."""
        return 100 * n // self.percent

    def prefix(self, n):
        """Rarest members of which linked sets have one in common."""
        return n - -(-self.percent * n // 100) + 1

    def subsets(self, n: int, upto: int) -> int:
        """Subsets that a set of n puts out for partners of at most `upto` members."""
        low = -(-self.percent * n // 100)
        return sum(math.comb(n, self.shared(n, m)) for m in range(low, min(self.largest(n), upto) + 1)
                   if self.shared(n, m) <= min(n, m))

    def boundary(self, sizes: dict[int, int]) -> int:
        """The size up to which subsets cost less than list entries, by the number of sets of each size.

        Sets just below the boundary still need list entries, for partners above it.
        """
        def cost(upto: int) -> int:
            light = sum(count * self.subsets(n, upto) for n, count in sizes.items() if n <= upto)
            return light + sum(2 * count * self.prefix(n) for n, count in sizes.items() if self.largest(n) > upto)

        return min(range(WIDEST + 1), key=lambda upto: (cost(upto), upto)) if sizes else 0


# ---------------------------------------------------------------- frequencies of members

def _bucket_rows(width: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the task's documents by bucket: sorted keys and in how many documents each is."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        grams, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        ends = np.searchsorted(grams >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        keys = (grams >> np.uint64(32 - bits)).astype("<u4")
        rows = [(b, keys[s:e].tobytes(), counts[s:e].astype("<u4").tobytes())
                for b, (s, e) in enumerate(itertools.pairwise(ends.tolist())) if s < e]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in
                                           zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                                          ["bucket", "keys", "counts"])

    for batch in sliced(batches, 1):
        held += [found for text in batch.column(1).to_pylist() if len(found := shingle_set(text, width))]
        if sum(map(len, held)) > 2_000_000:
            yield flush()
    if held:
        yield flush()


def _bucket_tables(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket its slots of the table: the largest binary logarithm of a frequency."""
    slots = 1 << (SLOT_BITS - bits)

    def table(bucket: int, keys: list[bytes], counts: list[bytes]) -> tuple[int, bytes]:
        found, where = np.unique(np.frombuffer(b"".join(keys), "<u4"), return_inverse=True)
        total = np.bincount(where, weights=np.frombuffer(b"".join(counts), "<u4"))
        out = np.zeros(slots, np.uint8)
        if slots > 1:
            at = found >> np.uint32(32 - (SLOT_BITS - bits))
        else:
            at = np.zeros(len(found), np.uint32)
        np.maximum.at(out, at, np.log2(total).astype(np.uint8))
        return bucket, out.tobytes()

    here, keys, counts, rows = None, [], [], []
    for batch in batches:
        for bucket, key, count in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != here and keys:
                rows.append(table(here, keys, counts))
                keys, counts = [], []
            here = bucket
            keys.append(key)
            counts.append(count)
    if keys:
        rows.append(table(here, keys, counts))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                          pa.array([r[1] for r in rows], pa.binary())], ["bucket", "slots"])


def frequency_table(docs: DataFrame, width: int) -> np.ndarray:
    """2^SLOT_BITS bytes: for members with these leading hash bits, the largest floor(log2(documents)).

    Counted over all documents; each task adds up its own first. A member's value is never below its own.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(SLOT_BITS, max(6, (16 * tasks).bit_length()))
    rows = (docs.mapInArrow(functools.partial(_bucket_rows, width, bits), "bucket int, keys binary, counts binary")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(functools.partial(_bucket_tables, bits), "bucket int, slots binary"))
    out = np.zeros((1 << bits, 1 << (SLOT_BITS - bits)), np.uint8)
    for row in rows.collect():  # 2^SLOT_BITS bytes in all
        out[row["bucket"]] = np.frombuffer(row["slots"], np.uint8)
    return out.ravel()


# ---------------------------------------------------------------- classes of equal sets

CLASS = ("doc_id long, n long, sig binary, members array<long>, weights array<int>, "
         "b0 long, b1 long, b2 long, b3 long")


def _classes(width: int, similarity: Similarity, table, batches: Iterator[pa.RecordBatch]
             ) -> Iterator[pa.RecordBatch]:
    """Size, signature, rarest members in order, and parity bitmap of each set. Sets of at most WIDEST members come
    whole, for their subsets."""
    for batch in sliced(batches, 1):
        columns: list[list] = [[] for _ in range(9)]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grams = shingle_set(text, width)
            n = len(grams)
            weight = table.value[grams >> np.uint64(64 - SLOT_BITS)]
            first = np.argsort(weight, kind="stable")[:n if n <= WIDEST else similarity.prefix(n)]
            parity = np.bincount(grams & np.uint64(64 * BITMAP - 1), minlength=64 * BITMAP) & 1
            bitmap = np.packbits(parity.astype(np.uint8)).view("<i8")
            sig = hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if n else None
            for column, value in zip(columns, (doc_id, n, sig, grams[first].astype(np.int64),
                                               weight[first].astype(np.int32), *bitmap.tolist())):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.int64()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         [part.split(" ")[0] for part in CLASS.split(", ")])


def _subset_rows(similarity: Similarity, upto: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, low, high, side, subset) for all subsets of a small set that a partner of size low or high may share."""
    names = ["rep", "low", "high", "side", "subset"]
    for batch in batches:
        rows = []
        for rep, n, members in zip(*(c.to_pylist() for c in batch.columns)):
            members = sorted(members)
            for m in range(-(-similarity.percent * n // 100), min(similarity.largest(n), upto) + 1):
                low, high, size = min(n, m), max(n, m), similarity.shared(n, m)
                if size <= low:
                    for subset in itertools.combinations(members, size):
                        packed = np.array(subset, np.int64).tobytes()
                        rows.append((rep, low, high, n == low, hashlib.blake2b(packed, digest_size=16).digest()))
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def light_links(reps: DataFrame, similarity: Similarity, upto: int) -> DataFrame:
    """(a, b): links between sets of at most `upto` members, as stars around the smallest set at each subset.

    Sets of one size that share a subset are all linked to one another; those of two sizes each to all of the other
    size. So a star on either side keeps every component.
    """
    rows = reps.where((F.col("n") > 0) & (F.col("n") <= upto)).select("rep", "n", "members").mapInArrow(
        functools.partial(_subset_rows, similarity, upto),
        "rep long, low long, high long, side boolean, subset binary")
    key = ["low", "high", "subset"]
    centres = rows.groupBy(key).agg(F.min(F.when(F.col("side"), F.col("rep"))).alias("small"),
                                    F.min(F.when(~F.col("side") | (F.col("low") == F.col("high")), F.col("rep")))
                                    .alias("great"), F.count("*").alias("count")).where("count > 1")
    met = rows.join(centres.where("small IS NOT NULL AND great IS NOT NULL"), key)
    return met.select("rep", F.when(F.col("side"), F.col("great")).otherwise(F.col("small")).alias("other")).where(
        "rep <> other").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


# ---------------------------------------------------------------- inverted lists of large sets

def _could_link(similarity: Similarity, left: str, right: str) -> Column:
    """Whether sizes, places in the order and parity bitmaps leave room for a link (exact bounds)."""
    percent = similarity.percent
    n, m, i, j = (F.col(f"{side}.{name}") for name in ("n", "i") for side in (left, right))
    # |A xor B| = n + m - 2 shared is at least the number of bits that differ.
    apart = functools.reduce(Column.__add__, [F.bit_count(F.col(f"{left}.b{k}").bitwiseXOR(F.col(f"{right}.b{k}")))
                                              for k in range(BITMAP)])
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & ((100 + percent) * F.least(n - i, m - j) >= percent * (n + m))
            & ((100 + percent) * (n + m - apart) >= 2 * percent * (n + m)))


def _checked(pairs: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (a, b) that are linked, checked on the whole sets."""
    percent = similarity.percent
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("grams").alias("ga")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("grams").alias("gb")), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, "<u8"), np.frombuffer(right, "<u8")
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], ["a", "b"])

    return both.select("a", "b", "ga", "gb").mapInArrow(check, "a long, b long").distinct()


def _set_rows(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 1):
        grams = [shingle_set(text, width).astype("<u8").tobytes() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], ["rep", "grams"])


def _mask(ids: DataFrame, bits: int = 23) -> DataFrame:
    """One row with 2^bits bits that mark hashes of the identifiers, as longs: a filter of fixed size."""
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << bits))
    return (ids.select(place.alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("word")))


def heavy_links(docs: DataFrame, reps: DataFrame, width: int, similarity: Similarity, upto: int) -> DataFrame:
    """(a, b): links in which one set at least has more than `upto` members; enough of them for all components."""
    spark = docs.sparkSession
    percent = similarity.percent
    entries = (reps.where(F.floor(100 * F.col("n") / percent) > upto)
               .select("rep", "n", F.posexplode(F.arrays_zip("members", "weights")).alias("i", "m"))
               .where(F.col("i") < F.col("n") - F.ceil(percent * F.col("n") / 100) + 1)
               .select("rep", "n", "i", F.col("m.members").alias("member"),
                       F.when(F.col("m.weights") >= LONG_LIST, F.pmod(F.xxhash64("rep"), F.expr(
                           f"shiftleft(1L, m.weights - {LONG_LIST})"))).otherwise(F.lit(-1)).alias("part")))
    # A part holds about 2^LONG_LIST + 1 sets at most: its weight bounds the documents of a member.
    part = Window.partitionBy("member", "part")
    bits = [f"b{k}" for k in range(BITMAP)]
    listed = written(entries.withColumn("size", F.count("*").over(part)).where("size > 1 OR part >= 0")
                     .drop("size").join(reps.select("rep", *bits), "rep"), "lists")
    wanted = listed.select("rep").distinct()
    mask = np.zeros(1 << 17, np.int64)
    for row in _mask(wanted).collect():  # 2^17 rows at most
        mask[row["w"]] = row["word"]
    shared_mask = spark.sparkContext.broadcast(mask)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            hit = (shared_mask.value[place >> 6] >> (place & 63)) & 1
            kept = batch.filter(pa.array(hit.astype(bool)))
            yield from _set_rows(width, iter([kept.select([0, 1])]))

    placed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 23)).alias("place"))
    sets = written(placed.mapInArrow(marked, "rep long, grams binary").join(wanted, "rep", "left_semi"), "sets")
    # Stars: each set of a part with the one of about its size that has the member earliest, and so the fewest rarer
    # members: of near copies, the one least changed. Parts are linked in the same way.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) if percent < 100 else F.col("n"))
    entry = F.struct("i", "n", "rep", *bits)
    banded = listed.withColumn("band", band)
    inner = banded.withColumn("x", F.min(entry).over(Window.partitionBy("member", "part", "band")))
    stars = inner.select(F.struct("n", "i", *bits).alias("l"), F.col("x").alias("r"), "rep", "x.rep")
    heads = banded.where("part >= 0").groupBy("member", "part", "band").agg(F.min(entry).alias("h"))
    over = (heads.withColumn("x", F.min("h").over(Window.partitionBy("member", "band")))
            .select(F.struct("h.n", "h.i", *[f"h.{b}" for b in bits]).alias("l"), F.col("x").alias("r"), "h.rep", "x.rep"))
    first = (stars.toDF("l", "r", "p", "q").union(over.toDF("l", "r", "p", "q")).where(F.col("p") != F.col("q"))
             .where(_could_link(similarity, "l", "r"))
             .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
    first = written(first, "star-pairs")
    linked = written(_checked(first, sets, similarity), "star-links")

    # What is left: pairs of one list in different components. One side of each is outside the list's largest one.
    groups = components(linked, "a", "b")
    labelled = (listed.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                .select("member", "rep", "n", "i", *bits, F.coalesce("component", "rep").alias("component")))
    inside = labelled.groupBy("member", "component").agg(F.count("*").alias("c"))
    largest = (inside.groupBy("member").agg(F.max(F.struct("c", "component")).alias("top"), F.count("*").alias("k"))
               .where("k > 1").select("member", F.col("top.component").alias("top")))
    open_lists = labelled.join(largest, "member")
    left = open_lists.where(F.col("component") != F.col("top")).alias("l")
    right = open_lists.alias("r")
    # Both outside the largest component: once, by the smaller component.
    once = (F.col("r.component") == F.col("r.top")) | (F.col("l.component") < F.col("r.component"))
    rest = (left.join(right, (F.col("l.member") == F.col("r.member")) & once & _could_link(similarity, "l", "r"))
            .select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")).distinct()
            .join(first, ["a", "b"], "left_anti"))
    rest = written(rest, "rest-pairs")
    return linked.unionByName(_checked(rest, sets, similarity))


def link_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: rows linked by chains of similar sets share a component.

    A row's set are the distinct `width`-word shingles of its text, words being runs of characters other than space
    and \\x09-\\x0D, lower-cased A-Z. Two rows are linked when 100 x shared >= percent x union. A text with fewer
    words is one shingle, one without words or a null text has none and is linked with nothing. `component_id` is
    the smallest identifier of the component (a null identifier is the smallest). Rows that share an identifier are
    one node. Members are 64-bit hashes. Runs several jobs at once; intermediate tables go to the shared folder.
    """
    similarity = Similarity(percent)
    spark = docs.sparkSession
    docs = documents_of(docs, id_col, text_col)
    table = spark.sparkContext.broadcast(frequency_table(docs, width))  # 2^SLOT_BITS bytes
    classes = written(docs.mapInArrow(functools.partial(_classes, width, similarity, table), CLASS), "sets-of-rows")
    owners = classes.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    reps = classes.join(owners, ["sig", "doc_id"]).withColumnRenamed("doc_id", "rep")
    sizes = {row["n"]: row["count"] for row in reps.where(F.col("n") <= 2 * WIDEST).groupBy("n").count().collect()}
    upto = similarity.boundary(sizes)  # from at most 2 x WIDEST counts
    links = written(light_links(reps, similarity, upto).unionByName(
        heavy_links(docs, reps, width, similarity, upto)), "links")
    groups = components(links, "a", "b")
    named = owners.withColumnRenamed("doc_id", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "sig", F.coalesce("component", "rep").alias("component"))
    found = classes.select("doc_id", "n", "sig").join(named, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return found.select(outer_id(), "n_shingles", outer_id("component_id"))
