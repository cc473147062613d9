"""Prefix trie of conversations, by the van Emde Boas recursion.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns. The recursion cuts
sequences at half their depth, names the cut prefixes, treats the upper halves as one trie and the lower halves as a
forest whose trees are rooted at the names, and so on in both until pieces are one turn deep. All pieces of a level
are worked on in the same job, so there are as many rounds as the depth has binary digits:

1. Upwards: digests of stretches of 1, 2, 4, ... turns, each made from the two halves. A round has half the rows of
   the one before.
2. Downwards, the cuts: the prefix before the middle of a stretch is named by a digest of the name of its start and
   the digest of the upper half. At the end every prefix has its name, of 128 bits.
3. Nodes are rows grouped by name. Their totals are first those of pieces one turn deep, the nodes' own.
4. Upwards again, the graft: the totals of the trees below a cut are added to the cut node and its ancestors within
   the upper piece, which are found as the turns of one member of the cut node. Then pieces are twice as deep.

Turns are rows all the way, so a conversation with a third of all turns is spread like any other. Everything is made
of DataFrame functions, but for the one digest over the members that end at a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import LOWEST, bounded_batches, outer_id
from sparkloom.workspace import written

ROOT = "root"
CHUNK_BITS = 12  # a stretch of 2^12 numbers: a list of distinct ones within it is bounded


def named(*parts: Column) -> Column:
    """A name of 128 bits for a pair of names."""
    return F.substring(F.sha2(F.concat_ws("/", *parts), 256), 1, 32)


def numbered(turns: DataFrame) -> DataFrame:
    """`turns` (conv, turn, digest, bytes) with `at`, their number within the conversation from 0.

    Order: turn, missing ones first, then digest. Rows are sorted by ranges over all conversations and counted within
    each range, so no conversation has to fit a task. Writes the sorted rows.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "digest"]
    ranged = written(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("range", F.spark_partition_id()), "turns")
    # A conversation's rows in one range of a large conversation are dealt into stretches of the range's own order.
    within = Window.partitionBy("conv", "range").orderBy(F.col("turn").asc_nulls_first(), "digest")
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    offsets = counts.select("conv", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (ranged.withColumn("here", F.row_number().over(within)).join(offsets, ["conv", "range"])
            .select("conv", (F.col("offset") + F.col("here") - 1).alias("at"), "digest", "bytes"))


def rebuilt(rows: DataFrame, step: int = 5, folds: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, length) and turns (conv, at, digest, bytes, last) after borrowing first turns.

    Conversation c takes the first h turns of conversation c - c % step (all if fewer, none if absent) and then its
    own turns after its first h; h = crc32(decimal c) % folds. `%` is SQL's remainder, which has the sign of c.
    Conversation `LOWEST` (no identifier) keeps its own turns.
    """
    heads = F.when(F.col("conv") == LOWEST, 0).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % folds)
    own = rows.groupBy("conv").agg(F.count("*").alias("n_own")).withColumn("h", heads).withColumn(
        "base", F.when(F.col("conv") == LOWEST, F.col("conv")).otherwise(F.col("conv") - F.col("conv") % step))
    sizes = own.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    convs = written(own.join(sizes, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"), "n_own")
        .withColumn("length", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))), "conversations")
    borrowed = (rows.where(F.col("at") < folds).withColumnRenamed("conv", "base")
                .join(convs.select("conv", "base", "taken", "length"), "base").where("at < taken")
                .select("conv", "at", "digest", "bytes", "length"))
    rest = (rows.join(convs.select("conv", "h", "taken", "length"), "conv").where("at >= h")
            .select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "bytes", "length"))
    turns = borrowed.unionByName(rest).select("conv", "at", "digest", "bytes",
                                              (F.col("at") == F.col("length") - 1).alias("last"))
    return convs.select("conv", "length"), written(turns, "rebuilt-turns")


def names(turns: DataFrame, levels: int) -> DataFrame:
    """(conv, depth, name) of every prefix, the empty one included, by cutting stretches at half their length."""
    digests = [turns.select("conv", F.col("at").alias("j"), "digest")]
    for level in range(1, levels):  # the digest of 2^level turns from its two halves, where both are there
        half = digests[-1]
        upper = half.where("j % 2 = 0").select("conv", F.expr("j div 2").alias("j"), F.col("digest").alias("upper"))
        lower = half.where("j % 2 = 1").select("conv", F.expr("j div 2").alias("j"), F.col("digest").alias("lower"))
        digests.append(written(upper.join(lower, ["conv", "j"])
                               .select("conv", "j", named(F.col("upper"), F.col("lower")).alias("digest")),
                               "stretches"))
    cuts = turns.where("at = 0").select("conv", F.lit(0).cast("long").alias("j"), F.lit(ROOT).alias("name"))
    for level in reversed(range(levels)):
        # The upper half of stretch j of 2^(level + 1) turns is number 2j of the halves; it ends at cut 2j + 1.
        upper = (digests[level].where("j % 2 = 0")
                 .select("conv", F.expr("j div 2").alias("j"), F.col("digest").alias("upper")))
        made = cuts.join(upper, ["conv", "j"]).select("conv", (2 * F.col("j") + 1).alias("j"),
                                                      named(F.col("name"), F.col("upper")).alias("name"))
        cuts = written(cuts.withColumn("j", 2 * F.col("j")).unionByName(made), "cuts")
    return cuts.withColumnRenamed("j", "depth")


def _ends(members: DataFrame) -> DataFrame:
    """(name, ends_sha256) from the members (name, conv) that end at a node.

    Identifiers are distinct, so a stretch of 2^`CHUNK_BITS` numbers has a bounded list; the lists of a node go through one
    digest in order, one at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == last:
                    running.update(b"," + text.encode())
                    continue
                if last is not None:
                    done.append((last, running.hexdigest()))
                last, running = name, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in range(2)],
                                             names=["name", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([running.hexdigest()])],
                                             names=["name", "ends_sha256"])

    decimal = F.transform(F.sort_array(F.collect_list("conv")),
                          lambda c: F.when(c == LOWEST, F.lit("null")).otherwise(c.cast("string")))
    lists = (members.groupBy("name", F.shiftright("conv", CHUNK_BITS).alias("chunk"))
             .agg(F.array_join(decimal, ",").alias("text")))
    return (lists.repartition("name").sortWithinPartitions("name", "chunk").select("name", "text")
            .mapInArrow(digest, "name string, ends_sha256 string"))


def graft(nodes: DataFrame, turns: DataFrame, levels: int) -> DataFrame:
    """`nodes` (name, at, conv, parent_conv, leaves, saved) with `leaves` and `saved` added up over subtrees.

    `turns` has (conv, at, name) of each conversation's nodes. After round k the totals are those of pieces of
    2^(k + 1) turns. The root, which is no row here, has the totals of the nodes at 0.
    """
    for level in range(levels):
        span = 1 << level
        cut = F.col("at") % (2 * span) == span  # tops of the trees below a cut; the cut node is their parent
        below = (nodes.where(cut).groupBy(F.col("parent_conv").alias("conv"), F.expr(f"at div {span} - 1").alias("piece"))
                 .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        upper = turns.where(F.expr(f"at div {span} % 2 = 0")).select("conv", F.expr(f"at div {span}").alias("piece"),
                                                                     "name")
        more = (below.join(upper, ["conv", "piece"]).groupBy("name")
                .agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved")))
        nodes = written(nodes.join(more, "name", "left").select(
            "name", "at", "conv", "parent_conv", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "grafted")
    return nodes


def trie(conversations: DataFrame, step: int = 5, folds: int = 9, id_col: str = "conv_id", turn_col: str = "turn",
         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations, and one for the root.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the smallest member
    and the parent's; members, children, childless nodes of the subtree; the bytes saved in the subtree when each
    node's last text is held once and not for each member; the digest of the decimal identifiers of the members that
    end here, in ascending order.

    Turns are equal when role and text are; null ones are empty. Order within a conversation: turn, missing ones
    first, then a digest of role and text. Repeated rows are turns of their own. Rows without an identifier are one
    conversation, below all others, which borrows nothing and is written `null`. An empty table has no node at all.

    Runs about 4 jobs for each binary digit of the greatest depth; each writes narrow rows to the shared folder.
    """
    bounded_batches(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    raw = conversations.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("conv"), F.col(turn_col).alias("turn"),
        named(F.octet_length(role).cast("string"), role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    convs, turns = rebuilt(numbered(raw), step, folds)
    first, total, deepest = convs.agg(F.min("conv"), F.count("*"), F.coalesce(F.max("length"), F.lit(0))).first()
    levels = deepest.bit_length()
    prefixes = names(turns, levels)
    parents = prefixes.select("conv", F.col("depth").alias("at"), F.col("name").alias("parent"))
    paths = written(turns.join(prefixes.select("conv", (F.col("depth") - 1).alias("at"), "name"), ["conv", "at"])
                    .join(parents, ["conv", "at"]).select("conv", "at", "name", "parent", "bytes", "last"), "paths")
    grouped = written(paths.groupBy("name", "at", "parent", "bytes")
                      .agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")), "nodes")
    above = grouped.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv")).unionByName(
        conversations.sparkSession.range(1).select(F.lit(ROOT).alias("parent"),
                                                   F.lit(first).cast("long").alias("parent_conv")))
    children = grouped.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = written(grouped.join(above, "parent").join(children, "name", "left").select(
        "name", "at", "conv", "n_convs", "parent_conv", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "trie-nodes")
    totals = graft(nodes.select("name", "at", "conv", "parent_conv", "leaves", "saved"),
                   paths.select("conv", "at", "name"), levels)
    summed = nodes.drop("leaves", "saved").join(totals.select("name", "leaves", "saved"), "name")
    top = (totals.where("at = 0").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"),
                                      F.sum("saved").alias("saved")).where(F.lit(total) > 0)
           .select(F.lit(ROOT).alias("name"), F.lit(-1).cast("long").alias("at"),
                   F.lit(first).cast("long").alias("conv"), F.lit(total).alias("n_convs"),
                   F.lit(None).cast("long").alias("parent_conv"), "n_children",
                   F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved")))
    ending = paths.where("last").select("name", "conv").unionByName(
        convs.where("length = 0").select(F.lit(ROOT).alias("name"), "conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (summed.unionByName(top).join(_ends(ending), "name", "left")
            .select(outer_id("conv").alias("conv_id"), (F.col("at") + 1).alias("depth"),
                    outer_id("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))
