"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `virtual` nodes on a ring of cells. A key's cell is a hash of its text, so copies stand together; the
key belongs to the first virtual node clockwise. A shard takes rows, arc after arc, until it has its bound, the rows
of all over the number of shards, rounded up or down so that the bounds add up; rows that find their shard full
continue clockwise to the next virtual node of a shard with room. Counts therefore differ by one at most, and a row
moves only where a bound cuts its arc.

How far each arc fills which shard depends on the number of rows in each arc alone. That table, of one row for each
virtual node, is worked off on the driver; rows are only numbered, within their cell and a salt, and looked up.
Everything that touches rows is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents_of, outer_id
from sparkloom.workspace import written

CELLS = 8192


def ring(spark: SparkSession, shards: int, virtual: int, cells: int = CELLS) -> DataFrame:
    """(cell, arc, shard): for each cell of the ring the first virtual node clockwise, at the cell or after it.

    `arc` is the cell of that virtual node. Where several virtual nodes fall on a cell, the first shard has it.
    """
    nodes = (spark.range(shards * virtual)
             .select(F.pmod("id", F.lit(shards)).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("copy"))
             .groupBy(F.pmod(F.xxhash64("shard", "copy"), F.lit(cells)).alias("cell"))
             .agg(F.min("shard").alias("shard")).withColumn("arc", F.col("cell")))
    lap = F.when(F.col("arc").isNotNull(), F.struct("arc", "shard"))
    onwards = Window.orderBy("cell").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    anywhere = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (spark.range(cells).withColumnRenamed("id", "cell").join(nodes, "cell", "left")
            .select("cell", F.coalesce(F.first(lap, ignorenulls=True).over(onwards),
                                       F.first(lap, ignorenulls=True).over(anywhere)).alias("node"))
            .select("cell", "node.arc", "node.shard"))


def fill(arcs: list[tuple[int, int, int]], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Work off (arc, shard, rows) in ring order: (arc, first row, rows, shard, first slot) of each stretch.

    Laps go round the ring: in each, every arc's rest is at the next virtual node, whose shard takes what its bound
    allows. A rest goes past full shards.
    """
    room = list(bounds)
    taken = [0] * len(bounds)
    rests = [[arc, 0, rows, k] for k, (arc, _, rows) in enumerate(arcs) if rows]  # arc, first row, rows, where
    out = []
    while rests:
        waiting = []
        for rest in rests:
            arc, first, rows, at = rest
            shard = arcs[at][1]
            count = min(rows, room[shard])
            if count:
                out.append((arc, first, count, shard, taken[shard]))
                room[shard] -= count
                taken[shard] += count
            if count < rows:
                at = (at + 1) % len(arcs)
                while not room[arcs[at][1]] and any(room):
                    at = (at + 1) % len(arcs)
                waiting.append([arc, first + count, rows - count, at])
        rests = waiting
    return out


def assign(docs: DataFrame, shards: int = 24, virtual: int = 32, id_col: str = "doc_id", text_col: str = "text",
           cells: int = CELLS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row.

    `size` is the text's UTF-8 bytes and 8; the number of rows of any two shards differs by one at most; `slot`
    numbers the rows of a shard from 0. Equal texts begin at one place of the ring, so they share a shard unless it
    is full by then. Repeated rows are placed one by one. Every shard needs a cell of its own among the virtual
    nodes, else ValueError. Runs three small jobs and one that writes a row of numbers for each document.
    """
    spark = docs.sparkSession
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lookup = ring(spark, shards, virtual, cells)
    keyed = written(
        documents_of(docs, id_col, text_col)
        .select("doc_id", (F.octet_length("text") + 8).cast("long").alias("size"),
                F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("place"))
        .select("*", F.pmod("place", F.lit(cells)).alias("cell"),
                F.pmod(F.xxhash64("doc_id", "place"), F.lit(salts)).alias("salt")), "shard-keys")
    parts = keyed.groupBy("cell", "salt").agg(F.count("*").alias("n"))
    parts = written(parts.join(F.broadcast(lookup), "cell"), "shard-parts")  # the ring has `cells` rows
    counts = {row["arc"]: row["n"] for row in parts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    nodes = lookup.select("arc", "shard").distinct().orderBy("arc").collect()  # shards x virtual rows at most
    if {row["shard"] for row in nodes} != set(range(shards)):
        raise ValueError("too few cells or virtual nodes: a shard has no place on the ring")
    total = sum(counts.values())
    bounds = [total // shards + (shard < total % shards) for shard in range(shards)]
    stretches = fill([(row["arc"], row["shard"], counts.get(row["arc"], 0)) for row in nodes], bounds)
    taken = spark.createDataFrame(stretches, "arc long, first long, n_taken long, shard int, first_slot long")
    cells_before = Window.partitionBy("arc").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    salts_before = Window.partitionBy("cell").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # The arc of a virtual node begins after the node before it; cells above the last node come first in its arc.
    turns = (parts.groupBy("arc", "cell").agg(F.sum("n").alias("n"))
             .withColumn("turn", F.pmod(F.col("cell") - F.col("arc") - 1, F.lit(cells)))
             .select("cell", F.coalesce(F.sum("n").over(cells_before), F.lit(0)).alias("cell_first")))
    offsets = (parts.withColumn("salt_first", F.coalesce(F.sum("n").over(salts_before), F.lit(0)))
               .join(F.broadcast(turns), "cell")
               .select("cell", "salt", "arc", (F.col("cell_first") + F.col("salt_first")).alias("before")))
    within = Window.partitionBy("cell", "salt").orderBy("place", "doc_id", "size")
    numbered = (keyed.withColumn("row", F.row_number().over(within)).join(offsets, ["cell", "salt"])
                .withColumn("number", F.col("before") + F.col("row") - 1))
    return (numbered.join(F.broadcast(taken), "arc")  # stretches: virtual nodes and full shards bound their number
            .where((F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("n_taken")))
            .select(outer_id(), "size", "text_crc32", "shard",
                    (F.col("first_slot") + F.col("number") - F.col("first")).alias("slot")))
