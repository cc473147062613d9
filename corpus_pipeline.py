"""A corpus from raw documents to packed sequences: five stages, each on all that the one before kept.

Stages take documents with any further columns, whatever they are called; an empty table gives an empty one. The
input of a stage has to be written, as `run` does: what the stage before wrote on its way is removed when the next
begins.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm import exact_dedup, jaccard_join, packing, quality_rules, suffix_dedup
from sparkloom.llm.common import LOWEST, free_names
from sparkloom.workspace import noted_folders, remove_folders, written


_LEFT: list[str] = []  # folders of the stage before; they may go once its result has been written


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that, when it begins, removes what the one before wrote on its way: its input is a written table."""
    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_folders(spark, _LEFT)
        _LEFT.clear()
        with noted_folders() as made:
            out = work(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out

    return run


def _one_each(docs: DataFrame, chosen: DataFrame, keys: dict[str, Column], rows: str) -> DataFrame:
    """One row of `docs` for each row of `chosen`, which has the keys and in `rows` how many rows have them at least."""
    place = free_names(docs, "__place")[0]
    joined = docs.withColumns(keys).join(chosen, list(keys))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`") for c in docs.columns]))
    several = joined.where(F.col(rows) > 1).withColumn(place, first).where(F.col(place) == 1)
    names = [F.col(f"`{c}`") for c in docs.columns]
    return joined.where(F.col(rows) == 1).select(*names).unionByName(several.select(*names))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts or the line labels reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_rows(docs, quality_rules.train(docs, labels))


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row with the smallest identifier stays."""
    own, sha, rows = free_names(docs, "__id", "__sha", "__rows")
    found = exact_dedup.find_copies(docs, keep="smallest")
    chosen = (found.select(F.coalesce("doc_id", F.lit(LOWEST)).alias(own), F.col("text_sha256").alias(sha), "kept")
              .groupBy(own, sha).agg(F.max("kept").alias("kept"), F.count("*").alias(rows)).where("kept").drop("kept"))
    return _one_each(docs, chosen, {own: F.coalesce("doc_id", F.lit(LOWEST)),
                                    sha: F.sha2(F.coalesce("text", F.lit("")), 256)}, rows)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 of their five-word shingles, the smallest identifier stays.

    Texts are the nodes, by a 64-bit hash, so that rows with no identifier or a shared one are linked by their texts
    only. Should different texts have one hash, which their digests tell, all of them stay. Of rows with equal texts,
    which the stage before leaves no more, the smallest identifier that is not null.
    """
    key, own, sha, rows = free_names(docs, "__key", "__id", "__sha", "__rows")
    keyed = docs.select(F.xxhash64("text").alias(key), "text", "doc_id")
    found = jaccard_join.link_groups(keyed, width=5, percent=80, id_col=key)
    texts = found.select(F.coalesce("doc_id", F.lit(LOWEST)).alias(key),
                         F.coalesce("component_id", F.lit(LOWEST)).alias("group")).distinct()
    by_text = written(keyed.groupBy(key, F.sha2("text", 256).alias(sha)).agg(
        F.coalesce(F.min("doc_id"), F.lit(LOWEST)).alias(own), F.count("*").alias(rows)), "texts")
    shared = by_text.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    first = (by_text.join(texts, key).groupBy("group").agg(F.min(F.struct(own, key, rows, sha)).alias("first"))
             .select("first.*").join(shared, key, "left_anti"))
    chosen = first.unionByName(by_text.join(shared, key, "left_semi").select(*first.columns))
    return _one_each(docs, chosen.withColumn(sha, F.coalesce(sha, F.lit(""))), {
        own: F.coalesce("doc_id", F.lit(LOWEST)), key: F.xxhash64("text"), sha: F.coalesce(F.sha2("text", 256), F.lit(""))},
        rows)


@_stage
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, or of 400 bytes, that stand more than once are cut out; `n_chars` counts what is left."""
    cut = suffix_dedup.cut_rows(docs, 400, words=51)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' token pieces in sequences of 2,048 tokens."""
    pieces = packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, 0)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 2048)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("suffix-array dedup", repeats), ("best-fit packing", packed)]

# The line labels of the first stage come from a fitted model, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; what each keeps is written to the shared folder and read back."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        with noted_folders() as made:
            docs = written(out, name.replace(" ", "-"))
        remove_folders(spark, before)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
