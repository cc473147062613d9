"""Every operator of this subpackage applied to its whole table, with its result in the agreed columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe_codec, exact_dedup, jaccard_join, packing, quality_rules, sharding, token_counts
from sparkloom.llm import prefix_trie, quality_votes, suffix_dedup, token_store, url_filter, vector_codes


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe_codec.decode(bpe_codec.encode(_table(spark, folder, "documents"), path), path)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256)
                        .alias("decoded_sha256"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """`text` is what remains; bytes that are left of a character that a cut parts read U+FFFD there."""
    cut = suffix_dedup.cut_repeats(_table(spark, folder, "documents"), 400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, _table(spark, folder, "labels")))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.find_copies(_table(spark, folder, "documents"), keep="largest")


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.cut(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048, 0)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 2048)


def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    stored = token_store.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link_groups(_table(spark, folder, "documents"), width=4, percent=85)


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, folder, "pages"), rules, default="allow")


def op10_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Law `rows`: the bounded loads of the ring are tight, so counts differ by one at most."""
    placed = sharding.assign(_table(spark, folder, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality_votes.judge(docs, quality_votes.train(docs, _table(spark, folder, "labels")), 0.7)


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = vector_codes.encode(_table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, folder, "conversations"), step=5, folds=9)


QUERIES = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_store": op7_token_store,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_url_filter": op9_url_filter,
    "op10_ring_shards": op10_ring_shards,
    "op11_quality_votes": op11_quality_votes,
    "op12_vector_codes": op12_vector_codes,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "op9_url_filter": """
        WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
             ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END
                 AS r FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
        split AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') AS host,
                         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        fits AS (SELECT s.page_id, max({'n': length(r.host || r.path), 'rule': r.host || r.path,
                        'verdict': r.verdict}) AS best
                 FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host))
                      AND starts_with(s.path, r.path) GROUP BY s.page_id)
        SELECT s.page_id, s.host, s.path, f.best.rule AS rule, coalesce(f.best.verdict, 'allow') AS verdict
        FROM split s LEFT JOIN fits f USING (page_id)""",
}
