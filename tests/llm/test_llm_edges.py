"""Map columns, letters beyond A-Z, very long texts, and columns that are called like ours."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import packing, suffix_dedup, url_filter
from sparkloom.llm.common import free_names
from tests.llm.llm_data import collected


def test_pieces_with_a_map(spark):
    frame = spark.range(40).select((F.col("id") % 5 + 1).alias("length"), F.create_map(F.lit("k"), "id").alias("m"))
    got = collected(packing.pack(frame, 5))
    assert sorted(r["m"]["k"] for r in got) == list(range(40))
    only = collected(packing.pack(spark.range(6).select(F.create_map(F.lit("k"), F.lit(1)).alias("m"), F.lit(2).alias("length")), 4))
    assert sorted((r["sequence_id"], r["offset"]) for r in only) == [(k, o) for k in range(3) for o in (0, 2)]


def test_rules_lower_the_same_letters_as_pages(spark):
    pages = spark.createDataFrame([(1, "http://É.com/"), (2, "http://é.com/"), (3, "http://x.COM/")], "page_id long, url string")
    rules = spark.createDataFrame([("É.COM", "/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in collected(url_filter.judge(pages, rules))}
    assert got == {1: ("É.com/", "block"), 2: (None, "allow"), 3: (None, "allow")}


def test_stretches_of_a_long_text(monkeypatch):
    """The cut into stretches changes no anchor, and bounds the memory."""
    draw = np.random.default_rng(5)
    texts = [draw.integers(97, 100, 5000).astype(np.uint8), np.full(3000, 97, np.uint8), np.tile(
        np.frombuffer(b"abcabd", np.uint8), 500), draw.integers(97, 123, 40).astype(np.uint8)]
    for data in texts:
        for width, gram in ((40, 10), (41, 41), (400, 128)):
            hashes = suffix_dedup.gram_hashes(data, gram)
            got = suffix_dedup.anchors_of(data, width, gram)
            for stretch in (1, 7, 64):
                monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
                low = np.uint64((1 << (stretch + width).bit_length()) - 1)
                monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
                cut = suffix_dedup.anchors_of(data, width, gram)
                spans = [(int(p), int(a), int(b)) for p, a, b in zip(*cut[1:])]
                for place, a, b in spans:
                    for window in (a, b):
                        inside = hashes[window:window + width - gram + 1] & ~low
                        assert place == window + int(np.argmin(inside))
                assert [a for _, a, _ in spans] == ([0] + [b + 1 for _, _, b in spans])[:len(spans)]
                assert (spans[-1][2] if spans else -1) == max(len(data) - width, -1)
            monkeypatch.undo()
            assert len(got[0]) <= max(0, len(data) - width + 1)
    long = np.frombuffer(b"0123456789 " * 450_000, np.uint8)
    tracemalloc.start()
    suffix_dedup.anchors_of(long, 400, 128)
    assert tracemalloc.get_traced_memory()[1] < 250 << 20
    tracemalloc.stop()


def test_names_beside_the_callers(spark):
    frame = spark.range(1).toDF("__ID").withColumn("__id_", F.lit(1))
    assert free_names(frame, "__id", "__id", "__rows") == ["__id__", "__id___", "__rows"]
    words = " ".join(f"w{k}" for k in range(60))
    rows = [(k, text, "mine", "own", 5, "shared", [k], len(text)) for k, text in enumerate(
        [f"a{words}b one", f"{words} two", f"{words} three", "alone " * 3, "alone " * 3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string, __mark string, __key long, __sha string, "
                                       "__runs array<long>, n_chars long")
    for stage in (corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.repeats):
        got = stage(spark, docs, "")
        assert got.schema == docs.schema
        kept = collected(got)
        assert kept and all((r["__id"], r["__mark"], r["__key"], r["__sha"], r["__runs"]) == (
            "mine", "own", 5, "shared", [r["doc_id"]]) for r in kept)
