"""Every column of the fixed queries against plain Python, on a given table and on awkward rows."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkloom.llm import sharding, token_store
from sparkloom.llm.queries import QUERIES
from tests.llm.llm_data import awkward, collected
from tests.llm.test_llm_dedup import brute_cut

WORDS, BYTES = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module", params=["given", "awkward"])
def folder(request, spark, tables, tmp_path_factory):
    if request.param == "given":
        return tables
    path = str(tmp_path_factory.mktemp("awkward"))
    awkward(spark).write.parquet(f"{path}/documents.parquet")
    return path


def documents(spark, folder):
    return [(r["doc_id"], r["text"] or "") for r in collected(spark.read.parquet(f"{folder}/documents.parquet"))]


def rows_of(spark, folder, key, *columns):
    return Counter(tuple(r[c] for c in columns) for r in collected(QUERIES[key](spark, folder)))


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_codec(spark, folder):
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for doc, text in documents(spark, folder):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert rows_of(spark, folder, "op1_bpe_codec", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_suffix_dedup(spark, folder):
    docs = documents(spark, folder)
    want = Counter()
    for (doc, text), (n_bytes, spans, kept) in zip(docs, brute_cut([text for _, text in docs], 400)):
        want[doc, n_bytes, n_bytes - len(kept), len(spans), hashlib.sha256(kept).hexdigest()] += 1
    assert rows_of(spark, folder, "op2_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_suffix_dedup_returns_what_remains(spark, folder):
    docs = documents(spark, folder)
    want = Counter((doc, kept.decode("utf-8", "replace")) for (doc, _), (_, _, kept)
                   in zip(docs, brute_cut([text for _, text in docs], 400)))
    assert rows_of(spark, folder, "op2_suffix_dedup", "doc_id", "text") == want


def test_suffix_dedup_of_planted_passages(spark, tmp_path):
    """Passages of over 50 words go from the text if they have 400 bytes, and stay below that; clean texts stay."""
    def words(mark, n):
        return " ".join(f"{mark}{k:06d}" for k in range(n))

    long, short = words("l", 51), words("s", 51).replace("0000", "")
    assert len(long) >= 400 > len(short)
    parted = "é" * 200  # the characters that follow it have their first byte in common
    rows = [(1, f"{words('a', 60)}<{long}>{words('b', 9)}"), (2, f"{words('c', 30)}[{long}]{words('d', 80)}"),
            (3, f"{words('e', 60)}<{short}>"), (4, f"{words('f', 60)}[{short}]"), (5, words("g", 200)), (6, None),
            (7, f"(ü{parted}à"), (8, f"[ö{parted}á")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in collected(QUERIES["op2_suffix_dedup"](spark, str(tmp_path)))}
    texts = dict(rows)
    assert got == {**texts, 1: texts[1].replace(long, ""), 2: texts[2].replace(long, ""), 6: "",
                   7: "(ü\ufffd", 8: "[ö\ufffd"}


def test_token_counts(spark, folder):
    library = Tokenizer.from_file(BYTES)
    want = Counter()
    for doc, text in documents(spark, folder):
        n = len(library.encode(text, add_special_tokens=False).ids)
        want[doc, len(text.encode()), n, n > 512] += 1
    assert rows_of(spark, folder, "op3_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_packing(spark, folder):
    library = Tokenizer.from_file(BYTES)
    want = Counter()
    for doc, text in documents(spark, folder):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, piece, a, b - a, zlib.crc32(packed(ids[a:b]))] += 1
    assert rows_of(spark, folder, "op6_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32") == want
    places = defaultdict(list)
    for r in collected(QUERIES["op6_best_fit_packing"](spark, folder)):
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_token_store(spark, folder):
    library = Tokenizer.from_file(BYTES)
    made = {}
    for doc, text in documents(spark, folder):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        made.setdefault(doc, []).append((len(ids), zlib.crc32(packed(ids))))
    got = defaultdict(list)
    for r in collected(QUERIES["op7_token_store"](spark, folder)):
        got[r["doc_id"]].append((r["start"], r["n_tokens"], r["ids_crc32"]))
    at = 0
    for doc in sorted(made, key=lambda d: (d is not None, d or 0)):
        own = sorted(got.pop(doc))
        assert Counter(row[1:] for row in own) == Counter(made[doc])
        for start, n, _ in own:
            assert start == at
            at += n
    assert not got


def test_one_identifier_fills_several_parts(spark, tmp_path):
    rows = [(None, f"text {k} of many without identifier") for k in range(3000)] + [(k, f"own {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write_tokens(docs, BYTES, str(tmp_path / "tokens"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(str(tmp_path / "tokens"))
    per_part = token_store.read_tokens(stored).groupBy("part").agg(
        F.sum((F.col("doc_id") < 0).cast("int")).alias("nulls"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    found = sorted((r["part"], r["nulls"], r["low"], r["high"]) for r in collected(per_part))
    assert sum(r[1] for r in found) == 3000 and sum(r[1] > 300 for r in found) >= 3
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))


def hashed(*parts):
    """The engine's hash of several columns: each is the seed of the next."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def plain_ring(shards, virtual, cells):
    nodes = {}
    for number in range(shards * virtual):
        shard, copy = number % shards, number // shards
        cell = hashed(struct.pack("<i", shard), struct.pack("<q", copy)) % cells
        nodes[cell] = min(shard, nodes.get(cell, shard))
    return nodes


def test_ring_equals_a_plain_one(spark):
    nodes = plain_ring(24, 32, 8192)
    places = sorted(nodes)
    got = {r["cell"]: (r["arc"], r["shard"]) for r in collected(sharding.ring(spark, 24, 32))}
    assert len(got) == 8192
    for cell in range(8192):
        arc = next((p for p in places if p >= cell), places[0])
        assert got[cell] == (arc, nodes[arc])


def test_shards_equal_a_plain_ring(spark, folder):
    docs = documents(spark, folder)
    nodes = plain_ring(24, 32, 8192)
    places = sorted(nodes)
    bounds = [len(docs) // 24 + (shard < len(docs) % 24) for shard in range(24)]
    waiting = Counter()  # rows by the place of their virtual node
    for _, text in docs:
        cell = hashed(text.encode()) % 8192
        waiting[places.index(next((p for p in places if p >= cell), places[0]))] += 1
    want, room, start = Counter(), list(bounds), dict(waiting)
    here = {k: k for k in waiting}
    while any(waiting.values()):  # lap after lap, one row at a time
        for k in sorted(waiting):
            shard = nodes[places[here[k]]]
            while waiting[k] and room[shard]:
                waiting[k] -= 1
                room[shard] -= 1
                want[k, shard] += 1
            while waiting[k] and not room[nodes[places[here[k]]]]:
                here[k] = (here[k] + 1) % len(places)
    assert sum(want.values()) == len(docs) and start
    found, slots = Counter(), defaultdict(list)
    for r in collected(QUERIES["op10_ring_shards"](spark, folder)):
        found[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    by_shard = Counter()
    for (_, shard), n in want.items():
        by_shard[shard] += n
    assert found == by_shard
    sizes = Counter((doc, len(text.encode()) + 8, zlib.crc32(text.encode())) for doc, text in docs)
    assert rows_of(spark, folder, "op10_ring_shards", "doc_id", "size", "text_crc32") == sizes
    # Rows of an arc are numbered in one order: each shard gets as many of an arc as the plain ring gives it.
    text_of = {doc: text for doc, text in docs if doc is not None}
    got = Counter()
    for r in collected(QUERIES["op10_ring_shards"](spark, folder)):
        if r["doc_id"] in text_of:
            cell = hashed(text_of[r["doc_id"]].encode()) % 8192
            got[places.index(next((p for p in places if p >= cell), places[0])), r["shard"]] += 1
    if None not in [doc for doc, _ in docs]:
        assert got == want
