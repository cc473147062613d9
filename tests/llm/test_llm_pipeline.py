import random
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkloom.llm import quality_rules, suffix_dedup
from sparkloom.llm.queries import QUERIES
from tests.llm.llm_data import awkward, collected
from tests.llm.test_llm_dedup import brute_cut, brute_groups


def documents(spark):
    return awkward(spark).selectExpr("doc_id", "text", "kept AS lang", "shard AS source", "cast(length(text) AS bigint) AS n_chars")


def texts(frame):
    return sorted(((r["doc_id"], r["text"]) for r in collected(frame)), key=repr)


def test_stages_on_awkward_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark)
    good = {r["doc_id"] for r in collected(quality_rules.judge(docs, quality_rules.accept_all())) if r["kept"]}
    assert {r[0] for r in texts(corpus_pipeline.quality(spark, docs, str(tmp_path)))} == good

    kept = corpus_pipeline.exact(spark, docs, "")
    rows = collected(kept)
    assert kept.columns == docs.columns
    assert sorted({r["text"] or "" for r in rows}) == sorted(r["text"] or "" for r in rows)
    assert {r["text"] or "" for r in rows} == {r["text"] or "" for r in collected(docs)}

    near = corpus_pipeline.near(spark, docs, "")
    groups = brute_groups(collected(docs), 5, 80)
    assert sorted((r["doc_id"] for r in collected(near)), key=repr) == sorted(
        {doc for doc, _, group in groups if doc == group}, key=repr)

    cut = corpus_pipeline.repeats(spark, docs.where("doc_id < 60"), "")
    left = collected(docs.where("doc_id < 60"))
    want = [kept.decode("utf-8", "ignore") for _, _, kept in brute_cut([r["text"] or "" for r in left], 400)]
    assert sorted(r["text"] or "" for r in collected(cut)) == sorted(want)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in collected(cut))
    assert cut.schema == docs.schema

    out = collected(corpus_pipeline.packed(spark, docs, ""))
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in collected(docs)}


def test_stages_on_empty_documents(spark, tables):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert collected(stage(spark, docs, tables)) == []


def test_run_equals_brute_force(spark, tables):
    docs = collected(spark.read.parquet(f"{tables}/documents.parquet"))
    frame, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    field = quality_rules.train(frame, labels)

    def stays(text):
        lines = quality_rules.lines_of(text)
        return not quality_rules.base_counts(text, lines)[-1] and quality_rules.content_share(field, lines) >= 0.5

    docs = [d for d in docs if stays(d["text"] or "")]
    first: dict = {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        first.setdefault(d["text"], d)
    docs = list(first.values())
    alone = {doc for doc, _, group in brute_groups(docs, 5, 80) if doc == group}
    docs = [d for d in docs if d["doc_id"] in alone]
    out = collected(corpus_pipeline.run(spark, tables))
    library, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for d, left in zip(docs, brute_left([d["text"] or "" for d in docs], 400, 51)):
        ids = [*library.encode(left, add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
            packed = struct.pack(f"<{stop - start}I", *ids[start:stop])
            want[d["doc_id"], piece, start, stop - start, zlib.crc32(packed)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    assert {key[0] for key in want} == alone
    tokens = sum(r["length"] for r in out)
    assert len({r["sequence_id"] for r in out}) <= 1 + -(-tokens // 2048) * 1.02


def brute_left(texts, width, words):
    """What is left of each text without repeated strings of `width` bytes and repeated passages of `words` words."""
    raws = [text.encode() for text in texts]
    found = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", raw)] for raw in raws]
    strings = Counter(raw[k:k + width] for raw in raws for k in range(len(raw) - width + 1))
    passages = Counter(tuple(raw[a:b] for a, b in places[k:k + words])
                       for raw, places in zip(raws, found) for k in range(len(places) - words + 1))
    out = []
    for raw, places in zip(raws, found):
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            if strings[raw[k:k + width]] > 1:
                gone[k:k + width] = b"\1" * width
        for k in range(len(places) - words + 1):
            if passages[tuple(raw[a:b] for a, b in places[k:k + words])] > 1:
                first, last = places[k][0], places[k + words - 1][1]
                gone[first:last] = b"\1" * (last - first)
        out.append(bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore"))
    return out


def test_every_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert [f for _, f in corpus_pipeline.STAGES][1:4] == [corpus_pipeline.exact, corpus_pipeline.near,
                                                           corpus_pipeline.repeats]


def test_passages_of_over_50_words_are_cut(spark):
    draw = random.Random(11)

    def fresh(count):
        return [f"{draw.randrange(10**5):x}" for _ in range(count)]

    rows, want = [], {}
    for size in (50, *range(51, 67)):  # below 400 bytes, in two unrelated documents each
        passage = fresh(size)
        assert len(" ".join(passage)) < 400
        for copy, space in enumerate((" ", "\n" if size % 2 else " ")):
            before, after, name = fresh(draw.randint(0, 90)), fresh(draw.randint(1, 90)), 10 * size + copy
            before, after = [*before, f"é{name}"], [f"ü{name}", *after]
            rows.append((name, " ".join(before) + " " + space.join(passage) + " " + " ".join(after)))
            want[name] = [*before, *(passage if size == 50 else []), *after]
    for name in range(5):  # nothing in common
        rows.append((name, " ".join(fresh(200)) + " \n "))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "n_chars", F.length("text").cast("long")).repartition(5)
    got = {r["doc_id"]: r["text"] for r in collected(corpus_pipeline.repeats(spark, docs, ""))}
    assert {k: got[k].split() for k in want} == want
    assert {k: got[k] for k in range(5)} == dict(rows[-5:])


def test_passages_against_brute_force(spark):
    draw = random.Random(12)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 40))) for _ in range(40)] + ["a " * 30, None]
    uses = Counter(tuple(w[k:k + 6]) for w in ((t or "").split() for t in texts) for k in range(len(w) - 5))
    want = Counter()
    for words in ((t or "").split() for t in texts):
        gone = {j for k in range(len(words) - 5) if uses[tuple(words[k:k + 6])] > 1 for j in range(k, k + 6)}
        want[tuple(w for j, w in enumerate(words) if j not in gone)] += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for most, block in ((1000, 1 << 20), (2, 300)):
        got = collected(suffix_dedup.cut_rows(docs, 400, words=6, most=most, block=block))
        assert Counter(tuple((r["text"] or "").split()) for r in got) == want


def test_near_stage_goes_by_texts(spark):
    draw = random.Random(13)

    def fresh():
        return " ".join(str(draw.randrange(10**6)) for _ in range(60))

    one, two, three, four = fresh(), fresh(), fresh(), fresh()
    docs = [(None, "one without identifier"), (None, None), (None, one), (None, two), (7, three), (7, fresh()),
            (7, fresh()), (3, three + " end"), (9, four), (8, four + " end"), (5, one + " end"), (6, "alone"),
            (6, fresh()), (6, two + " more")]
    gone = [(7, three), (9, four), (5, one + " end"), (6, two + " more")]  # each linked to a smaller one that stays
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = texts(corpus_pipeline.near(spark, frame, ""))
    assert got == sorted((row for row in docs if row not in gone), key=repr)
    again = frame.unionByName(frame)  # equal rows are one
    assert texts(corpus_pipeline.near(spark, again, "")) == got
