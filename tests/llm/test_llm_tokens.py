import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkloom.llm import bpe_codec, common, token_counts, token_store, tokens
from tests.llm.llm_data import awkward, awkward_texts, collected, nothing

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_codec_equals_the_library(spark, path):
    library = Tokenizer.from_file(path)
    got = collected(bpe_codec.decode(bpe_codec.encode(awkward(spark), path), path))
    want = []
    for row in collected(awkward(spark)):
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        want.append((row["doc_id"], ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, want)) == sorted(
        repr((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"])) for r in got)
    assert collected(bpe_codec.decode(bpe_codec.encode(nothing(spark), path), path)) == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_and_counts_of_any_text(text):
    for path in (WORDS, BYTES):
        vocabulary = tokens.vocabulary_at(path)
        want = Tokenizer.encode(vocabulary.library, text, add_special_tokens=False).ids
        ids = tokens.packed_ids(vocabulary, bpe_codec._remembered(path), text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert token_counts.count_texts(path, [text, "x" + text])[0] == len(want)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="athe inon", min_size=1, max_size=400))
def test_short_and_long_words_merge_alike(text):
    vocabulary = tokens.vocabulary_at(WORDS)
    word = text.replace(" ", "") or "a"
    assert (bpe_codec.merge_short(vocabulary, vocabulary.symbols(word.encode()))
            == bpe_codec.merge_long(vocabulary, vocabulary.symbols(word.encode())))


def test_memory_is_bounded():
    known = common.BoundedMemory(lambda word: len(word).to_bytes(4, "little"), 4 * common.ENTRY)
    assert [known["a" * k] for k in range(1, 90)] == [k.to_bytes(4, "little") for k in range(1, 90)]
    assert 1 <= len(known) <= 3
    assert known["a" * 10_000] and known["b"] and len(known) <= 2  # a long entry leaves no room for others


def test_a_process_keeps_one_memory():
    first = common.kept("a", "x", list)
    assert common.kept("a", "x", list) is first and common.kept("a", "y", dict) == {}
    assert common.kept("b", "x", list) is not first and "y" not in common._KEPT


def test_counts(spark):
    library = Tokenizer.from_file(BYTES)
    got = collected(token_counts.count_tokens(awkward(spark), BYTES, limit=100))
    want = []
    for row in collected(awkward(spark)):
        n = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
        want.append({"doc_id": row["doc_id"], "n_bytes": len((row["text"] or "").encode()), "n_tokens": n,
                     "over_limit": n > 100})
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert collected(token_counts.count_tokens(nothing(spark), BYTES)) == []


@pytest.mark.parametrize("size", [1, 2, 63, 64, 1000, 70_000])
def test_blocks_round_trip(size):
    draw = np.random.default_rng(size)
    ids = (draw.zipf(1.3, size) % 50_257).astype("<u4")
    table = token_store.Table.of(ids)
    again = token_store.Table.unpack(table.pack(), table.bits)
    assert (again.symbols == table.symbols).all() and (again.scaled == table.scaled).all()
    assert table.scaled.sum() == 1 << table.bits and table.scaled.min() >= 1
    block = token_store.encode_block(ids, table, steps=16)
    spans = [token_store.decode_span(block, again, k) for k in range(token_store.spans_of(block))]
    assert (np.concatenate(spans) == ids).all()
    if size > 5000:  # any stretch on its own, and smaller than plain numbers
        assert len(spans) > 1 and len(block) < 0.7 * 4 * size


def test_damage_is_found():
    ids = np.arange(5000, dtype="<u4") % 97
    segment = bytearray(token_store.encode_segment([4, 9], [2000, 3000], ids, block_tokens=900))
    found = token_store.decode_segment(bytes(segment))
    assert found[0].tolist() == [4, 9] and found[1].tolist() == [2000, 3000] and (found[2] == ids).all()
    segment[len(segment) // 2] ^= 1
    with pytest.raises(ValueError):
        token_store.decode_segment(bytes(segment))
    table = token_store.Table.of(ids)
    block = bytearray(token_store.encode_block(ids, table))
    block[-1] ^= 64
    with pytest.raises((ValueError, IndexError)):
        [token_store.decode_span(bytes(block), table, k) for k in range(token_store.spans_of(bytes(block)))]


def test_token_files(spark):
    library = Tokenizer.from_file(BYTES)
    got = collected(token_store.round_trip(awkward(spark, repeats=False), BYTES, segment_tokens=3000))
    start = 0
    for row, (doc_id, text) in zip(sorted(got, key=lambda r: r["start"]),
                                   [(k * 7 + 1, t) for k, t in enumerate(awkward_texts())], strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, start, len(ids))
        assert zlib.crc32(row["ids"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    repeated = collected(token_store.round_trip(awkward(spark), BYTES))
    assert sorted(r["start"] for r in repeated)[0] == 0 and len(repeated) == awkward(spark).count()
    assert {r["doc_id"] for r in repeated if r["start"] < 5} >= {None}
    assert collected(token_store.round_trip(nothing(spark), BYTES)) == []


