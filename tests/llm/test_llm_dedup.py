import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparkloom.llm import exact_dedup, jaccard_join, suffix_dedup
from sparkloom.llm.collection_bwt import build, repeated_starts
from sparkloom.llm.components import components
from tests.llm.llm_data import awkward, collected, nothing

LOWEST = -(2**63)


def found(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("budget", [1 << 26, 500])
def test_copies(spark, keep, budget):
    rows = collected(awkward(spark))
    ids: dict[str, list] = {}
    for row in rows:
        ids.setdefault(row["text"] or "", []).append(LOWEST if row["doc_id"] is None else row["doc_id"])
    best = min if keep == "smallest" else max
    want, kept = [], Counter()
    for text, group in ids.items():
        chosen = best(group)
        for k in group:
            want.append({"doc_id": None if k == LOWEST else k, "keep_id": None if chosen == LOWEST else chosen,
                         "group_size": len(group), "text_sha256": hashlib.sha256(text.encode()).hexdigest()})
    got = collected(exact_dedup.find_copies(awkward(spark), keep, budget=budget))
    for row in got:
        if row.pop("kept"):
            kept[row["text_sha256"]] += 1
            assert row["doc_id"] == row["keep_id"]
    assert sorted(map(repr, got)) == sorted(map(repr, [{k: w[k] for k in got[0]} for w in want]))
    assert len(kept) == len(ids) and set(kept.values()) == {1}
    assert collected(exact_dedup.find_copies(nothing(spark))) == []


def test_trie():
    draw = random.Random(2)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 9))).encode() for _ in range(400)]
    trie = exact_dedup.PatriciaTrie()
    for k, text in enumerate(texts):
        trie.add(text, k)
    want = {}
    for k, text in enumerate(texts):
        want.setdefault(text, []).append(k)
    out = dict(trie.spill())
    assert out and set(out) < set(want)
    out |= dict(trie.drain())
    assert out == want and trie.size == 0


def test_transform_against_sorted_suffixes():
    draw = random.Random(3)
    for _ in range(150):
        strings = ["".join(draw.choice(draw.choice(["ab", "abcdef"])) for _ in range(draw.randint(0, 14))).encode()
                   for _ in range(draw.randint(1, 6))]
        strings += strings[:1]
        suffixes = sorted((s[o:], i, o) for i, s in enumerate(strings) for o in range(len(s) + 1))
        transform, prefixes = build(strings)
        assert transform.tolist() == [strings[i][o - 1] + 1 if o else 0 for _, i, o in suffixes]

        def common(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        assert prefixes.tolist() == [0, *[common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]]
        width = draw.randint(1, 5)
        uses = Counter(s[o:o + width] for s in strings for o in range(len(s) - width + 1))
        assert [x.tolist() for x in repeated_starts(strings, width)] == [
            [o for o in range(len(s) - width + 1) if uses[s[o:o + width]] > 1] for s in strings]


def brute_cut(texts: list[str], width: int):
    raw = [t.encode() for t in texts]
    uses = Counter(r[o:o + width] for r in raw for o in range(len(r) - width + 1))
    for r in raw:
        gone = [False] * len(r)
        for o in range(len(r) - width + 1):
            if uses[r[o:o + width]] > 1:
                gone[o:o + width] = [True] * width
        spans, o = [], 0
        while o < len(r):
            if gone[o]:
                end = next((k for k in range(o, len(r)) if not gone[k]), len(r))
                spans.append({"start": o, "length": end - o})
                o = end
            else:
                o += 1
        yield len(r), spans, bytes(b for b, g in zip(r, gone) if not g)


@pytest.mark.parametrize("width, most, block", [(40, 1000, 1 << 20), (40, 2, 300), (400, 1000, 1 << 20), (5, 1, 100)])
def test_repeated_strings(spark, width, most, block):
    rows = collected(awkward(spark))
    want = sorted(((r["doc_id"], *cut) for r, cut in zip(rows, brute_cut([r["text"] or "" for r in rows], width))),
                  key=repr)
    got = collected(suffix_dedup.cut_repeats(awkward(spark), width, most=most, block=block))
    assert sorted(((r["doc_id"], r["n_bytes"], r["spans"], bytes(r["kept"])) for r in got), key=repr) == want


def test_a_text_that_repeats_itself_is_one_row(spark):
    """Anchors that follow one another with equal strings are counted, not listed."""
    raw = b"start " + b"ab " * 500 + b"end"
    found = suffix_dedup.anchors_of(np.frombuffer(raw, np.uint8), 40, 20)
    hashes, first, _, size, times = suffix_dedup._once(raw, found, 40)
    assert len(found[0]) > 400 and len(hashes) < 60
    assert (size * times).sum() == len(raw) - 39 and (first == np.cumsum(size * times) - size * times).all()
    docs = spark.createDataFrame([(1, "x" * 3000), (2, "no " * 9 + "x" * 41), (3, "xy" * 900)], "doc_id long, text string")
    want = sorted(brute_cut([r["text"] for r in collected(docs)], 40), key=repr)
    got = collected(suffix_dedup.cut_repeats(docs, 40))
    assert sorted(((r["n_bytes"], r["spans"], bytes(r["kept"])) for r in got), key=repr) == want


def test_cut_rows(spark):
    got = collected(suffix_dedup.cut_rows(awkward(spark), 40))
    assert set(got[0]) == set(awkward(spark).columns) and len(got) == awkward(spark).count()
    assert sum(r["text"] is None for r in got) == 2
    texts = [r["text"] or "" for r in collected(awkward(spark))]
    want = Counter(kept.decode("utf-8", "ignore") for _, _, kept in brute_cut(texts, 40))
    assert Counter(r["text"] or "" for r in got) == want
    assert collected(suffix_dedup.cut_repeats(nothing(spark))) == []


def brute_groups(rows, width, percent):
    sets = []
    for row in rows:
        words = (row["text"] or "").encode().lower().split()
        span = min(width, len(words))
        sets.append({tuple(words[k:k + span]) for k in range(len(words) - span + 1)} if words else set())
    ids = [LOWEST if r["doc_id"] is None else r["doc_id"] for r in rows]
    parent = {k: k for k in ids}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(ids[i]), top(ids[j])))
                parent[y] = x
    return sorted([(r["doc_id"], len(s), None if top(k) == LOWEST else top(k)) for r, s, k in zip(rows, sets, ids)],
                  key=repr)


def near_copies(spark, count=300, groups=6):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(count):
        base = random.Random(k % groups)
        size = (6, 9, 14, 25, 60, 150)[k % groups]
        text = [base.choice(words) for _ in range(size)]
        for _ in range(draw.randint(0, 1 + size // 40)):
            text[draw.randrange(size)] = draw.choice(words)
        rows.append((k, " ".join(text[: len(text) - draw.randint(0, 1 + size // 60)])))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("width, percent", [(4, 85), (1, 60)])
def test_linked_groups(spark, width, percent):
    for docs in (awkward(spark), near_copies(spark)):
        got = collected(jaccard_join.link_groups(docs, width, percent))
        assert found(got, "doc_id", "n_shingles", "component_id") == brute_groups(collected(docs), width, percent)
    assert collected(jaccard_join.link_groups(nothing(spark), width, percent)) == []


@pytest.mark.parametrize("upto", [0, 30])
def test_any_boundary_and_salted_lists(spark, monkeypatch, upto):
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 2)
    monkeypatch.setattr(jaccard_join.Similarity, "boundary", lambda self, sizes: upto)
    docs = near_copies(spark, 200)
    got = collected(jaccard_join.link_groups(docs, 2, 80))
    assert found(got, "doc_id", "n_shingles", "component_id") == brute_groups(collected(docs), 2, 80)


def test_sizes():
    similarity = jaccard_join.Similarity(85)
    for n in range(1, 80):
        for m in range(1, 80):
            shared = min(k for k in range(n + m + 1) if 100 * k >= 85 * (n + m - k))
            assert similarity.shared(n, m) == shared
            if shared <= min(n, m):
                assert m <= similarity.largest(n) and n - shared < similarity.prefix(n)
    assert similarity.boundary({}) == 0
    assert similarity.boundary({3: 10_000, 500: 5}) >= 3


def test_components(spark):
    draw = random.Random(1)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    parent = {k: k for p in pairs for k in p}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in collected(components(spark.createDataFrame(pairs, "a long, b long"), "a", "b"))}
    assert got == {k: top(k) for k in parent if any(k in p and p[0] != p[1] for p in pairs)}


def test_strings_that_share_no_window_are_left_out_of_the_transform(monkeypatch):
    draw, width, ahead = random.Random(6), 60, 20
    core = bytes(draw.choices(range(97, 123), k=40))  # what all windows hold, from 20 bytes before the anchor's place on

    def string(left, right):
        return bytes(left) + core + bytes(right)

    sides = [bytes(draw.choices(range(97, 123), k=20)) for _ in range(8)]
    alone = [string(sides[0], sides[1]), string(sides[2][:10] + sides[3][:10], sides[4])]
    twins = [string(sides[5], sides[6]), string(sides[7][:8] + sides[5][8:], sides[6])]  # 13 windows in common
    strings = [(7, bytes([k]), ahead, text) for k, text in enumerate(alone + twins)]
    strings += [(8, b"x", ahead, alone[0][::-1]), (8, b"y", ahead, string(sides[0], sides[0]))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*strings), (
        pa.int64(), pa.binary(), pa.int32(), pa.binary()))], ["anchor", "sig", "ahead", "bytes"])
    met = []
    monkeypatch.setattr(suffix_dedup, "repeated_starts",
                        lambda block, size: met.extend(block) or repeated_starts(block, size))
    found = [tuple(row.values()) for rows in suffix_dedup._found(width, 1 << 20, iter([batch.slice(0, 3), batch.slice(3)]))
             for row in rows.to_pylist()]
    assert sorted(met) == sorted(twins)
    assert sorted(found) == [(7, b"\x02", 8, 21), (7, b"\x03", 8, 21)]
