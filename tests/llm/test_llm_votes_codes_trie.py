import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkloom.llm import prefix_trie, quality_votes, vector_codes
from sparkloom.llm.queries import op11_quality_votes, op12_vector_codes, op13_prefix_trie
from tests.llm.llm_data import awkward, collected, nothing

LABELS = "doc_id long, quality int, toxic int, score double"


# ---- quality votes

def brute_counts(text: bytes):
    counts = np.zeros(quality_votes.TERMS, int)
    kinds = quality_votes.KINDS
    for a, b, c in zip(text, text[1:], text[2:]):
        code = (int(kinds[a]) << 12) | (int(kinds[b]) << 6) | int(kinds[c])
        counts[(code * 2654435761 % 2**32) >> 20] += 1
    words = text.replace(b"\n", b" ").replace(b"\t", b" ").replace(b"\r", b" ").split(b" ")
    words = [word for word in words if word]
    counts[quality_votes.BUCKETS] = sum(a == b for a, b in zip(words, words[1:]))
    counts[quality_votes.BUCKETS + 1 + len(text).bit_length()] += 1
    return counts


def test_term_counts(spark, monkeypatch):
    texts = [(r["text"] or "").encode() for r in collected(awkward(spark))]
    for text in texts:
        assert (quality_votes.term_counts(text) == brute_counts(text)).all()
    monkeypatch.setattr(quality_votes, "STRETCH", 50)  # pairs of words across a border are not counted there
    for text in texts:
        got, want = quality_votes.term_counts(text), brute_counts(text)
        assert (np.delete(got, quality_votes.BUCKETS) == np.delete(want, quality_votes.BUCKETS)).all()
        assert got[quality_votes.BUCKETS] <= want[quality_votes.BUCKETS]


def test_votes_equal_brute_force():
    draw = np.random.default_rng(3)
    counts = draw.poisson(0.02, (60, quality_votes.TERMS))
    labels = draw.integers(0, 2, 60).astype(float)
    space = quality_votes.fit(counts[:40], labels[:40], (counts > 0).sum(0), 60, dimensions=20)
    got = quality_votes.votes(space, counts, 5)
    for row, score in zip(counts, got):
        weighted = np.log1p(row) * (np.log(61 / (1 + (counts > 0).sum(0))) + 1)
        place = weighted @ space.directions
        cosines = [round(float(place @ v / np.linalg.norm(place) / np.linalg.norm(v)), 6) for v in space.vectors]
        near = sorted(range(40), key=lambda k: (-cosines[k], k))[:5]
        weight = [max(0.0, cosines[k]) for k in near]
        assert score == pytest.approx(sum(w * labels[k] for w, k in zip(weight, near)) / sum(weight), abs=1e-6)
    for part in (1, 7):  # the block a document is in does not matter
        assert np.allclose(np.concatenate([quality_votes.votes(space, counts[k:k + part], 5)
                                           for k in range(0, 60, part)]), got, atol=1e-12)


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in collected(op11_quality_votes(spark, folder))}
    docs = collected(spark.read.parquet(f"{folder}/documents.parquet"))
    assert sorted(rows) == sorted(r["doc_id"] for r in docs)
    for k, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
    labels = [r for r in collected(spark.read.parquet(f"{folder}/labels.parquet")) if rows[r["doc_id"]]["held_out"]]
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    good = [rows[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 1]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right) and sum(good) >= 0.98 * len(good)


def test_held_out_labels_are_never_learned(spark):
    docs = awkward(spark)
    ids = [r["doc_id"] for r in collected(docs) if r["doc_id"] is not None]
    labels = [(k, k % 2, 0, 0.0) for k in ids]
    turned = [(k, 1 - y if zlib.crc32(str(k).encode()) % 4 == 2 else y, 0, 0.0) for k, y, _, _ in labels]
    one, two = (quality_votes.train(docs, spark.createDataFrame(x, LABELS)) for x in (labels, turned))
    assert (one.labels == two.labels).all() and (one.vectors == two.vectors).all()
    scores = [sorted(((r["doc_id"], r["score"]) for r in collected(quality_votes.judge(docs, s))), key=repr)
              for s in (one, two)]
    assert scores[0] == scores[1] and len(scores[0]) == docs.count()


def test_votes_without_labels_or_rows(spark):
    labels = spark.createDataFrame([(1, None, 0, 0.0), (None, 1, 0, 0.0), (8, 5, 0, 0.0)], LABELS)
    space = quality_votes.train(awkward(spark), labels)
    assert {r["score"] for r in collected(quality_votes.judge(awkward(spark), space))} == {0.5}
    space = quality_votes.train(nothing(spark), spark.createDataFrame([(1, 1, 0, 0.0)], LABELS))
    assert collected(quality_votes.judge(nothing(spark), space)) == []
    twice = [(1, 0, 0, 0.0), (1, 1, 0, 0.0), (15, 1, 0, 0.0), (22, 0, 0, 0.0)]
    space = quality_votes.train(awkward(spark), spark.createDataFrame(twice, LABELS))
    assert set(space.labels) <= {0.0, 0.5, 1.0}


# ---- vector codes

def brute_codes(rows, parts, entries, rounds):
    """Rows (id, vector, label) in any order; the plain form of the method over kept rows."""
    kept = [(k, [int(np.floor(256 * float(x))) for x in v], label) for k, v, label in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] if r[0] is not None else -2**63, r[1]))[:entries]
    books = [[tuple(r[1][p * width:(p + 1) * width]) for r in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], entry)), e)
                   for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, v)[1] for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * width:(p + 1) * width] for (_, v, _), got in zip(kept, found[p]) if got == e]
                if mine:
                    books[p][e] = tuple(sum(column) // len(mine) for column in zip(*mine))
    out, by_label = [], defaultdict(int)
    for k, v, label in kept:
        got = [nearest(p, v) for p in range(parts)]
        error = sum(d for d, _ in got)
        by_label[label] += error
        out.append((k, label, "".join(f"{e:02x}" for _, e in got), error))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((k, label, code, error, by_label[label], sha) for k, label, code, error in out), key=repr), books


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, label_error int"


def vectors(seed=1, n=700, width=8, copies=200):
    draw = random.Random(seed)
    rows = [(k, [draw.choice((draw.gauss(0, 0.3), draw.randint(-2, 2) / 64)) for _ in range(width)],
             draw.choice((None, 0, 1, 5))) for k in range(n)]
    same = [0.25, -0.25, 0.0, 0.5, 0.125, 0.0, 0.0, -1.0][:width]
    rows += [(1000 + k, same, 2) for k in range(copies)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[7][1], 0), (2000, None, 1), (2001, [None] * width, 1),
             (2002, [float("nan")] * width, 1), (2003, [float("inf")] + [0.0] * (width - 1), 1), (2004, [], 1)]
    return [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label)
            for k, v, label in rows]


@pytest.mark.parametrize("parts,entries,rounds,block", [(2, 16, 2, 100), (4, 64, 3, 4096), (8, 7, 1, 33)])
def test_codes_equal_brute_force(spark, parts, entries, rounds, block):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "mine", 7, 3) for r in rows], SCHEMA).repartition(3)
    got = vector_codes.encode(frame, parts, entries, rounds, block=block)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    want, _ = brute_codes(rows, parts, entries, rounds)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_codes_of_the_given_table(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    want, _ = brute_codes(rows, 16, 64, 2)
    got = sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
                  for r in op12_vector_codes(spark, tables).collect()), key=repr)
    assert got == sorted(((k, *rest) for k, _, *rest in want), key=repr)


def test_codes_of_odd_tables(spark):
    def frame(rows):
        return spark.createDataFrame([(*r, "mine", 7, 3) for r in rows], SCHEMA)

    assert vector_codes.encode(frame([]), 2, 4, 2).collect() == []
    assert vector_codes.encode(frame([(1, None, 1), (2, [], 0)]), 2, 4, 2).collect() == []
    one = vector_codes.encode(frame([(1, [1.0, 2.0], None)]), 2, 4, 2).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in one] == [("0000", 0, 0)]
    # More parts than components, vectors of another length, and components that no long can hold the square of.
    few = vector_codes.encode(frame([(1, [1.0, 2.0], 1), (2, [0.0, 1.0], 1), (3, [1.0], 1), (4, [1e30, 0.0], 1)]), 4, 2, 1)
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in few.collect()) == [(1, "00000000", 0), (2, "00010001", 0)]
    with pytest.raises(ValueError):
        vector_codes.encode(frame([]), 2, 257, 1)


def test_cover_tree():
    draw = np.random.default_rng(2)
    for width, spread in ((4, 60), (1, 4000), (3, 2**26), (4, 2)):
        rows = draw.integers(-spread, spread, (900, width))
        tree = vector_codes.build(rows)
        assert (tree.points[tree.place_of_row] == rows).all() and tree.counts.sum() == len(rows)
        opened = 0
        for node in range(len(tree.centre)):
            points = tree.points[tree.first[node]:tree.last[node]]
            far = np.sqrt(vector_codes.squared(points, tree.points[tree.centre[node]][None]).astype(float))
            assert tree.first[node] <= tree.centre[node] < tree.last[node]
            assert far.max() == pytest.approx(tree.reach[node])
            kids = np.arange(tree.child[node], tree.child_end[node])
            opened += len(kids) > 0
            if len(kids):
                spans = sorted(zip(tree.first[kids], tree.last[kids]))
                assert spans[0][0] == tree.first[node] and spans[-1][1] == tree.last[node]
                assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
                assert (tree.reach[kids] <= tree.reach[node] / 2).all()
                apart = [np.sqrt(float(vector_codes.squared(tree.points[tree.centre[[a]]], tree.points[tree.centre[[b]]])[0]))
                         for a in kids for b in kids if a < b]
                assert min(apart) > tree.reach[node] / 2
        assert opened > 3
        entries = rows[:20] + draw.integers(-2, 2, (20, width))
        chosen, error = vector_codes.codes(tree, entries)
        exact = ((rows[:, None, :] - entries[None]) ** 2).sum(2)
        assert (chosen == exact.argmin(1)).all() and (error == exact.min(1)).all()
        number, total = vector_codes.sums(tree, entries)
        assert all((total[e] == rows[chosen == e].sum(0)).all() and number[e] == (chosen == e).sum() for e in range(20))
        again = vector_codes._unpacked(vector_codes._packed(tree))
        assert all((a == b).all() for a, b in zip(tree, again))


def test_balls_are_assigned_whole():
    """Far groups are decided near the root: fewer ranges than points."""
    draw = np.random.default_rng(4)
    centres = draw.integers(-10**5, 10**5, (8, 4))
    tree = vector_codes.build(centres[draw.integers(0, 8, 4000)] + draw.integers(-50, 50, (4000, 4)))
    first, last, _ = vector_codes.assign(tree, centres)
    assert len(first) < 100 and (last - first).sum() == len(tree.points)


# ---- prefix trie

def brute_trie(rows, step=5, folds=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role.encode())}/{role}/{text}".encode()).hexdigest()[:32]
        own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r[3], r[4]) for r in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        if c is None:
            built[c] = turns
            continue
        h = zlib.crc32(str(c).encode()) % folds
        base = c - (abs(c) % step) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    low = {None: -2**63}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(low.get(c, c))
        ends[tuple(turns)].append(low.get(c, c))
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1].encode() if node else b"") + sum(
            saved[k] for k in kids[node])
    back = {-2**63: None}

    def shown(c):
        return back.get(c, c)

    out = []
    for node, who in members.items():
        least = min(who)
        text = ",".join("null" if c == -2**63 else str(c) for c in sorted(ends[node]))
        out.append((shown(least), len(node), shown(min(members[node[:-1]])) if node else None, len(who),
                    len(kids[node]), leaves[node], saved[node], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id long, turn long, role string, text string, name string, at long, conv long"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "mine", 5, 6) for r in rows], TURNS).repartition(4)


def trie_rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_trie_equals_brute_force(spark):
    draw = random.Random(6)
    rows = []
    for c in [*range(-12, 60), 10**15, 10**15 + 1]:
        for t in range(draw.choice((1, 2, 3, 8, 9, 15))):
            rows.append((c, t, draw.choice(("user", "bot", None, "")), draw.choice(("a", "b", None, "", "é/1", "x" * 30))))
    rows += [(None, 1, "user", "a"), (None, None, "user", "b"), (3, None, "user", "late"), (3, 1, "user", "tie"),
             (3, 1, "bot", "tie"), (3, 1, "bot", "tie")]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(3)]  # one large group of copies
    got = prefix_trie.trie(turns_of(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert trie_rows(got) == brute_trie(rows)


def test_trie_of_a_long_conversation(spark):
    """One conversation has most turns; another leaves it in the middle."""
    rows = [(5, t, "user", str(t)) for t in range(300)]
    rows += [(6, t, "user", str(t) if t < 140 else f"own {t}") for t in range(160)]
    rows += [(1, 0, "user", "short")]
    assert trie_rows(prefix_trie.trie(turns_of(spark, rows))) == brute_trie(rows)


def test_trie_of_odd_tables(spark):
    assert prefix_trie.trie(turns_of(spark, [])).collect() == []
    rows = [(1, 0, "user", "all borrowed away")] if zlib.crc32(b"1") % 9 else [(2, 0, "user", "gone")]
    assert trie_rows(prefix_trie.trie(turns_of(spark, rows))) == brute_trie(rows)
    assert trie_rows(prefix_trie.trie(turns_of(spark, [(None, None, None, None)]))) == brute_trie(
        [(None, None, None, None)])


def test_trie_of_the_given_table(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(op13_prefix_trie(spark, tables)) == brute_trie(rows)
