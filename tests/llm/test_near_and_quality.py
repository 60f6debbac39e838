"""Order MinHash classes against all pairs, and the classifier on held-out rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import order_minhash as om
from marketlens.llm import quality_trees as qt
from marketlens.llm import symbols

DATA = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@given(st.lists(st.integers(0, 6), max_size=40), st.lists(st.tuples(st.integers(0, 40), st.integers(-1, 6)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_banded_alignment(a, edits):
    b = list(a)
    for place, value in edits:
        if value < 0 and b:
            b.pop(place % len(b))
        else:
            b.insert(place % (len(b) + 1), value)
    want = distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)
    x, y = np.array(a, np.int64), np.array(b, np.int64)
    assert om.edit_links([(x, y), (y, x)], 0.8) == [want, want]


def brute_classes(docs):
    """All pairs by edit similarity alone; words compared as they are."""
    texts = {d: (t or "").encode().split() for d, t in docs}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    counts = {d: Counter(texts[d]) for d in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if find(a) == find(b):
                continue
            x, y = texts[a], texts[b]
            longest = max(len(x), len(y))
            limit = int(longest * 0.2 + 1e-9)
            # a distance is at least the number of words that the longer text has alone
            if x == y or longest - (counts[a] & counts[b]).total() <= limit and distance(x, y) <= limit:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d in ids}


@pytest.fixture(scope="module")
def near_docs(corpus):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghijkl") + str(rng.randrange(300))
    docs = list(corpus)
    for g in range(4):
        base = [word() for _ in range(rng.choice([60, 150, 400]))]
        for i in range(40 if g == 0 else 4):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = word()
            docs.append((2000 + 100 * g + i, " ".join(w)))
    docs += [(3000 + i, t) for i, t in enumerate(["a b", "a  b", "a b c", " ", "\n", "w " * 100, "w " * 110, "w " * 300])]
    shared = " ".join(word() for _ in range(60))
    docs += [(4000 + i, shared + " " + " ".join(word() for _ in range(25))) for i in range(30)]
    return docs


def test_classes_match_all_pairs(spark, near_docs):
    frame = spark.createDataFrame([(d, t, 7, "z") for d, t in near_docs], "doc_id long, text string, rep int, words string")
    got = om.classes(frame.repartition(6)).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(near_docs)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    kept = om.kept_documents(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_classes(near_docs).values()))


def test_texts_under_one_id(spark):
    """Each text under a repeated id has links and a class of its own."""
    rng = random.Random(6)
    one, two, three = (" ".join(f"{c}{rng.randrange(9999)}" for _ in range(50)) for c in "xyz")
    rows = [(5, one, "a"), (5, two, "b"), (5, two, "b"), (7, one + " end", "c"), (8, two + " end", "d"), (9, three, "e"), (9, None, "f")]
    docs = spark.createDataFrame([(d, t, c, 1) for d, t, c in rows], "doc_id int, text string, _id string, given int").repartition(3)
    got = Counter((r.doc_id, r.class_id, r.kept) for r in om.classes(docs).collect())
    assert got == Counter({(5, 5, True): 3, (7, 5, False): 1, (8, 5, False): 1, (9, 9, True): 2})
    kept = om.kept_documents(docs)
    assert kept.schema == docs.schema
    assert sorted(((r.doc_id, r.text, r._id) for r in kept.collect()), key=str) == sorted([(5, one, "a"), (5, two, "b"), (9, three, "e"), (9, None, "f")], key=str)


def test_chains_in_large_groups(spark):
    """Texts of a large group that link to their neighbours in a chain, but not
    to the group's leaders, beside texts that only share a passage."""
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijkl") + str(rng.randrange(3000))
    passage = [word() for _ in range(150)]
    texts = []
    for _ in range(3):
        w = [word() for _ in range(100)]
        for place in range(0, 100, 4):
            texts.append(" ".join(passage + w))
            w = list(w)
            w[place : place + 4] = [word() for _ in range(4)]
    texts += [" ".join(passage + [word() for _ in range(rng.choice([30, 100]))]) for _ in range(40)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert {r.doc_id: r.class_id for r in om.classes(frame).collect()} == brute_classes(docs)


def test_open_pairs_hold_every_similar_pair(spark):
    """All texts in one large group, each its own component: no pair of the
    wanted edit similarity is missing."""
    rng = random.Random(4)
    base = [rng.randrange(1, 2**32) for _ in range(120)]
    words = []
    for i in range(60):
        w = list(base[: rng.choice([60, 100, 120])])
        for _ in range(rng.randrange(20)):
            w[rng.randrange(len(w))] = rng.choice([rng.randrange(1, 2**32), w[0]])
        words.append((i, np.array(w, "<u4")))
    words += [(60, np.array([5], "<u4")), (61, np.array([5, 6], "<u4"))]
    large = spark.createDataFrame([(0, 1, i) for i, _ in words], "sketch int, value long, rep long")
    texts = spark.createDataFrame([(i, bytearray(w.tobytes())) for i, w in words], "rep long, words binary")
    roots = spark.createDataFrame([(1, 0)], "node long, root long")
    near = lambda v, w: distance(v.tolist(), w.tolist()) <= int(max(len(v), len(w)) * 0.2 + 1e-9)
    want = {(a, b) for a, v in words for b, w in words if a < b and near(v, w)} - {(0, 1)}
    got = {(r.a, r.b) for r in om.open_pairs(large, roots, texts).collect()}
    assert len(want) > 50 and want <= got and (0, 1) not in got
    assert om.open_pairs(large.limit(0), roots, texts.limit(0)).count() == 0


def components_of(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in nodes}


def test_dense_family_makes_no_row_for_a_pair(spark, monkeypatch):
    """Copies of one text in a component, and others about as far from them as
    the limit: blocks give the links that connect them, and no pair is made for
    each two.  A text that shares no group with them meets its link by word pair."""
    monkeypatch.setattr(om, "BLOCK", 32)
    rng = random.Random(12)
    base = [rng.randrange(1, 2**32) for _ in range(100)]
    spare = [rng.randrange(1, 2**32) for _ in range(300)]

    def edited(w, n):
        w = list(w)
        for place in rng.sample(range(len(w)), n):
            w[place] = rng.choice(spare)
        return np.array(w[: rng.choice([len(w), len(w) - 2])], "<u4")

    words = [(i, edited(base, 3)) for i in range(60)] + [(i, edited(base, rng.choice([17, 20, 24]))) for i in range(60, 180)]
    lone = [rng.randrange(1, 2**32) for _ in range(90)]
    words += [(180, np.array(lone, "<u4")), (181, edited(lone, 6)), (182, edited(rng.sample(spare, 90), 0))]
    large = [(0, 1, i) for i in range(180)] + [(1, 5, 180), (1, 5, 182), (1, 6, 181), (1, 6, 182)]
    large = spark.createDataFrame(large, "sketch int, value long, rep long")
    texts = spark.createDataFrame([(i, bytearray(w.tobytes())) for i, w in words], "rep long, words binary")
    roots = spark.createDataFrame([(i, 0) for i in range(60)], "node long, root long")
    near = lambda v, w: distance(v.tolist(), w.tolist()) <= int(max(len(v), len(w)) * 0.2 + 1e-9)
    known = [(0, i) for i in range(60)]
    within = [(a, b) for a, v in words for b, w in words if a < b and b >= 60 and near(v, w)]
    pairs, found = om.open_links(large, roots, texts)
    pairs, found = ([(r.a, r.b) for r in x.collect()] for x in (pairs, found))
    assert (180, 181) in pairs and len(pairs) <= 5 and set(found) <= set(within)
    want = components_of(range(183), known + within)
    assert 30 < len(set(want.values())) < 110 and components_of(range(183), known + found + pairs) == want
    assert {(a, b) for a, b in within} <= {(r.a, r.b) for r in om.open_pairs(large, roots, texts).collect()}


@given(st.integers(0, 10**6))
@settings(max_examples=40, deadline=None)
def test_links_between_blocks(seed):
    rng = random.Random(seed)
    base = [rng.randrange(12) for _ in range(rng.randrange(1, 40))]

    def text(i):
        w = [rng.randrange(12) if rng.random() < 0.15 else x for x in base] + [3] * rng.randrange(4)
        return i, rng.choice([i, 100]), np.array(w, np.int64)

    left, right = [text(i) for i in range(6)], [text(i) for i in range(6, 12)]
    want = {(a[0], b[0]) for a in left for b in right if a[1] != b[1] and distance(a[2].tolist(), b[2].tolist()) <= int(max(len(a[2]), len(b[2])) * 0.2 + 1e-9)}
    assert set(om.links_between(left, right, 0.8)) == want
    some = om.links_between(left, right, 0.8, spanning=True)
    nodes = [*range(12), 100]
    known = [(t[0], 100) for t in left + right if t[1] == 100]
    assert set(some) <= want and len(some) < 12 and components_of(nodes, known + some) == components_of(nodes, known + list(want))


def test_occurrences_and_order_matter():
    h = np.arange(1, 41, dtype=np.uint64) * np.uint64(977)
    one = om.sketches(symbols.mix(h), np.array([0, 40]))
    turned = om.sketches(symbols.mix(np.concatenate([h[20:], h[:20]])), np.array([0, 40]))
    assert 0 < (one == turned).sum() < om.SKETCHES
    w = symbols.mix(np.full(30, 5, np.uint64))
    assert not (om.sketches(w, np.array([0, 30])) == om.sketches(w[:9], np.array([0, 9]))).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(300, 300)]
    got = {r.node: r.root for r in om.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 260)}


@pytest.mark.parametrize("seed", range(4))
def test_components_of_repeated_edges(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(rng.choice([20, 45, 70]))]
    edges += [(b, a) for a, b in edges[::3]] + edges[::2]
    want = components_of(range(60), edges)
    got = spark.createDataFrame(edges, "a long, b long").repartition(5)
    rows = [(r.node, r.root) for r in om.components(got).collect()]
    assert sorted(rows) == sorted((x, root) for x, root in want.items() if x != root)


def test_word_pairs_ahead_stay_in_one_row(spark, monkeypatch):
    """Which families are dense is told from one row a text."""
    rng = random.Random(3)
    base = [rng.randrange(1, 2**32) for _ in range(100)]
    words = []
    for i in range(150):
        w = list(base)
        for place in rng.sample(range(100), 14):
            w[place] = rng.randrange(1, 400)
        words.append((i, np.array(w, "<u4")))
    kept = []
    monkeypatch.setattr(om, "stored", lambda df, name, f=om.stored: kept.append((name, f(df, name))) or kept[-1][1])
    large = spark.createDataFrame([(0, 1, i) for i, _ in words], "sketch int, value long, rep long")
    texts = spark.createDataFrame([(i, bytearray(w.tobytes())) for i, w in words], "rep long, words binary")
    om.open_links(large, spark.createDataFrame([], "node long, root long"), texts)
    rows = {}
    for name, df in kept:
        rows.setdefault(name, df.count())
    assert rows["dense"] == 150 and rows["ahead"] == 150


def test_near_of_nothing(spark, empty):
    assert om.classes(empty).collect() == []
    rows = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in om.classes(rows).collect()) == [(1, 1, True), (2, 1, False), (2, 1, False)]
    assert [r.doc_id for r in om.kept_documents(rows).collect()] == [1]


def test_trees_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, qt.N_FEATURES))
    y = ((x[:, 3] > 0.3) & (x[:, 5] < 0.5) | (x[:, 1] > 1.5)).astype(float)
    trees = qt.train(x[:2000], y[:2000])
    assert ((trees.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    one = qt.train(x[:50], np.ones(50)).scores(x[:5])
    assert (one > 0.9).all() and (qt.train(x[:0], y[:0]).scores(x[:2]) >= 0).all()


def test_features_look_at_each_text_alone():
    import pyarrow as pa

    texts = ["a b c a b c\nx\nx", "", "ÄÖ!! ABC ### | 12", " ", "w " * 50]
    together = qt.features(*symbols.utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], qt.features(*symbols.utf8(pa.array([t])))[0])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = {r.doc_id: r for r in qt.judged(docs, labels).collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    truth = [(rows[x.doc_id], x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in truth]) > 0.9


def test_quality_of_odd_rows(spark, frame, empty):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (2, 1), (2, 0)], "doc_id long, quality int")
    assert qt.judged(empty, labels).collect() == []
    got = qt.judged(frame, labels.where("quality = 5")).collect()
    assert len(got) == frame.count() and len({r.score for r in got}) == 1
    kept = qt.kept_documents(frame, spark.createDataFrame([(d, 1) for d in range(50)], "doc_id long, quality int"))
    assert kept.columns == frame.columns and Counter(r.doc_id for r in kept.collect()).most_common(1)[0][1] == 1
