"""Scores against a plain model of dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import kneser_ney, queries


def tokens(text):
    return [*(text or "").encode().lower().split(), None]  # None: the end mark


class Plain:
    def __init__(self, texts):
        self.pairs = Counter(p for t in texts for p in zip(["begin", *t], t))
        self.words = Counter(w for t in texts for w in t)
        self.left = Counter(w for _, w in self.pairs)
        self.follow, self.spare = {}, {}
        for (v, _), c in self.pairs.items():
            self.follow.setdefault(v, []).append(c)
        self.total = sum(self.words.values())
        self.lefts = sum(self.left.values())
        self.d2, self.d1 = self.discounts(self.pairs.values()), self.discounts(self.left.values())
        self.spare1 = sum(self.d1[min(c, 3)] for c in self.left.values())

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        if all(n[k] for k in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            d = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
            if all(0 <= x <= k for k, x in enumerate(d, 1)):
                return [0, *d]
        return [0, 0.5, 1, 1.5]

    def p1(self, w):
        if not self.words:
            return 1
        return (self.left[w] - self.d1[min(self.left[w], 3)] + self.spare1 / (len(self.words) + 1)) / self.lefts

    def p2(self, v, w):
        if v not in self.follow:
            return self.p1(w)
        if v not in self.spare:
            self.spare[v] = sum(self.d2[min(c, 3)] for c in self.follow[v]), sum(self.follow[v])
        (spare, total), c = self.spare[v], self.pairs[v, w]
        return (c - self.d2[min(c, 3)] + spare * self.p1(w)) / total

    def row(self, t):
        total = self.total
        size = total + len(self.words) + 1
        base = sum(math.log10((self.words[w] + 1) / size) for w in t)
        return len(t), sum(self.words[w] > 0 for w in t), base, sum(math.log10(self.p2(v, w)) for v, w in zip(["begin", *t], t))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def compare(got, docs, learned):
    model = Plain([tokens(t) for t in learned])
    assert len(got) == len(docs)
    want = sorted((d if d is not None else -1, *model.row(tokens(t))) for d, t in docs)
    for g, w in zip(sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), want):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9), (g, w)


def test_query_like_plain_model(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_kneser_ney(spark, folder).collect()
    compare(got, docs, [t for d, t in docs if not held(d)])
    assert all(r.held_out == held(r.doc_id) for r in got)
    assert {r.train_tokens for r in got} == {sum(len(tokens(t)) for d, t in docs if not held(d))}
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_odd_rows(spark, frame, corpus, empty, monkeypatch):
    """Small blocks; null, empty and repeated texts, null ids, clashing names, no rows."""
    monkeypatch.setattr(kneser_ney, "COUNTED", 3000)
    monkeypatch.setattr(kneser_ney, "SCORED", 2000)
    more = [(None, "THE the É"), (1000, "the x"), (1000, "the x")]
    docs = frame.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.selectExpr("*", "1 as score", "'a' as shard", "2 as key")
    model = kneser_ney.train(docs)
    compare(kneser_ney.scored(docs, model).collect(), [*corpus, *more], [t for _, t in [*corpus, *more]])
    assert kneser_ney.scored(empty, model).collect() == []
    none = kneser_ney.train(empty)
    assert {(r.n_known, r.base_score, r.score) for r in kneser_ney.scored(docs, none).collect()} == {(0, 0.0, 0.0)}


def test_probabilities_add_up(spark, frame, corpus):
    model = kneser_ney.train(frame)
    words = sorted({w for _, t in corpus for w in tokens(t)[:-1]})
    for before in (b"the", b"spam", b"nowhere"):
        texts = pa.array([(before + b" " + w).decode() for w in [*words, b"unknown-word"]] + [before.decode()])
        block = kneser_ney._Block(texts)
        logs = model.logs(block)[0]
        second = np.append(0, block.ends[:-1]) + 1
        assert (10 ** logs[second]).sum() == pytest.approx(1, rel=1e-9)


def test_other_stores_are_refused():
    with pytest.raises(ValueError, match="mounted"):
        kneser_ney._folder("hdfs://host/folder")


def test_packed_columns():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**64, 500, np.uint64))
    counts = rng.integers(1, 2**40, len(keys))
    back = kneser_ney._unpack(kneser_ney._pack([keys, counts]), 2)
    assert (back[0] == keys).all() and (back[1] == counts).all()
    assert len(np.unique(kneser_ney._mixed(np.arange(100_000, dtype=np.uint64)))) == 100_000
