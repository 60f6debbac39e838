"""Runs and common extensions against plain comparisons."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import queries, run_grammar


def plain_runs(words):
    """(start, length, period) of every run, from the stretches of each period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and (length := j - i + q) >= max(6, 4 * q):
                found.setdefault((i, length), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def plain_row(words):
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(text.encode()), sha(plain_collapsed(words, runs)))


@given(st.lists(st.lists(st.integers(0, 3), max_size=60), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_of_several_sequences(parts):
    words = np.array([w for p in parts for w in p], np.int64)
    start, length, period = run_grammar.sequence_runs(words, np.array([len(p) for p in parts]))
    want, at = [], 0
    for p in parts:
        want += [(at + s, n, q) for s, n, q in plain_runs(p)]
        at += len(p)
    assert sorted(zip(start.tolist(), length.tolist(), period.tolist())) == sorted(want)


@given(st.lists(st.integers(0, 2), min_size=2, max_size=80), st.data())
@settings(max_examples=200, deadline=None)
def test_common_extensions(words, data):
    n = len(words)
    s = np.array([9, *words, 10], np.int64)
    grammar = run_grammar.RunGrammar(s, 9)
    pairs = [(i, j) for i in range(1, n + 1) for j in range(1, n + 1) if i != j]
    i, j = map(np.array, zip(*pairs))
    ahead, back = grammar.common(i, j), grammar.common(i, j, backward=True)
    for a, b, x, y in zip(i.tolist(), j.tolist(), ahead.tolist(), back.tolist()):
        assert x == next(k for k in range(n + 2) if s[a + k] != s[b + k])
        assert y == next(k for k in range(n + 2) if s[a - k] != s[b - k])


def test_long_runs_and_high_powers():
    rng = random.Random(3)
    for base in ([7], [1, 2], [rng.randrange(9) for _ in range(300)], [1, 1, 2, 1, 1, 3]):
        words = [rng.randrange(50) for _ in range(40)] + base * (5000 // len(base)) + base[: len(base) // 2] + [60, 61]
        start, length, period = run_grammar.sequence_runs(np.array(words), np.array([len(words)]))
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words)


def test_candidates_in_several_portions(monkeypatch):
    monkeypatch.setattr(run_grammar, "_CANDIDATES", 10)
    words = [1, 2, 3] * 20 + [4] * 9 + [5, 6] * 11
    start, length, period = run_grammar.sequence_runs(np.array(words), np.array([len(words)]))
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words)


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_recompression_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, text in docs:
        assert got[d] == plain_row(planted(d, (text or "").encode().split())), d
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_odd_rows(spark, frame, corpus, empty):
    """Null and empty texts, null and repeated ids, clashing columns, no rows."""
    got = {}
    for r in run_grammar.document_runs(frame.withColumn("runs", frame.n_windows).withColumn("collapsed", frame.anchor)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    want = {}
    for d, text in corpus:
        words = (text or "").encode().split()
        runs = plain_runs(words)
        want.setdefault(d, []).append((len(words), runs, plain_collapsed(words, runs).decode()))
    assert {d: sorted(x, key=str) for d, x in got.items()} == {d: sorted(x, key=str) for d, x in want.items()}
    rows = [(None, "a " * 7), (1, "a " * 7), (1, "a " * 7), (1, None), (2, "\x0b\t\r"), (3, "a\u00a0a " * 6)]
    odd = spark.createDataFrame(rows, "doc_id int, text string")
    report = run_grammar.run_report(odd).select("doc_id", "n_runs", "length").collect()
    assert Counter(map(tuple, report)) == Counter([(None, 1, 7), (1, 1, 7), (1, 1, 7), (1, 0, None), (2, 0, None), (3, 1, 6)])
    assert run_grammar.run_report(empty).collect() == []
