"""Suffix-array and Lempel-Ziv removal against brute force."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import rlz_dedup, stretch_index, suffix_dedup


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=200, deadline=None)
def test_suffix_array_is_sorted(values):
    t = np.array(values, np.int64)
    assert suffix_dedup.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: values[i:])


def brute_bytes(docs, width):
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda x: x[0]):
        b = (text or "").encode()
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            w = b[i : i + width]
            if w in seen:
                covered[i : i + width] = True
            seen.add(w)
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = int((covered & ~np.append(False, covered[:-1])).sum()) if len(b) else 0
        out[doc] = (len(b), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(docs, width):
    words = {d: (t or "").encode().split() for d, t in docs}
    first, out = {}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i : i + width]), d)
    for d, w in words.items():
        covered = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                covered[i : i + width] = True
        out[d] = (len(w), int(covered.sum()), hashlib.sha256(b" ".join(x for x, c in zip(w, covered) if not c)).hexdigest())
    return out


def removed_bytes(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(df).collect()}


def removed_words(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rlz_dedup.word_removal_report(df).collect()}


def test_bytes_match_brute_force(frame, corpus):
    assert removed_bytes(frame) == brute_bytes(corpus, 100)


def test_words_match_brute_force(frame, corpus):
    assert removed_words(frame) == brute_words(corpus, 50)


def test_hot_anchors_and_cut_segments_change_nothing(frame, corpus, monkeypatch):
    # local mode: the stretches are cut in forked workers, so only the driver's part can be patched
    monkeypatch.setattr(stretch_index, "HOT_SHARE", 1e-4)
    assert removed_bytes(frame) == brute_bytes(corpus, 100)
    assert removed_words(frame) == brute_words(corpus, 50)


def test_long_text_is_cut_in_segments(monkeypatch):
    from marketlens.llm import symbols

    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 123, 3000).astype(np.uint8)) * 2
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])

    def windows():
        got = []
        for h, c, row, start, n in stretch_index.cut_texts(data, offsets, "byte", 40, 100, None):
            got += [(s + i) for s, m in zip(start, n) for i in range(m)]
        return sorted(got)

    whole = windows()
    monkeypatch.setattr(symbols, "SEGMENT", 1 << 10)
    assert windows() == whole == list(range(len(text) - 99))


def test_empty_and_null(spark, empty):
    assert removed_bytes(empty) == {} and removed_words(empty) == {}
    some = spark.createDataFrame([(1, None), (2, ""), (None, "x" * 300)], "doc_id long, text string")
    nothing = hashlib.sha256(b"").hexdigest()
    assert removed_bytes(some) == {1: (0, 0, 0, nothing), 2: (0, 0, 0, nothing)}
    assert removed_words(some) == {1: (0, 0, nothing), 2: (0, 0, nothing)}


def test_text_output_keeps_the_rest(spark):
    a = "x" + "".join(chr(97 + i % 26) + str(i) for i in range(80))
    rows = spark.createDataFrame([(1, a), (2, "start " + a + " end")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in suffix_dedup.removal_report(rows, with_text=True).collect()}
    assert got == {1: a, 2: "start  end"}


def test_suffix_array_of_large_values():
    """Three values that don't fit into 63 bits together."""
    rng = np.random.default_rng(3)
    for low, high in ((2**30, 2**30 + 4), (1, 2**30)):
        t = rng.integers(low, high, 200)
        assert suffix_dedup.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_no_large_anchor_reaches_one_task(frame, corpus, monkeypatch):
    """Anchors above BATCH are compared by single windows, with equal results."""
    seen, sort = [], suffix_dedup._sorted_spans

    def watched(strings, width):
        sizes = strings.selectExpr("anchor", "length(bytes) as n").groupBy("anchor").sum("n").collect()
        seen.extend(r[1] for r in sizes)
        return sort(strings, width)

    monkeypatch.setattr(suffix_dedup, "BATCH", 400)
    monkeypatch.setattr(suffix_dedup, "_sorted_spans", watched)
    assert removed_bytes(frame) == brute_bytes(corpus, 100)
    assert seen and max(seen) <= 400


class _Tasks:
    """Stands in for a DataFrame and keeps what its tasks are to run."""

    sparkSession = type("Session", (), {"conf": {"spark.sql.shuffle.partitions": "12"}})

    def __init__(self):
        self.functions = []

    def __getattr__(self, name):
        return lambda *args, **options: self

    def mapInArrow(self, function, schema):
        self.functions.append(function)
        return self


def test_cutting_a_large_part_takes_bounded_memory_and_sends_even_buckets():
    """Texts of 12 MB without repeats and copies of 2 MB in one task: small
    record batches, and no bucket with much more than its share."""
    tasks, rng = _Tasks(), np.random.default_rng(4)
    stretch_index.places(tasks, "byte", 40, 100, strict=False)
    cut, _ = tasks.functions
    copied = ["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(250)]

    def batches(n):
        for i in range(n):
            texts = copied if i % 7 == 6 else [bytes(x).decode() for x in rng.integers(97, 123, (250, 2000), np.uint8)]
            yield pa.RecordBatch.from_arrays([pa.array(range(250 * i, 250 * i + 250)), pa.array(texts)], ["doc_id", "text"])

    list(cut(batches(1)))  # tables of powers are made once
    sizes, buckets = [], np.zeros(96)
    tracemalloc.start()
    for batch in cut(batches(28)):
        sizes.append(batch.nbytes)
        for bucket, kind, blob in zip(*(x.to_pylist() for x in batch.columns)):
            if kind == stretch_index.KIND_OPEN:
                buckets[bucket] += len(blob)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    assert max(sizes) < 3 << 20
    assert buckets.max() < 2 * buckets.mean()
