"""Near words and their forms against comparisons of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import queries, spelling


def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain_rows(counts):
    words, rows = list(counts), {}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    found = {w: [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(found[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, counts[w], len(found[w]), counts[form[w]] if form[w] else None)
    return rows


def plain_counts(docs):
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def rows_of(frame):
    got = frame.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@given(st.sets(st.text("abé", min_size=3, max_size=3)), st.sets(st.text("abé", min_size=4, max_size=4)))
@settings(max_examples=200, deadline=None)
def test_composition(short, long):
    for at_end in (True, False):
        got = [tuple(sorted(p)) for p in spelling.one_edit_pairs(list(short), list(long), 3, at_end)]
        want = {tuple(sorted((x, y))) for x in short for y in [*short, *long] if near(x, y)}
        if not at_end:
            want = {p for p in want if not (len(p[0]) != len(p[1]) and min(p, key=len) == max(p, key=len)[:3])}
        assert sorted(got) == sorted(want)


def test_minimal_acceptor():
    machine = spelling.Acceptor()
    root = machine.add([a + b + c for a in "abc" for b in "de" for c in "fgh"], 3)
    assert len(machine.arcs) == 4 and machine.add([], 3) is None and len(set(machine.both(root, root))) == 18


def test_long_words_and_large_groups(spark):
    """Groups divided many times over, long shared prefixes and suffixes, ties."""
    rng = random.Random(8)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(300)}
    words |= {"a" * k for k in range(5, 40)} | {"x" * 600 + w + "y" * 700 for w in ("", "q", "r", "qr", "yq")} | {"prefix" + a + b + "é" for a in "abcdefgh" for b in "stuvwxyz"}
    counts = {w: rng.choice([1, 2, 3, 6, 50]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    for bound in (3, 2000):
        assert rows_of(spelling.variants(table, bound=bound)) == plain_rows(counts)


def test_chains_of_forms(spark):
    counts = {"a" * (5 + k): 3 * 2**k for k in range(20)}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == plain_rows(counts) and {r[1] for r in got.values()} == {"a" * 24}


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = plain_rows(plain_counts(docs))
    assert rows_of(queries.op13_spelling_variants(spark, folder)) == want
    assert sum(r[3] > 0 for r in want.values()) > 20


def test_odd_rows(spark, empty):
    rows = [(1, None), (1, ""), (1, "Größe größe GRÖSSE gröBe ××××× 12345 ÉÉÉÉÉ ééééé"), (None, "größe grösse größer"), (1, "größe grösse größer")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 as word", "2 as n", "'k' as key")
    got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert got == {"größe": 4, "grÖsse": 1, "gröbe": 1, "×" * 5: 1, "É" * 5: 1, "é" * 5: 1, "grösse": 2, "größer": 2}
    assert rows_of(spelling.variants(spelling.word_counts(docs)))["größer"] == ("größe", "größe", 2, 1, 4)
    assert spelling.variant_report(empty).collect() == []
