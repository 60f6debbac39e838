"""Token files, packing and byte-level BPE against the libraries themselves."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketlens.llm import bpe_model, packing, piece_cache, token_store

ODD = ["a  b", "\t x\n\n y \u00a0z", "tab\t  b!\x1c?\x1f .", "don't <|endoftext|> Σας ΣΑΣ", "é" * 50, " " * 300, "\u3000a\u2003 b\x85c", "ﬁ İ ß", "日本語 テスト\r\n"]


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def u4(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_encode_like_whole_texts(name, corpus):
    texts = ODD + [t or "" for _, t in corpus]
    encode = library(name)
    assert piece_cache.PieceEncoder(P.path(name))(texts) == [u4(encode(t)) for t in texts]


def test_known_pieces_are_looked_up_once():
    """Only texts with new pieces are gone through piece by piece; a full cache
    and repeated new pieces give the same ids."""
    encode, e = library("word_bpe_49k.json"), piece_cache.PieceEncoder(P.path("word_bpe_49k.json"))
    texts = ["ab cd ab", "", "ab zq9 zq9", "cd"]
    for _ in range(2):
        assert e(texts) == [u4(encode(t)) for t in texts]
        assert e.cache.missed == []
    assert e.cache["ab"] is not None and e.cache["never seen"] is None and e.cache.missed == ["never seen"]


@given(st.text(alphabet=" \t\n\r\x02\x0b\x1c\x85\xa0\u2003abA1'sé!?Σ.,*_²½\u0301", max_size=30))
@settings(max_examples=400, deadline=None)
def test_odd_spaces(text):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        assert piece_cache.encoder(P.path(name))([text]) == [u4(library_once(name)(text))]


_libraries = {}


def library_once(name):
    return _libraries.setdefault(name, library(name))


def tiktoken_once():
    import base64

    import tiktoken

    if "tik" not in _libraries:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
        _libraries["tik"] = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _libraries["tik"]


@given(st.text(max_size=40))
@settings(max_examples=300, deadline=None)
def test_bpe_like_tiktoken(text):
    bpe = bpe_model.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    (ids,) = bpe.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == tiktoken_once().encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_bpe_report(frame, corpus, empty):
    got = {r.doc_id: tuple(r)[1:] for r in bpe_model.encoded(frame, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    want = {}
    for d, t in corpus:
        ids = u4(tiktoken_once().encode_ordinary(t or ""))
        want[d] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert got == want
    assert bpe_model.encoded(empty, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []


def test_token_files_round_trip(spark, frame, corpus, empty):
    path = P.path("word_bpe_49k.json")
    where = token_store.scratch_path(spark, "t")
    got = {r.doc_id: tuple(r)[1:] for r in token_store.token_report(frame, path, 2, where).collect()}
    encode, at, want = library("word_bpe_49k.json"), 0, {}
    for d, t in sorted(corpus, key=lambda x: x[0]):
        ids = encode(t or "") + [2]
        want[d] = (at, len(ids), zlib.crc32(u4(ids)))
        at += len(ids)
    assert got == want
    doc, text = corpus[17]
    assert token_store.read_document(spark, where, doc) == [encode(text or "") + [2]]
    assert token_store.read_document(spark, where, 10**12) == []
    assert token_store.token_report(empty, path, 2).collect() == []


def test_token_files_repeated_ids(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (0, "c c"), (None, "z")], "doc_id long, text string")
    got = sorted(tuple(r)[:3] for r in token_store.token_report(rows, P.path("word_bpe_49k.json"), 2).collect())
    assert [r[0] for r in got] == [0, 1, 1, 1] and [r[1] for r in got] == [0, 3, 4, 6]


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
@settings(max_examples=200, deadline=None)
def test_histogram_packs_every_piece_once(histogram):
    patterns = packing.pack_histogram(histogram, 64)
    counts = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 64 and n > 0
        for length in pattern:
            counts[length] += n
    assert counts == Counter(histogram)
    assert len(patterns) <= 2 * 64 + len(histogram)


def check_packing(rows, docs, encode, size):
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, t in docs:
        ids = encode(t or "") + [0]
        pieces = sorted(by_doc[d], key=lambda r: r.start)
        assert sum(p.length for p in pieces) == len(ids)
        at = 0
        for p in pieces:
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(u4(ids[at : at + p.length]))
            at += p.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return sequences


def test_packing(frame, corpus, empty):
    path, encode = P.path("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    sequences = check_packing(packing.packed(frame, path, 0).collect(), corpus, encode, 1024)
    total = sum(length for parts in sequences.values() for _, length in parts)
    assert total / (1024 * len(sequences)) > 0.95
    check_packing(packing.packed(frame, path, 0, size=16).collect(), corpus, encode, 16)
    assert packing.packed(empty, path, 0).collect() == []


def test_packing_repeated_rows_and_ids(spark):
    rows = spark.createDataFrame([(1, "same text")] * 3 + [(2, None)], "doc_id long, text string")
    got = packing.packed(rows, P.path("byte_bpe_50k.json"), 0, with_ids=True).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 1, 2]
    assert len({(r.sequence_id, r.offset) for r in got}) == 4 and all(len(r.ids) == 4 * r.length for r in got)
