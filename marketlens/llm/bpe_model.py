"""Byte-level BPE through a sentencepiece model written from the vocabulary.

``build_model`` serialises a sentencepiece BPE model straight from a rank file:
one piece a rank, its bytes mapped to printable characters (the usual map of
byte-level vocabularies), the score minus the rank, identity normalisation, no
dummy prefix.  sentencepiece then merges, like tiktoken, the neighbours whose
union has the lowest rank.  Texts are divided by the vocabulary's pattern and
every match is encoded by itself; decoding maps pieces back to bytes.

Null texts count as empty; rows without doc_id are left out; an empty table
gives no rows; extra columns are ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import document_texts, ship_package
from .piece_cache import PIECE, text_blocks

_CACHE_ENTRIES = 600_000
_codecs: dict[str, "ByteBpe"] = {}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable in
    Latin-1, else the next character from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank (ranks must run from 0 without gaps)."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: length-delimited, varint or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def build_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece ModelProto; piece id is rank + 1 (0: unknown)."""
    chars = byte_characters()
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)]
    for rank, token in enumerate(tokens):
        text = "".join(chars[b] for b in token)
        pieces.append(_field(1, text.encode()) + _field(2, float(-rank)) + _field(3, 1))
    trainer = _field(3, 2) + _field(4, len(pieces))  # model_type BPE, vocab_size
    trainer += _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)  # no bos, eos, pad
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=build_model(self.tokens))
        self.pattern = regex.compile(pattern)
        self.chars = {b: c for b, c in enumerate(byte_characters())}
        self.bytes = {ord(c): b for b, c in enumerate(byte_characters())}
        self.cache: dict[str, bytes] = {}
        self.pieces = [
            self.processor.id_to_piece(i + 1).translate(self.bytes).encode("latin-1") for i in range(len(self.tokens))
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers.  Texts are first cut
        where the pattern always cuts (see ``piece_cache``); each distinct
        part is matched against the pattern and encoded once."""
        cache = self.cache
        parts = [PIECE.findall(t) for t in texts]
        new = list({p for ps in parts for p in ps if p not in cache})
        fresh = {}
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            matches = [self.pattern.findall(p) for p in some]
            flat = [m.encode().decode("latin-1").translate(self.chars) for ms in matches for m in ms]
            ids = iter(self.processor.encode(flat, num_threads=1))
            for part, ms in zip(some, matches):
                fresh[part] = (np.array([i for _ in ms for i in next(ids)], np.int64) - 1).astype("<u4").tobytes()
        if len(cache) + len(fresh) <= _CACHE_ENTRIES:
            cache.update(fresh)
            get = cache.__getitem__
        else:
            get = lambda p: cache[p] if p in cache else fresh[p]
        return [b"".join(map(get, ps)) for ps in parts]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids, by the inverse of the piece mapping."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> ByteBpe:
    """One codec a Python worker and file."""
    key = f"{path}\n{pattern}"
    if key not in _codecs:
        _codecs[key] = ByteBpe(path, pattern)
    return _codecs[key]


def encoded(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with ``with_ids`` also ids
    (little-endian unsigned 32-bit) and decoded (text)."""
    ship_package(docs.sparkSession)

    def run(batches):
        bpe = codec(ranks_path, pattern)
        for batch in batches:
            for a, b in text_blocks(batch.column(1)):
                ids = bpe.encode(batch.column(1)[a:b].to_pylist())
                back = [bpe.decode(x) for x in ids]
                columns = [
                    batch.column(0)[a:b],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                    pa.array(ids, pa.binary()),
                    pa.array([x.decode() for x in back], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
                keep = 6 if with_ids else 4
                yield pa.RecordBatch.from_arrays(columns[:keep], names[:keep])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids
    return document_texts(docs).mapInArrow(run, schema)
