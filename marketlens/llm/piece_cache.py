"""Encoding with the tokenizers library, each distinct piece of text once a worker.

Texts are cut where the pre-tokenizers used here always cut: between a
character that is no white space in any definition and a blank, tab or line
break, and between a letter or digit and a mark of punctuation.  The ids of a
text are those of its pieces, one after another.

New pieces are encoded many at a time, joined by a separator that always makes
one id of its own; pieces that could blend with it are encoded one by one.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: one line break between other characters, or a white-space run, then a word before a cut, else the rest up to the next white space
PIECE = re.compile(r"(?<=\S)\n(?=\S)|\s*[^\W_]+(?=[\s,.;:!?|*$%&#])|\s*\S+(?:[^\S \t\n\r]\s*\S*)*|\s+")
#: the same without white space before a piece
_FOLDED = re.compile(r"[^\W_]+(?=[\s,.;:!?|*$%&#])|[^ \t\n\r]+")
_PLAIN = re.compile(r" ?\S+")
_CACHE_ENTRIES = 800_000
_TOGETHER = 2000
_encoders: dict[str, "PieceEncoder"] = {}


class _Cache(dict):
    """Pieces and their ids; a lookup of another piece gives None and notes it."""

    def __init__(self):
        self.missed: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.missed.append(piece)


class PieceEncoder:
    """Text to ids as little-endian unsigned 32-bit bytes.  The cache keeps
    the first pieces seen, at most ``_CACHE_ENTRIES`` of them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cache = _Cache()
        # with a normalizer that drops case and white space, ASCII pieces differ by neither
        self.folds = self._ids(["\n Ab"]) == self._ids(["ab"])
        self.separator = " \x02 " if self.folds else "\n"
        (alone,) = self._ids([self.separator])
        self.separator_id = alone[0] if len(alone) == 1 else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, pieces: list[str]) -> list[bytes] | None:
        """Ids of pieces that are joined into one text, None if the separators
        don't come out one for one."""
        ids = np.array(self._ids([self.separator.join(pieces)])[0], "<u4")
        cuts = np.flatnonzero(ids == self.separator_id)
        if len(cuts) != len(pieces) - 1:
            return None
        raw, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
        begin = [0, *(4 * cuts + 4).tolist()]
        return [raw[a:b] for a, b in zip(begin, ends)]

    def _encode(self, pieces: list[str]) -> dict[str, bytes]:
        plain, odd = [], []
        for p in pieces:
            joined = self.separator_id is not None and "\x02" not in p and _PLAIN.fullmatch(p)
            (plain if joined else odd).append(p)
        out = {}
        for at in range(0, len(plain), _TOGETHER):
            part = plain[at : at + _TOGETHER]
            ids = self._together(part)
            if ids is None:
                odd += part
            else:
                out.update(zip(part, ids))
        for p, ids in zip(odd, self._ids(odd)):
            out[p] = np.array(ids, "<u4").tobytes()
        return out

    def _pieces(self, text: str) -> list[str]:
        if not self.folds:
            return PIECE.findall(text)
        try:
            text.encode("latin-1")  # here lower() is the same in any library, and nothing composes
        except UnicodeEncodeError:
            return [p.strip(" \t\n\r") for p in PIECE.findall(text)]
        return _FOLDED.findall(text.lower())

    def __call__(self, texts: list[str]) -> list[bytes]:
        cache, missed = self.cache, self.cache.missed
        found, open_ = [], []
        for i, text in enumerate(texts):
            ps, before = self._pieces(text), len(missed)
            ids = list(map(cache.__getitem__, ps))
            if len(missed) > before:
                open_.append((i, ps))
                found.append(ids)
            else:
                found.append(b"".join(ids))
        if open_:
            fresh = self._encode(list(dict.fromkeys(missed)))
            missed.clear()
            for i, ps in open_:
                found[i] = b"".join([fresh[p] if x is None else x for p, x in zip(ps, found[i])])
            if len(cache) + len(fresh) <= _CACHE_ENTRIES:
                cache.update(fresh)
        return found


def encoder(path: str) -> PieceEncoder:
    """One encoder a Python worker and file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def text_blocks(column, limit: int = 1 << 21):
    """Row ranges of an Arrow text column with about ``limit`` bytes each."""
    from . import symbols as sy

    _, offsets = sy.utf8(column)
    yield from sy.blocks(offsets, limit)
