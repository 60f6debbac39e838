"""Repeated word windows by relative Lempel-Ziv parsing.

A window is ``width`` consecutive words of one document; a word is removed if
a window that covers it also starts in a document with a smaller id.

The reference is the set of all distinct stretches of the corpus (see
``stretch_index``), divided into blocks by their anchor.  Every window belongs
to exactly one block, so a document's words need to be factored only against
the blocks of their anchors, and against each of these they all are:

* a stretch that is equal to one indexed for a smaller document is one factor;
* the others are parsed greedily against the index of their block: at each
  word the longest factor that starts with an indexed window of a smaller
  document is taken.  Windows that cross a factor's end are looked up one by
  one, since another entry of the block may hold them.

Factors of at least ``width`` words are the duplicate spans.  Tasks hold the
blocks of one anchor at a time; anchors with many contents were cut into single
windows beforehand and are settled in the index.

Null texts count as empty, rows without doc_id are left out, an empty table
gives an empty result, and extra columns are ignored.  Rows with the same
doc_id count as one document with several texts.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import symbols as sy
from .common import document_texts, ship_package, stored
from .stretch_index import KIND_COPY, KIND_OPEN, _merge, hot_anchors, per_document, places
from .suffix_dedup import union_of

WIDTH, GRAM = 50, 20


def parse_block(pieces: list[tuple[int, int, np.ndarray]], width: int) -> list[tuple[int, int, int]]:
    """Factors (doc, start, end) of at least ``width`` words.  ``pieces``:
    (document, first word's place, word hashes) of one block, by document."""
    index: dict[int, tuple[int, int]] = {}
    out = []
    for doc, rows in groupby(enumerate(pieces), key=lambda x: x[1][0]):
        mine = []
        for number, (_, start, values) in rows:
            at = np.arange(len(values) - width + 1)
            windows = sy.span_hash(sy.prefix_sums(values), at, at + width).tolist()
            mine.append((number, windows))
            p = 0
            while p < len(windows):
                hit = index.get(windows[p])
                if hit is None:
                    p += 1
                    continue
                other, q = pieces[hit[0]][2], hit[1]
                n = min(len(values) - p, len(other) - q)
                differ = np.flatnonzero(values[p + width : p + n] != other[q + width : q + n])
                length = width + (int(differ[0]) if len(differ) else n - width)
                out.append((doc, start + p, start + p + length))
                for x in range(p + length - width + 1, min(p + length, len(windows))):
                    if windows[x] in index:  # crosses the factor's end
                        out.append((doc, start + x, start + x + width))
                p += length
        for number, windows in mine:  # from here on it serves larger documents
            for q, x in enumerate(windows):
                index.setdefault(x, (number, q))
    return out


def _open_words(docs: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Word hashes of the stretches still to be parsed: (anchor, doc_id, start, words)."""
    wanted = (
        found.where(F.col("kind") == KIND_OPEN)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("anchor", "start", "n_windows")).alias("wanted"))
    )

    def extract(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = sy.utf8(batch.column(1))
            lists = batch.column(2)
            edge, flat = lists.offsets.to_numpy(), lists.values
            anchor, start, n = (flat.field(x).to_numpy() for x in ("anchor", "start", "n_windows"))
            rows = [[], [], [], []]
            for a, b in sy.blocks(offsets):
                h, _, _, first = sy.words(data, offsets[a : b + 1])
                for i in range(a, b):
                    own = h[first[i - a] : first[i - a + 1]]
                    for j in range(edge[i], edge[i + 1]):
                        if start[j] + n[j] - 1 + width <= len(own):
                            rows[0].append(anchor[j])
                            rows[1].append(ids[i])
                            rows[2].append(start[j])
                            rows[3].append(own[start[j] : start[j] + n[j] - 1 + width].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["anchor", "doc_id", "start", "words"],
            )

    joined = docs.join(wanted, "doc_id").select("doc_id", "text", "wanted")
    return joined.mapInArrow(extract, "anchor long, doc_id long, start long, words binary")


def _factored(pieces: DataFrame, width: int) -> DataFrame:
    """Spans of the factors found in each block."""

    def result(factors):
        doc, start, end = (np.array(x, np.int64) for x in zip(*factors))
        doc, start, end = _merge(doc, start, end)
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(end)], ["doc_id", "start", "end"])

    def parse(batches):
        held, last, factors = [], None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for anchor, doc, start, blob in zip(*columns):
                if anchor != last and held:
                    factors += parse_block(held, width)
                    held = []
                last = anchor
                held.append((doc, start, np.frombuffer(blob, np.uint64)))
            if len(factors) > 100_000:
                yield result(factors)
                factors = []
        if held:
            factors += parse_block(held, width)
        if factors:
            yield result(factors)

    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start")
    return dealt.mapInArrow(parse, "doc_id long, start long, end long")


def duplicate_word_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Word spans (doc_id, start, end) covered by a repeated window."""
    ship_package(docs.sparkSession)
    hot = hot_anchors(docs, "word", gram, width)
    found = stored(places(docs, "word", gram, width, strict=True, hot=hot), "word-places")
    copies = found.where(F.col("kind") == KIND_COPY).select(
        "doc_id", "start", (F.col("start") + F.col("n_windows") - 1 + width).alias("end")
    )
    parsed = stored(_factored(_open_words(docs, found, width), width), "word-spans")
    return copies.unionByName(parsed)


def word_removal_report(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256 (kept words joined
    by one space); with ``with_text`` also that text."""
    docs = document_texts(docs)
    spans = per_document(duplicate_word_spans(docs, width))

    def report(batches):
        for batch in batches:
            lists = batch.column(2).to_pylist()
            data, offsets = sy.utf8(batch.column(1))
            rows = [[], [], [], []]
            for i, spans_ in enumerate(lists):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                kept, at = [], 0
                for start, end in union_of(spans_):
                    kept += words[at:start]
                    at = end
                kept = b" ".join(kept + words[at:] if at else words)
                n_kept = len(words) - sum(end - start for start, end in union_of(spans_))
                rows[0].append(len(words))
                rows[1].append(len(words) - n_kept)
                rows[2].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    rows[3].append(kept.decode("utf-8"))
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, t) for r, t in zip(rows, types))][: len(names)], names)

    joined = docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(report, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
