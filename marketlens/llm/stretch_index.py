"""Distributed index of stretches (see ``symbols``): which stretches repeat.

One pass over the texts cuts every document into stretches and sends, for each,
two hashes and its place to the bucket of its anchor.  Stretches with equal
anchors meet there:

* stretches of equal content form a class; all but its first member (smallest
  document, then smallest start) repeat that member (``KIND_COPY``);
* where classes of unequal content share an anchor, some of their windows may
  still be equal.  The first member of each class is passed on
  (``KIND_OPEN``); the operators compare these by their text.

Every pair of equal windows has equal anchors, so nothing else can repeat.

Hot anchors.  Copies inside one task are settled there, before the shuffle, so
a passage in a third of all documents sends one row a task and class.  Anchors
with many different surroundings (the edges of such a passage) are found on a
bounded sample of documents and cut up into single windows, which spread over
all buckets and settle in the same way.  The sample steers how work is dealt
out; the result is the same without it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import symbols as sy
from .common import partitions

KIND_COPY, KIND_OPEN = 0, 1
PLACES = "doc_id long, kind int, start long, n_windows int, anchor long"
_FLUSH = 300_000  # stretches that a task holds before it settles and sends them
_SENT = 1 << 20  # bytes to send that go into one record batch, but for its last row
_COPIES_SENT = 50_000  # spans of copies sent as one row
_BLOCK = 1 << 16  # bytes of short texts hashed at a time
HOT_SAMPLE_DOCS, HOT_SHARE = 2000, 0.02


def cut_texts(data: np.ndarray, offsets: np.ndarray, unit: str, k: int, w: int, hot: np.ndarray | None):
    """Stretches of a batch of texts: (anchor, content, row, start, n_windows)
    with starts counted in symbols from the text's begin."""
    for a, b in sy.blocks(offsets, _BLOCK):
        part = offsets[a : b + 1]
        if unit == "byte":
            values = sy.byte_values(data[part[0] : part[-1]])
            first = part - part[0]
        else:
            values, _, _, first = sy.words(data, part)
        if b - a > 1 or len(values) <= sy.SEGMENT:
            h, c, row, start, n = sy.stretches(values, first[:-1], first[1:], k, w, hot)
            yield h, c, row + a, start - first[row], n
            continue
        step = sy.SEGMENT - w + 1
        for lo in range(0, max(1, len(values) - w + 1), step):
            piece = values[lo : lo + sy.SEGMENT]
            h, c, row, start, n = sy.stretches(piece, np.array([0]), np.array([len(piece)]), k, w, hot)
            yield h, c, row + a, start + lo, n


def _classes(h, c, doc, start):
    """Order by (anchor, content, document, start), and marks of new anchors
    and new classes in that order.  Only repeated anchors are sorted finely."""
    order = np.argsort(h)
    hs = h[order]
    same = np.zeros(len(hs), bool)
    same[1:] = hs[1:] == hs[:-1]
    many = same.copy()
    many[:-1] |= same[1:]
    rows = order[many]
    if len(rows):
        order[many] = rows[np.lexsort((start[rows], doc[rows], c[rows], h[rows]))]
    cs = c[order]
    new_class = ~same
    new_class[1:] |= cs[1:] != cs[:-1]
    return order, ~same, new_class


def _copies(new_class, doc_sorted, strict):
    """Marks of members that repeat their class's first member; with ``strict``
    only those in a document with a larger id than the first member's."""
    if not strict:
        return ~new_class
    first = np.maximum.accumulate(np.where(new_class, np.arange(len(new_class)), 0))
    return doc_sorted > doc_sorted[first]


def _split32(x: np.ndarray) -> bytes:
    x = x.astype(np.int64)
    return (x & 0xFFFFFFFF).astype("<u4").tobytes() + (x >> 32).astype("<i4").tobytes()


def _pack(h, c, doc, start, n) -> bytes:
    return h.tobytes() + c.tobytes() + _split32(doc) + _split32(start) + n.astype("<i4").tobytes()


def _unpack(blob: bytes):
    m = len(blob) // 36
    u = lambda at: np.frombuffer(blob, "<u4", m, at).astype(np.int64)
    i = lambda at: np.frombuffer(blob, "<i4", m, at).astype(np.int64)
    h, c = np.frombuffer(blob, "<u8", m), np.frombuffer(blob, "<u8", m, 8 * m)
    return h, c, u(16 * m) | i(20 * m) << 32, u(24 * m) | i(28 * m) << 32, i(32 * m)


def _merge(doc, start, end):
    """Unions of spans that touch or overlap, for spans of many documents."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    group = np.cumsum(np.append(True, doc[1:] != doc[:-1])) - 1
    wide = int(end.max()) + 2
    reach = np.maximum.accumulate(end + group * wide)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + group[1:] * wide > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[last] - group[last] * wide


def hot_anchors(docs: DataFrame, unit: str, k: int, w: int) -> np.ndarray:
    """Anchors that occur with unequal contents in at least HOT_SHARE of a
    sample of HOT_SAMPLE_DOCS documents.  A share bounds their number: at most
    (stretches of the mean text) / HOT_SHARE, a few thousand."""

    def pairs(batches):
        for batch in batches:
            data, offsets = sy.utf8(batch.column(0))
            for h, c, _, _, _ in cut_texts(data, offsets, unit, k, w, None):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64))], ["anchor", "content"])

    sample = docs.select("text").limit(HOT_SAMPLE_DOCS)
    rows = (
        sample.mapInArrow(pairs, "anchor long, content long")
        .groupBy("anchor")
        .agg(F.countDistinct("content").alias("n"))
        .where(F.col("n") >= HOT_SHARE * HOT_SAMPLE_DOCS)
        .select("anchor")
        .collect()
    )
    return np.array([r.anchor for r in rows], np.int64).view(np.uint64)


def places(docs: DataFrame, unit: str, k: int, w: int, strict: bool, hot: np.ndarray | None = None) -> DataFrame:
    """Repeated stretches of ``docs`` (doc_id, text): rows of PLACES.

    KIND_COPY rows are spans of windows that repeat an earlier one (with
    ``strict``: one of a smaller document), merged where they touch; KIND_OPEN
    rows are first members of classes that share an anchor with another class."""
    n_buckets = 8 * partitions(docs.sparkSession)

    def settle(held):
        """Copies among the stretches held, and what is left.  ``held`` is emptied
        and columns are replaced one by one, so that they are in memory once."""
        columns = [list(x) for x in zip(*held)]
        held.clear()
        for i in range(5):
            columns[i] = np.concatenate(columns[i])
        order, _, new_class = _classes(*columns[:4])
        for i in range(5):
            columns[i] = columns[i][order]
        copy = _copies(new_class, columns[2], strict)
        done = [x[copy] for x in columns[2:]]
        for i in range(5):
            columns[i] = columns[i][~copy]
        return done, columns

    def spans(doc, start, n):
        doc, start, end = _merge(doc, start, start + n)
        return doc, start, end - start

    def cut(batches):
        held, size = [], 0

        def flush():
            done, left = settle(held)
            doc, start, n = spans(*done)
            for at in range(0, len(doc), _COPIES_SENT):
                part = slice(at, at + _COPIES_SENT)
                blob = _split32(doc[part]) + _split32(start[part]) + n[part].astype("<i4").tobytes()
                yield int(doc[at]) % n_buckets, KIND_COPY, blob
            h = left[0]
            bucket = ((h >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
            for i in np.flatnonzero(np.diff(edges)):
                yield int(i), KIND_OPEN, _pack(*(x[edges[i] : edges[i + 1]] for x in left))

        def out(rows):
            b, kind, blob = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], ["bucket", "kind", "blob"]
            )

        def sent():
            rows, n_bytes = [], 0
            for row in flush():
                rows.append(row)
                n_bytes += len(row[2])
                if n_bytes >= _SENT:
                    yield out(rows)
                    rows, n_bytes = [], 0
            if rows:
                yield out(rows)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = sy.utf8(batch.column(1))
            for h, c, row, start, n in cut_texts(data, offsets, unit, k, w, hot):
                # anchors are smallest hashes: mixed again, they fall evenly into the buckets
                held.append((sy.mix(h), c, ids[row], start, n.astype(np.int32)))
                size += len(h)
                if size >= _FLUSH:
                    yield from sent()
                    size = 0
        if size:
            yield from sent()

    def result(doc, kind, start, n, anchor):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(np.full(len(doc), kind), pa.int32()), pa.array(start, pa.int64()),
             pa.array(n, pa.int32()), pa.array(anchor, pa.int64())],
            ["doc_id", "kind", "start", "n_windows", "anchor"],
        )

    def meet_bucket(blobs):
        h, c, doc, start, n = (np.concatenate(x) for x in zip(*map(_unpack, blobs)))
        order, new_anchor, new_class = _classes(h, c, doc, start)
        group = np.cumsum(new_anchor) - 1
        shared = np.bincount(group, weights=new_class)[group] > 1
        doc, start, n = doc[order], start[order], n[order]
        copy = _copies(new_class, doc, strict)
        d, s, m = spans(doc[copy], start[copy], n[copy])
        yield result(d, KIND_COPY, s, m, np.zeros(len(d), np.int64))
        left = shared & ~copy
        yield result(doc[left], KIND_OPEN, start[left], n[left], h[order][left].view(np.int64))

    def meet(batches):
        bucket, blobs = None, []
        for batch in batches:
            for b, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                blob = blob.as_buffer().to_pybytes()
                if kind == KIND_COPY:
                    m = len(blob) // 20
                    u = lambda at: np.frombuffer(blob, "<u4", m, at).astype(np.int64)  # noqa: E731, B023
                    i = lambda at: np.frombuffer(blob, "<i4", m, at).astype(np.int64)  # noqa: E731, B023
                    yield result(u(0) | i(4 * m) << 32, KIND_COPY, u(8 * m) | i(12 * m) << 32, i(16 * m), np.zeros(m, np.int64))
                    continue
                if b != bucket and blobs:
                    yield from meet_bucket(blobs)
                    blobs = []
                bucket = b
                blobs.append(blob)
        if blobs:
            yield from meet_bucket(blobs)

    dealt = docs.select("doc_id", "text").mapInArrow(cut, "bucket int, kind int, blob binary")
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, PLACES)


def per_document(rows: DataFrame) -> DataFrame:
    """One row per document with its spans [start, end) as a list."""
    return rows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
