"""Exact substring removal by suffix arrays (difference-cover sorting).

``duplicate_spans`` finds every byte covered by a ``width``-byte string that
also starts earlier (smaller doc_id, or same document and smaller start);
matches never cross documents.

1. ``stretch_index.places`` cuts all texts into stretches.  Equal stretches are
   stored once: later members are copies as they stand.  Stretches whose anchor
   occurs once cannot hold a repeated string and need no sorting.
2. The suffixes left are dealt out by anchor; two suffixes that share ``width``
   bytes always meet in one partition.  Each partition sorts its suffixes with
   the difference cover {1, 2} modulo 3: sort the sampled triples, recurse on
   their names, merge in the remaining suffixes by their first symbol and the
   rank of the next.  Then prefixes of neighbouring suffixes are compared.

Partitions are sorted in batches of whole anchors of about ``BATCH`` bytes.
Anchors with many contents in a sample were cut into single windows beforehand.
Of all others the bytes still to be compared are counted; those of an anchor
with more than ``BATCH`` don't come here but are compared window by window, by
128-bit hashes, spread over all tasks.  So a task's memory is bounded by
``BATCH``, whatever the sample missed.

Null texts count as empty, rows without doc_id are left out, an empty table
gives an empty result, and extra columns are ignored.  If a doc_id occurs in
several rows, the rows are separate texts; which of them is the earlier one is
not defined, and the removal applies to all rows with this id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import symbols as sy
from .common import document_texts, partitions, ship_package, stored
from .stretch_index import KIND_COPY, KIND_OPEN, _merge, hot_anchors, per_document, places

WIDTH, GRAM = 100, 40
BATCH = 1 << 18


def _triples(a: np.ndarray, b: np.ndarray, c: np.ndarray, bits: int) -> np.ndarray:
    """Codes in the order of the triples, of values below 2**bits; where three
    don't fit into 63 bits, the last two are replaced by their rank."""
    if 3 * bits <= 63:
        return (a << 2 * bits) | (b << bits) | c
    if bits > 31:
        raise ValueError("suffix_array: lengths and values must be below 2**31 - 3")
    low = np.unique((b << bits) | c, return_inverse=True)[1]
    return (a << len(low).bit_length()) | low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of an integer sequence (values >= 1), difference cover
    modulo 3, all steps vectorised.  Lengths and values below 2**31 - 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.zeros(n + 3, np.int64)
    t[:n] = text
    bits = max(int(t.max()).bit_length(), (n + 3).bit_length())
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    n1 = len(range(1, n + (n % 3 == 1), 3))
    triple = _triples(t[sample], t[sample + 1], t[sample + 2], bits)
    order = np.argsort(triple, kind="stable")
    new = np.ones(len(order), np.int64)
    new[1:] = triple[order][1:] != triple[order][:-1]
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new)
    if int(new.sum()) < len(order):
        order = suffix_array(name)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    rest = np.arange(0, n, 3)
    rest_key = (t[rest] << bits) | rank[rest + 1]
    by = np.argsort(rest_key, kind="stable")
    rest, rest_key = rest[by], rest_key[by]
    # how many sampled suffixes of either residue precede each remaining one
    sorted_sample = sample[order]
    one = sorted_sample[sorted_sample % 3 == 1]
    two = sorted_sample[sorted_sample % 3 == 2]
    before = np.searchsorted((t[one] << bits) | rank[one + 1], rest_key)
    both = np.concatenate([two, rest])
    key2 = _triples(t[both], t[both + 1], rank[both + 2], bits)
    before = before + np.searchsorted(key2[: len(two)], key2[len(two) :])
    out = np.full(len(sample) + len(rest), -1, np.int64)
    out[before + np.arange(len(rest))] = rest
    out[out < 0] = sorted_sample
    return out[out < n]


def repeated_windows(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of ``width`` bytes in the strings (given in the order
    in which they start in the corpus): (string index, offset) of each window
    that is equal to an earlier one."""
    lengths = np.array([len(x) for x in strings], np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1
    text = np.ones(int((lengths + 1).sum()), np.int64)
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    text[:] = raw.astype(np.int64) + 2
    text[begin + lengths] = 1
    sa = suffix_array(text)
    which = np.searchsorted(begin, sa, "right") - 1
    offset = sa - begin[which]
    full = offset + width <= lengths[which]
    sa, which, offset = sa[full], which[full], offset[full]
    same = np.zeros(len(sa), bool)
    for at in range(1, len(sa), 1 << 14):  # compare neighbours' prefixes
        stop = min(len(sa), at + (1 << 14))
        span = np.lib.stride_tricks.sliding_window_view(raw, width)
        same[at:stop] = (span[sa[at:stop]] == span[sa[at - 1 : stop - 1]]).all(axis=1)
    run = np.cumsum(~same) - 1
    order = np.lexsort((sa, run))
    first = np.zeros(len(sa), bool)
    first[0 : 1 if len(sa) else 0] = True
    first[1:] = run[order][1:] != run[order][:-1]
    later = order[~first]
    return which[later], offset[later]


def _open_strings(docs: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """The bytes of the stretches still to be compared: (anchor, doc_id, start, bytes)."""
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
            edge = lists.offsets.to_numpy()
            flat = lists.values
            anchor = flat.field("anchor").to_numpy()
            start = flat.field("start").to_numpy()
            n = flat.field("n_windows").to_numpy()
            rows = [[], [], [], []]
            for i, doc in enumerate(ids):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                for j in range(edge[i], edge[i + 1]):
                    if start[j] + n[j] - 1 + width <= len(text):
                        rows[0].append(anchor[j])
                        rows[1].append(doc)
                        rows[2].append(start[j])
                        rows[3].append(text[start[j] : start[j] + n[j] - 1 + width])
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["anchor", "doc_id", "start", "bytes"],
            )

    joined = docs.join(wanted, "doc_id").select("doc_id", "text", "wanted")
    return joined.mapInArrow(extract, "anchor long, doc_id long, start long, bytes binary")


def _sorted_spans(strings: DataFrame, width: int) -> DataFrame:
    """Spans of repeated windows among the strings, by suffix sorting."""

    def settle(rows):
        rows.sort(key=lambda r: (r[1], r[2]))
        which, offset = repeated_windows([r[3] for r in rows], width)
        doc = np.array([r[1] for r in rows], np.int64)[which]
        start = np.array([r[2] for r in rows], np.int64)[which] + offset
        doc, start, end = _merge(doc, start, start + width)
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(end)], ["doc_id", "start", "end"])

    def sort(batches):
        held, size, last = [], 0, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for row in zip(*columns):
                if size >= BATCH and row[0] != last:
                    yield settle(held)
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield settle(held)

    dealt = strings.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(sort, "doc_id long, start long, end long")


def _wide_anchors(found: DataFrame, width: int) -> DataFrame:
    """Anchors with more than BATCH bytes still to be compared."""
    size = F.sum(F.col("n_windows").cast("long") + width)
    return found.where(F.col("kind") == KIND_OPEN).groupBy("anchor").agg(size.alias("size")).where(F.col("size") > BATCH).select("anchor")


def _window_spans(strings: DataFrame, width: int) -> DataFrame:
    """Spans of repeated windows among the strings, one by one by their hash."""
    begins = F.sequence(F.lit(1), F.length("bytes") - (width - 1))
    hashes = F.transform(begins, lambda i: F.md5(F.substring("bytes", i, width)))
    windows = strings.select("doc_id", "start", F.posexplode(hashes).alias("at", "h"))
    windows = stored(windows.select("h", "doc_id", (F.col("start") + F.col("at")).alias("start")), "byte-windows")
    place = F.struct("doc_id", "start")
    first = windows.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    later = windows.join(first, "h").where(place != F.col("first"))
    return later.select("doc_id", "start", (F.col("start") + width).alias("end"))


def duplicate_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Byte spans (doc_id, start, end) that are covered by a repeated string;
    they may touch or overlap.  ``docs`` has doc_id and text without nulls."""
    ship_package(docs.sparkSession)
    hot = hot_anchors(docs, "byte", gram, width)
    found = stored(places(docs, "byte", gram, width, strict=False, hot=hot), "byte-places")
    copies = found.where(F.col("kind") == KIND_COPY).select(
        "doc_id", "start", (F.col("start") + F.col("n_windows") - 1 + width).alias("end")
    )
    wide = stored(_wide_anchors(found, width), "wide-anchors")
    if wide.isEmpty():
        return copies.unionByName(stored(_sorted_spans(_open_strings(docs, found, width), width), "byte-spans"))
    narrow = _open_strings(docs, found.join(wide, "anchor", "left_anti"), width)
    sorted_ = stored(_sorted_spans(narrow, width), "byte-spans")
    single = _window_spans(_open_strings(docs, found.join(wide, "anchor", "left_semi"), width), width)
    return copies.unionByName(sorted_).unionByName(stored(single, "byte-wide-spans"))


def union_of(spans) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans of one document."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in runs:
        parts.append(text[at:start])
        at = end
    parts.append(text[at:])
    return b"".join(parts)


def removal_report(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans, kept_sha256; with
    ``with_text`` also the remaining text (bytes that a cut leaves without the
    rest of their character are dropped from that column)."""
    docs = document_texts(docs)
    spans = per_document(duplicate_spans(docs, width))

    def report(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(2).to_pylist()
            data, offsets = sy.utf8(batch.column(1))
            rows = [[], [], [], [], []]
            for i, spans_ in enumerate(lists):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                runs = union_of(spans_)
                kept = kept_bytes(text, runs) if runs else text
                rows[0].append(len(text))
                rows[1].append(len(text) - len(kept))
                rows[2].append(len(runs))
                rows[3].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    rows[4].append(kept.decode("utf-8", "ignore"))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(r, t) for r, t in zip(rows, types))][: len(names)], names)

    joined = docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(report, schema + ", kept_text string" * with_text)


def cleaned_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text`` (and ``n_chars``, if
    there is one, counted anew); all rows with a doc_id and all columns stay.
    Bytes that a cut leaves without the rest of their character go too."""
    plain = document_texts(docs)
    spans = per_document(duplicate_spans(plain, width)).withColumnRenamed("doc_id", "_id").withColumnRenamed("spans", "_spans")
    names = docs.columns
    keyed = docs.where(F.col("doc_id").isNotNull()).withColumn("_id", F.col("doc_id").cast("long"))
    joined = keyed.join(spans, "_id", "left").select(*names, "_spans")
    at = names.index("text")
    count = names.index("n_chars") if "n_chars" in names else None

    def clean(batches):
        for batch in batches:
            data, offsets = sy.utf8(batch.column(at))
            texts = []
            for i, spans_ in enumerate(batch.column(len(names)).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                texts.append(kept_bytes(text, union_of(spans_)).decode("utf-8", "ignore"))
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, batch.column(at).type)
            if count is not None:
                columns[count] = pa.array([len(t) for t in texts], batch.column(count).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(clean, docs.schema)
