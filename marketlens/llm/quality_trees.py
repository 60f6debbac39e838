"""Quality scores from histogram gradient-boosted trees.

``features`` turns a block of texts into figures about words, characters and
lines.  ``train`` fits trees of fixed depth to the logistic loss: features are
cut into at most ``BINS`` quantile bins, each level of a tree is found from
histograms of gradients, and a tree is kept as flat arrays (node i has children
2i + 1 and 2i + 2), so that all trees of all rows are walked together.

Training uses at most ``SAMPLE`` labelled rows (the smallest by a hash of their
doc_id); figures of that many rows are what the driver gathers.  Where the
labelled rows are of one class or there are none, every score is the smoothed
share (n1 + 1) / (n + 1) of label 1.

Null and empty texts have a score like any other; rows without doc_id are left
out; an empty table gives no rows; repeated rows all stay; extra columns are
ignored.  Where a doc_id has several labels, the smallest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import symbols as sy
from .common import document_texts, ship_package

SAMPLE, BINS, DEPTH, TREES, RATE, LAMBDA, MIN_ROWS = 20_000, 64, 4, 120, 0.1, 1.0, 20
THRESHOLD = 0.7

_CLASSES = np.zeros((256, 9))
for _i, _set in enumerate((
    range(65, 91), range(97, 123), range(48, 58), range(128, 256), b"\n", b"#*$%&|<>", b"!", b",.;:?", b"|",
)):
    _CLASSES[list(_set), _i] = 1
N_FEATURES = len(_CLASSES[0]) + 13


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, and the count of the most frequent one."""
    key = np.sort((row.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    of = (key[at] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, of, np.diff(np.append(at, len(key))))
    return np.bincount(of, minlength=n), most


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of N_FEATURES figures a text."""
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES))
    for a, b in sy.blocks(offsets):
        part = offsets[a : b + 1]
        m = b - a
        bytes_ = np.diff(part).astype(float)
        chars = np.stack([np.bincount(data[part[i] : part[i + 1]], minlength=256) for i in range(m)]) @ _CLASSES
        h, start, end, first = sy.words(data, part)
        words = np.diff(first)
        row = np.repeat(np.arange(m), words)
        length = (end - start).astype(float)
        some = np.maximum(words, 1)
        total = np.bincount(row, length, m)
        square = np.bincount(row, length**2, m)
        longest = np.zeros(m)
        np.maximum.at(longest, row, length)
        distinct, most = _distinct(row, h, m)
        pair = row[1:] == row[:-1]
        twice = np.bincount(row[1:][pair & (h[1:] == h[:-1])], minlength=m) if len(h) > 1 else np.zeros(m)
        pairs, _ = _distinct(row[1:][pair], sy.mix(h[:-1] * np.uint64(3) + h[1:])[pair], m) if len(h) > 1 else (np.zeros(m), None)
        buf = data[part[0] : part[-1]]
        cut = np.unique(np.concatenate([np.flatnonzero(buf == 10) + 1, part[:-1] - part[0]]))
        cut = cut[cut < len(buf)]
        stop = np.append(cut[1:], len(buf))
        line_row = np.searchsorted(part - part[0], cut, "right") - 1
        lines = np.bincount(line_row, minlength=m)
        line_hash = sy.span_hash(sy.prefix_sums(sy.byte_values(buf)), cut, stop) if len(cut) else np.zeros(0, np.uint64)
        same_lines, _ = _distinct(line_row, line_hash, m)
        mean = total / some
        short = np.bincount(row[length <= 2], minlength=m)
        out[a:b] = np.column_stack([
            chars / np.maximum(bytes_, 1)[:, None],
            np.log1p(bytes_), np.log1p(words), mean, np.sqrt(np.maximum(square / some - mean**2, 0)), np.log1p(longest),
            short / some, distinct / some, most / some, twice / some, pairs / np.maximum(words - 1, 1),
            np.log1p(lines), same_lines / np.maximum(lines, 1), words / np.maximum(lines, 1),
        ])
    return out


@dataclass
class Trees:
    """``feature`` and ``limit`` of the inner nodes and ``leaf`` values, a row a tree."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; all trees of a block of rows together."""
        out = np.empty(len(x))
        tree = np.arange(len(self.feature))
        for at in range(0, len(x), 4096):
            rows = x[at : at + 4096]
            node = np.zeros((len(rows), len(tree)), np.int64)
            for _ in range(DEPTH):
                right = np.take_along_axis(rows, self.feature[tree, node], 1) > self.limit[tree, node]
                node = 2 * node + 1 + right
            out[at : at + 4096] = self.base + self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 1)
        base = float(np.log(share / max(1 - share, 1e-9)))
        return Trees(base, np.zeros((1, inner), np.int64), np.zeros((1, inner)), np.zeros((1, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    mean = y.mean()
    base = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), base)
    feature, limit, leaf = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        f_tree, l_tree = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for depth in range(DEPTH):
            width, first = 2**depth, 2**depth - 1
            local = node - first
            best = np.zeros(width)
            for j, e in enumerate(edges):
                slot = local * BINS + binned[:, j]
                sums = [np.bincount(slot, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h, None)]
                gl, hl, nl = (s[:, :-1] for s in sums)
                g_, h_, n_ = (s[:, -1:] for s in sums)
                gain = gl**2 / (hl + LAMBDA) + (g_ - gl) ** 2 / (h_ - hl + LAMBDA) - g_**2 / (h_ + LAMBDA)
                gain[(nl < MIN_ROWS) | (n_ - nl < MIN_ROWS)] = 0
                gain = gain[:, : len(e)]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > best + 1e-9
                best[better] = gain[np.arange(width), at][better]
                f_tree[first : first + width][better] = j
                l_tree[first : first + width][better] = e[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), f_tree[node]] > l_tree[node])
        local = node - inner
        value = -RATE * np.bincount(local, g, leaves) / (np.bincount(local, h, leaves) + LAMBDA)
        score += value[local]
        feature.append(f_tree)
        limit.append(l_tree)
        leaf.append(value)
    return Trees(base, np.stack(feature), np.stack(limit), np.stack(leaf))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("long").cast("string")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from the labelled rows that are not held out."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    chosen = docs.sparkSession.createDataFrame(known.collect(), "doc_id long, quality int")  # at most ``sample`` rows

    def figures(batches):
        for batch in batches:
            x = features(*sy.utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
    got = rows.mapInArrow(figures, "doc_id long, quality int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist()).reshape(-1, N_FEATURES)
    y = got.column("quality").to_numpy().astype(float)
    order = np.lexsort((*x.T, got.column("doc_id").to_numpy()))  # the fit doesn't depend on how rows arrive
    return train(x[order], y[order])


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, score and predicted of each row of (doc_id, text)."""

    def run(batches):
        for batch in batches:
            score = trees.scores(features(*sy.utf8(batch.column(1))))
            predicted = (score >= THRESHOLD).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(predicted)], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    ship_package(docs.sparkSession)
    docs = document_texts(docs)
    return scored(docs, fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with their columns.
    The score is computed where the row is read, without a join."""
    ship_package(docs.sparkSession)
    trees = fit(document_texts(docs), labels)
    names = docs.columns
    text, doc_id = names.index("text"), names.index("doc_id")

    def keep(batches):
        import pyarrow.compute as pc

        for batch in batches:
            score = trees.scores(features(*sy.utf8(batch.column(text))))
            yield batch.filter(pc.and_(pa.array(score >= THRESHOLD), pc.is_valid(batch.column(doc_id))))

    return docs.mapInArrow(keep, docs.schema)
