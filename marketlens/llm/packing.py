"""Packing documents into sequences of a fixed length by the length histogram.

Documents are encoded and cut every ``size`` tokens; the histogram of piece
lengths has at most ``size`` entries.  ``pack_histogram`` places lengths from
the longest down into the shortest pack that takes them (shortest-pack-first)
and counts equal packing patterns instead of packs.  Pieces get a rank among
those of their length, and each pattern owns ranges of ranks, so that every
piece finds its sequence and offset by its rank.

A length may hold a third of all pieces: ranks are counted in ``SALTS``
groups a length, whose sizes are added up beforehand (at most size x SALTS
rows, the bound of the broadcast).

Null texts count as empty (only the end id); rows without doc_id are left out;
an empty table gives no rows; extra columns are ignored.  Rows with equal
doc_id are packed each; equal (doc_id, start) pieces get their places in the
order of their hashes.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import document_texts, ship_package, stored
from .piece_cache import encoder, text_blocks

SIZE, SALTS = 1024, 256
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in a pack, number of such packs).

    Each step fills one whole group of equal packs or uses up one length, so
    the number of patterns is bounded by the number of lengths, not of rows."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by used length
    used: list[int] = []  # sorted keys of groups

    def add(pattern, count):
        total = sum(pattern)
        if total not in groups:
            groups[total] = []
            insort(used, total)
        groups[total].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not used or used[0] + length > size:
                add((length,), left)
                break
            total = used[0]  # the shortest packs have the most room
            pattern, count = groups[total].pop()
            if not groups[total]:
                del groups[total]
                used.pop(bisect_left(used, total))
            taken = min(count, left)
            if count > taken:
                add(pattern, count - taken)
            add((*pattern, length), taken)
            left -= taken
    return [x for total in used for x in groups[total]]


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length rows (first rank, first sequence id, offset), by rank."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = ranks.get(length, 0)
            slots.setdefault(length, []).append((rank, sequence, offset))
            ranks[length] = rank + count
            offset += length
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int, size: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids; with ``with_ids`` also the ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for batch in batches:
            for a, b in text_blocks(batch.column(1)):
                rows = [[] for _ in range(5 + with_ids)]
                for doc, ids in zip(batch.column(0)[a:b].to_pylist(), encoder(tokenizer_path)(batch.column(1)[a:b].to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, size):
                        part = ids[4 * start : 4 * (start + size)]
                        for r, x in zip(rows, (doc, start, len(part) // 4, zlib.crc32(part), n, part)):
                            r.append(x)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names[: len(rows)])

    return docs.mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def packed(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids)."""
    ship_package(docs.sparkSession)
    pieces = stored(cut_documents(document_texts(docs), tokenizer_path, end_id, size, with_ids), "pieces")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)))
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(pack_histogram(histogram, size))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("local", F.row_number().over(own) - 1)
        .join(F.broadcast(offsets), ["length", "salt"])
        .withColumn("rank", F.col("local") + F.col("before"))
        .drop("salt", "local", "before")
    )
    columns = [x for x in ranked.columns if x != "rank"]

    def place(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            length = table.column("length").to_numpy()
            rank = table.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                s = slots[int(x)]
                at = np.searchsorted(s[:, 0], rank[rows], "right") - 1
                sequence[rows] = s[at, 1] + rank[rows] - s[at, 0]
                offset[rows] = s[at, 2]
            arrays = [table.column(c).combine_chunks() for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    types = dict(pieces.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in columns) + ", sequence_id long, offset long"
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return ranked.mapInArrow(place, schema).select(
        *(F.col(c).cast("long") if c == "length" else F.col(c) for c in order)
    )
