"""Token ids in files, each document compressed by itself with a shared dictionary.

File format (a Parquet folder, so that Spark's commit protocol covers it):
``dictionary/`` holds one row: dict_hash (sha256 of the zstandard dictionary)
and the dictionary, trained on serialised id arrays of a bounded sample
(``SAMPLE_DOCS`` documents).  ``blocks/`` holds up to ``BLOCK_DOCS`` documents a
row, in ascending doc_id order: shard, first_doc, last_doc, shard_start (ids of
the shard before this block), n_tokens, dict_hash, item (bytes an id), the
offset index (doc ids, frame ends, token counts) and the frames.  A reader
finds a block by the doc_id statistics and inflates only the frame it needs.

Documents are ordered by a range shuffle and a sort inside each shard; the
running start is kept a shard, and shards are added up by their totals (one row
a shard).  Null texts count as empty (only the end id); rows without doc_id are
left out; an empty table gives no rows; extra columns are ignored; rows with
equal doc_id all stay, ordered by their text.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import document_texts, scratch_path, ship_package
from .piece_cache import encoder, text_blocks

SAMPLE_DOCS, DICT_BYTES, BLOCK_DOCS, BLOCK_BYTES, LEVEL = 400, 64 << 10, 256, 1 << 20, 3
BLOCKS = (
    "shard int, first_doc long, last_doc long, shard_start long, n_tokens long, dict_hash string, item int, "
    "doc_ids binary, frame_ends binary, counts binary, frames binary"
)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; empty where the samples are too few to train."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, item: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) and write the format above to ``path``.
    ``item``: bytes an id (2 for vocabularies of up to 65,536)."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = document_texts(docs)
    kind = f"<u{item}"

    def encoded(texts):
        end = np.array([end_id], "<u4").tobytes()
        return [x + end for x in encoder(tokenizer_path)(texts)]

    def sample(batches):
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").astype(kind).tobytes() for x in encoded(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x[: DICT_BYTES * 4] for x in ids], pa.binary())], ["ids"])

    rows = docs.select("text").limit(SAMPLE_DOCS).mapInArrow(sample, "ids binary").collect()
    dictionary = train_dictionary([bytes(r.ids) for r in rows])
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )

    def blocks(batches):
        import zstandard
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        shared = _dictionary(dictionary)
        if shared:
            shared.precompute_compress(level=LEVEL)  # digested once, not for each document
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        start, held, size = 0, [], 0

        def block():
            nonlocal start
            ids, counts, frames = zip(*held)
            n = sum(counts)
            row = (
                shard, ids[0], ids[-1], start, n, dict_hash, item, np.array(ids, "<i8").tobytes(),
                np.cumsum([len(x) for x in frames]).astype("<i8").tobytes(), np.array(counts, "<i8").tobytes(), b"".join(frames),
            )
            start += n
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema)

        names = [x.split()[0] for x in BLOCKS.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in BLOCKS.split(", ")])
        for batch in batches:
            for a, b in text_blocks(batch.column(1)):
                doc_ids = batch.column(0)[a:b].to_pylist()
                for doc, ids in zip(doc_ids, encoded(batch.column(1)[a:b].to_pylist())):
                    frame = squeeze.compress(np.frombuffer(ids, "<u4").astype(kind).tobytes())
                    held.append((doc, len(ids) // 4, frame))
                    size += len(frame)
                    if len(held) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                        yield block()
                        held, size = [], 0
        if held:
            yield block()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a token folder: doc_id, start, n_tokens, ids_crc32, and with
    ``with_ids`` the ids as little-endian unsigned 32-bit integers."""
    ship_package(spark)
    stored = spark.read.parquet(f"{path}/dictionary").collect()[0]
    dictionary, dict_hash = bytes(stored.dictionary), stored.dict_hash
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    shards = blocks.groupBy("shard").agg(F.min("first_doc").alias("first"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy("first", "shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def documents(batches):
        import zstandard

        inflate = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != dict_hash:
                    raise ValueError("block was written with another dictionary")
                ids = np.frombuffer(row["doc_ids"], "<i8")
                ends = np.frombuffer(row["frame_ends"], "<i8").tolist()
                counts = np.frombuffer(row["counts"], "<i8")
                starts = row["offset"] + row["shard_start"] + np.cumsum(counts) - counts
                kind, at, crc, full = f"<u{row['item']}", 0, [], []
                for end in ends:
                    raw = np.frombuffer(inflate.decompress(row["frames"][at:end]), kind).astype("<u4").tobytes()
                    crc.append(zlib.crc32(raw))
                    if with_ids:
                        full.append(raw)
                    at = end
                columns = [pa.array(ids), pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())]
                columns += [pa.array(full, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    rows = blocks.join(offsets, "shard").select("offset", "shard_start", "dict_hash", "item", "doc_ids", "frame_ends", "counts", "frames")
    return rows.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (one list a row with this doc_id); only the
    blocks that can hold it are read, and only its frames inflated."""
    import zstandard

    stored = spark.read.parquet(f"{path}/dictionary").collect()[0]
    inflate = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(stored.dictionary)))
    found = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    out = []
    for row in found.select("item", "doc_ids", "frame_ends", "frames").collect():
        ends = np.frombuffer(row.frame_ends, "<i8")
        for i in np.flatnonzero(np.frombuffer(row.doc_ids, "<i8") == doc_id):
            raw = inflate.decompress(bytes(row.frames[int(ends[i - 1]) if i else 0 : int(ends[i])]))
            out.append(np.frombuffer(raw, f"<u{row.item}").tolist())
    return out


def token_report(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write ``docs`` to ``path`` (a new folder under spark.checkpoint.dir by
    default) and return what the files say."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return read_tokens(docs.sparkSession, path)
