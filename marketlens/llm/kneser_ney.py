"""Interpolated modified Kneser-Ney model of word pairs, counted by Spark.

Tokens are the words of a text (A-Z in lower case; separated by blank and
\\x09-\\x0D) and one end mark; the first token follows a begin mark.

* Counting: Spark adds up the words of all blocks of texts by shards of their
  64-bit hash; each shard is stored as a sorted array of hashes with the counts
  beside it, and a word's number is its place in all shards.  Each block then
  packs its distinct pairs of numbers with their counts into one compressed row
  a shard of the pairs' hash, so a frequent word or pair adds one entry a block
  and no shard gets more than its share.  The pairs of a shard are added up and
  stored as a sorted array of hashes (one to one, so exact) with the counts.
  Out of the same pass come, for each word, the numbers of different words
  before and after it, added up by shards of words.
* Probabilities: absolute discounts for counts 1, 2 and 3 or more, from the
  counts of counts; what they take goes to the next lower order.  A word alone
  is weighted by the number of different words before it, and interpolated with
  a share for each word of the vocabulary and one for all unknown ones, so that
  the probabilities after any word add up to 1.
* Scoring: workers memory-map the shard files in the shared folder and look a
  block's distinct pairs up by binary search; no document is shuffled.

The files lie under ``spark.checkpoint.dir``, which must be a folder that all
workers can open by its path (a mounted one; other stores are refused).  A
shard is written under a name of its own and then renamed, so repeated tasks
leave whole files.  Shards follow ``spark.sql.shuffle.partitions``: a task
holds one of them in memory.  Words are told apart by 64-bit hashes.

Null and empty texts are an end mark alone.  Repeated rows count as often as
they occur.  Rows without doc_id are scored and, in ``train``, counted like
others.  Without training texts every token has probability 1.  Other columns
are ignored.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, scratch_path, ship_package, split_words
from .piece_cache import text_blocks

#: bytes of text that are counted, or scored, together
COUNTED = 1 << 25
SCORED = 1 << 23
#: marks that are no words
_BEGIN, _END = b"", b" "
#: discounts where the counts of counts give none (a corpus too small or too even)
_PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)


def _hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the keys, in their order."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


class _Block:
    """Tokens of a block of texts: ``words`` the hashes of the distinct ones (the
    last two are the end and the begin mark), ``before`` and ``token`` places in
    it, ``ends`` where each text ends."""

    def __init__(self, texts: pa.Array):
        flat, bounds = split_words(pc.ascii_lower(texts))
        coded = flat.dictionary_encode()
        self.words = _hashes([*coded.dictionary.cast(pa.binary()).to_pylist(), _END, _BEGIN])
        end, begin = len(self.words) - 2, len(self.words) - 1
        self.token = np.insert(coded.indices.to_numpy().astype(np.int64), bounds[1:], end)
        self.ends = bounds[1:] + np.arange(1, len(bounds))
        self.before = np.empty_like(self.token)
        self.before[1:] = self.token[:-1]
        self.before[np.append(0, self.ends[:-1])[: len(self.ends)]] = begin

    def pairs(self, each: bool = False):
        """Distinct pairs (places of both words), their number; with ``each``
        also each token's pair."""
        n = len(self.words)
        pairs, *more = np.unique(self.before * n + self.token, return_inverse=each, return_counts=True)
        return pairs // n, pairs % n, *more[::-1]


def _pair_keys(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Two numbers of words as one."""
    return before.astype(np.uint64) << np.uint64(32) | token.astype(np.uint64)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers, one to one."""
    for shift, factor in ((31, 0x9E3779B97F4A7C15), (29, 0xD6E8FEB86659FD93)):
        keys = (keys ^ keys >> np.uint64(shift)) * np.uint64(factor)
    return keys ^ keys >> np.uint64(32)


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers, the first one ascending, as compressed bytes: its
    steps and the others, byte by byte of all rows."""
    import zstandard

    rows = np.stack([np.diff(columns[0], prepend=columns[0].dtype.type(0)).view("<i8"), *(c.astype("<i8") for c in columns[1:])])
    planes = rows.view(np.uint8).reshape(len(rows), -1, 8).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, width: int) -> list[np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, 8, -1)
    rows = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]
    return [np.cumsum(rows[0].view(np.uint64)), *rows[1:]]


def _sums(groups: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    return np.rint(np.bincount(groups, weights=values, minlength=n)).astype(np.int64)


# -- shard files -----------------------------------------------------------------
def _folder(uri: str) -> str:
    """The path of a folder that workers can open."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model's files are memory-mapped: spark.checkpoint.dir must be a mounted folder, not {uri}")
    return parts.path


def _write_columns(folder: str, name: str, columns: list[np.ndarray]) -> None:
    """Columns of one length in one file: a head of their number, length and
    widths in bytes, then each column, at a multiple of eight bytes."""
    columns = [c if c.dtype == np.uint64 else c.astype(np.min_scalar_type(int(c.max(initial=0)))) for c in columns]
    os.makedirs(folder, exist_ok=True)
    own = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
    with open(own, "wb") as f:
        f.write(np.array([len(columns), len(columns[0]), *(c.itemsize for c in columns)], "<i8").tobytes())
        for c in columns:
            f.write(c.tobytes())
            f.write(bytes(-c.nbytes % 8))
    os.replace(own, os.path.join(folder, name))


def _open_columns(folder: str, name: str) -> list[np.ndarray]:
    """The columns as views of the memory-mapped file; none if there is no such file."""
    try:
        mapped = np.memmap(os.path.join(folder, name), np.uint8, "r")
    except FileNotFoundError:
        return []
    width, n = mapped[:16].view("<i8").tolist()
    sizes, at, out = mapped[16 : 16 + 8 * width].view("<i8").tolist(), 16 + 8 * width, []
    for size in sizes:
        out.append(mapped[at : at + size * n].view(f"<u{size}"))
        at += size * n + -size * n % 8
    return out


def _look_up(folder: str, kind: str, shards: int, keys: np.ndarray, width: int, beside: str = "") -> np.ndarray:
    """The columns beside each key (of a second file too, if named), 0 where it
    is unknown; one row a column.  The last row is the place in the shard, from 1."""
    order = np.argsort(keys)
    keys = keys[order]
    out = np.zeros((width + 1, len(keys)), np.int64)
    cuts = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[shard], cuts[shard + 1]
        columns = _open_columns(folder, f"{kind}-{shard}")
        if columns:
            place = np.minimum(np.searchsorted(columns[0], keys[a:b]), len(columns[0]) - 1)
            known = columns[0][place] == keys[a:b]
            for row, c in zip(out, columns[1:] + (_open_columns(folder, f"{beside}-{shard}") if beside else [])):
                row[a:b] = np.where(known, c[place], 0)
            out[-1, a:b] = np.where(known, place + 1, 0)
    back = np.empty_like(out)
    back[:, order] = out
    return back


# -- counting ----------------------------------------------------------------------
_WORDS = "shard int, word long, n long"
_PACKED = "shard int, data binary"
_SIZES = "shard int, words long, vocabulary long, tokens long"
#: of a shard of words, to be added up: of words by different words before them
#: (once to four times), of pairs by their number (once to four times)
_TOTALS = ("lefts", "left_1", "left_2", "left_3", "left_4", "right_1", "right_2", "right_3", "right_4")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _names(schema))


def _by_shard(batches):
    """(shard, its rows of each batch) of rows that are sorted by shard."""
    shard, waiting = None, []
    for batch in batches:
        all_of = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(all_of)) + 1).tolist(), len(all_of)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b and all_of[a] != shard and waiting:
                yield shard, waiting
                waiting = []
            if a < b:
                shard = int(all_of[a])
                waiting.append(batch.slice(a, b - a))
    if waiting:
        yield shard, waiting


def _packed_by_shard(shards: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One packed row a shard."""
    order = np.argsort(shards, kind="stable")
    sorted_shards, columns = shards[order], [c[order] for c in columns]
    cuts = [0, *(np.flatnonzero(np.diff(sorted_shards)) + 1).tolist(), len(order)]
    spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
    return _batch(_PACKED, pa.array([int(sorted_shards[a]) for a, _ in spans], pa.int32()), pa.array([_pack([c[a:b] for c in columns]) for a, b in spans], pa.binary()))


def _unpacked(rows: list[pa.RecordBatch], width: int) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*(_unpack(x, width) for r in rows for x in r.column(1).to_pylist()))]


@dataclass(frozen=True)
class PairModel:
    """A stored model: the folder of its shards and the corpus totals."""

    folder: str
    shards: int
    starts: tuple  # of each shard, the words before it
    totals: dict

    def numbers(self, words: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers of words, from 1, by their hash and place in the shard; 0 for unknown ones."""
        return np.where(places > 0, np.array(self.starts)[_shard_of(words, self.shards)] + places, 0)

    def _discounts(self, kind: str) -> np.ndarray:
        """Discounts of counts 0, 1, 2 and 3 or more."""
        n = [self.totals[f"{kind}_{i}"] for i in (1, 2, 3, 4)]
        found = _PLAIN_DISCOUNTS
        if min(n) > 0:
            y = n[0] / (n[0] + 2 * n[1])
            some = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
            if all(0 <= d <= k for k, d in zip((1, 2, 3), some)):
                found = some
        return np.array([0.0, *found])

    def unigram(self, left: np.ndarray) -> np.ndarray:
        """Probability of words by the number of different words before them."""
        t, d = self.totals, self._discounts("left")
        if not t["lefts"]:
            return np.full(len(left), 1 / (t["vocabulary"] + 1))
        rest = t["vocabulary"] - t["left_1"] - t["left_2"]
        spare = d[1] * t["left_1"] + d[2] * t["left_2"] + d[3] * rest
        return (left - d[np.minimum(left, 3)] + spare / (t["vocabulary"] + 1)) / t["lefts"]

    def logs(self, block: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 of each token's probability, of its base probability, and its
        occurrences in the training texts."""
        occurs, left, right, once, twice, place = _look_up(self.folder, "words", self.shards, block.words, 5, "figures")
        number = self.numbers(block.words, place)
        after = occurs.copy()  # a word is followed as often as it occurs, the begin mark once a text
        after[-1] = occurs[-2]
        before, token, _, which = block.pairs(each=True)
        n, _ = _look_up(self.folder, "pairs", self.shards, _mixed(_pair_keys(number[before], number[token])), 1)
        d = self._discounts("right")
        single = self.unigram(left)
        spare = (d[1] * once + d[2] * twice + d[3] * (right - once - twice))[before]
        total = after[before]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = (n - d[np.minimum(n, 3)] + spare * single[token]) / total
        p = np.where(total > 0, seen, single[token])
        base = np.log10((occurs + 1) / (self.totals["tokens"] + self.totals["vocabulary"] + 1))
        return np.log10(p)[which], base[block.token], occurs[block.token]


def train(docs: DataFrame) -> PairModel:
    """Count the texts and store the model."""
    spark = docs.sparkSession
    ship_package(spark)
    shards = 1 << max(4, (partitions(spark) - 1).bit_length())
    folder, together = _folder(scratch_path(spark, "pair-model")), COUNTED

    def words(batches):
        for batch in batches:
            for a, b in text_blocks(batch.column(0), together):
                block = _Block(batch.column(0)[a:b])
                counts = np.bincount(block.token, minlength=len(block.words))
                yield _batch(_WORDS, _shard_of(block.words, shards), block.words.view(np.int64), counts)

    def store_words(batches):
        for shard, rows in _by_shard(batches):
            word, n = (np.concatenate([r.column(k).to_numpy() for r in rows]) for k in (1, 2))
            order = np.argsort(word.view(np.uint64))
            _write_columns(folder, f"words-{shard}", [word.view(np.uint64)[order], n[order]])
            yield _batch(_SIZES, pa.array([shard], pa.int32()), [len(word)], [int((n > 0).sum())], [int(n.sum())])

    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counted = texts.mapInArrow(words, _WORDS).repartition("shard").groupBy("shard", "word").agg(F.sum("n").alias("n"))
    found = counted.sortWithinPartitions("shard").mapInArrow(store_words, _SIZES).collect()  # a row a shard
    sizes = np.zeros(shards, np.int64)
    for r in found:
        sizes[r.shard] = r.words
    if sizes.sum() >= 1 << 32:
        raise ValueError("more words than 32 bits can number")
    starts = (np.cumsum(sizes) - sizes).tolist()
    totals = {"vocabulary": sum(r.vocabulary for r in found), "tokens": sum(r.tokens for r in found)}
    model = PairModel(folder, shards, tuple(starts), totals)

    def pairs(batches):
        for batch in batches:
            for a, b in text_blocks(batch.column(0), together):
                block = _Block(batch.column(0)[a:b])
                number = model.numbers(block.words, _look_up(folder, "words", shards, block.words, 1)[-1])
                before, token, n = block.pairs()
                keys = _pair_keys(number[before], number[token])
                order = np.argsort(keys)
                yield _packed_by_shard(_shard_of(_mixed(keys[order]), shards), [keys[order], n[order]])

    def store_pairs(batches):
        for shard, rows in _by_shard(batches):
            some, counts = _unpacked(rows, 2)
            keys, place = np.unique(some, return_inverse=True)
            n = _sums(place, len(keys), counts)
            hashes = _mixed(keys)
            order = np.argsort(hashes)
            _write_columns(folder, f"pairs-{shard}", [hashes[order], n[order]])
            ends = np.concatenate([keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)])
            number, place = np.unique(ends, return_inverse=True)
            first, second = place[: len(keys)], place[len(keys) :]
            figures = [np.bincount(second, minlength=len(number)), np.bincount(first, minlength=len(number))]
            figures += [np.bincount(first[n == k], minlength=len(number)) for k in (1, 2, 3, 4)]
            yield _packed_by_shard(np.searchsorted(starts, number.astype(np.int64) - 1, side="right") - 1, [number, *figures])

    def store_figures(batches):
        for shard, rows in _by_shard(batches):
            number, *some = _unpacked(rows, 7)
            place = number.astype(np.int64) - 1 - starts[shard]
            left, right, *times = (_sums(place, sizes[shard], c) for c in some)
            _write_columns(folder, f"figures-{shard}", [left, right, *times[:2]])
            sums = [left.sum(), *((left == k).sum() for k in (1, 2, 3, 4)), *(c.sum() for c in times)]
            yield _batch(", ".join(f"{c} long" for c in _TOTALS), *([int(x)] for x in sums))

    stored = texts.mapInArrow(pairs, _PACKED).repartition("shard").sortWithinPartitions("shard").mapInArrow(store_pairs, _PACKED)
    figures = stored.repartition("shard").sortWithinPartitions("shard").mapInArrow(store_figures, ", ".join(f"{c} long" for c in _TOTALS))
    sums = figures.agg(*[F.sum(c).alias(c) for c in _TOTALS]).first().asDict()
    return PairModel(folder, shards, tuple(starts), totals | {k: v or 0 for k, v in sums.items()})


def scored(docs: DataFrame, model: PairModel) -> DataFrame:
    """One row a document: doc_id, n_tokens, n_known (tokens that the training
    texts have), base_score, score and perplexity (10 to the minus score a token)."""
    ship_package(docs.sparkSession)
    together = SCORED
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"

    def run(batches):
        for batch in batches:
            for a, b in text_blocks(batch.column(1), together):
                block = _Block(batch.column(1)[a:b])
                logs, base, occurs = model.logs(block)
                begin = np.append(0, block.ends[:-1])
                sizes = block.ends - begin
                score = np.add.reduceat(logs, begin)
                columns = [np.add.reduceat((occurs > 0).astype(np.int64), begin), np.add.reduceat(base, begin), score, 10 ** (-score / sizes)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(sizes), *map(pa.array, columns)], _names(schema))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema)


def score_report(docs: DataFrame) -> DataFrame:
    """Every text's score by the model of the texts that are not held out:
    those whose crc32 of the id as text, modulo 7, is not 2."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    model = train(docs.where(~held))
    return scored(docs, model).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.totals["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )
