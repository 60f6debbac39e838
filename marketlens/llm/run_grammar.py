"""Periodic runs of words, found on a run-length grammar of the texts.

Recompression: the word sequence is shortened by turns.  Block compression
names every maximal block of one symbol by (symbol, length); pair compression
splits the symbols into two classes and names every pair of a left symbol and
a right one.  Equal stretches are cut equally but for their ends, so the
longest common extension (LCE) of two places is found by climbing the levels
while the symbols agree and descending where they first differ.  Names are
given by equality, not by hash: extensions are exact.

A run with period q and at least four periods contains some multiple g of 3q
and g + q.  These places are the candidates for q; the LCE to the right of
(g, g + q) and to the left of (g - 1, g + q - 1) gives the whole run.  Where
several periods give the same stretch, the smallest is its period.

``document_runs`` works on any number of documents, a block of texts at a
time; a run never leaves its document.  A document is handled in one task,
with memory in proportion to its words.  Null and empty texts have no words
and no runs; rows without doc_id and repeated rows are kept as they are; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, split_words
from .piece_cache import text_blocks

#: a run is at least so long, and at least so many times its period
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: candidates compared at once
_CANDIDATES = 1 << 20


class _Level:
    """One sequence of the grammar, read in one direction.  ``up`` is each
    place's place in the next sequence, ``opens`` whether a symbol of the next
    sequence begins there, ``left`` (before block compression) how many equal
    symbols there are from here to the block's end, ``down`` the first place of
    each symbol in the sequence before."""

    __slots__ = ("symbols", "up", "opens", "left", "down")


def _places_from(opens: np.ndarray) -> np.ndarray:
    """How many places there are from each place to the next opening one."""
    begin = np.flatnonzero(opens)
    sizes = np.diff(np.append(begin, len(opens)))
    return np.repeat(begin + sizes, sizes) - np.arange(len(opens))


class RunGrammar:
    """The grammar of a sequence of symbols 0, 1, ...; symbols from ``bar`` on
    occur once each and are never compressed, so nothing matches across them.
    The first and the last symbol must be such bars."""

    def __init__(self, symbols: np.ndarray, bar: int):
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []  # (symbols, opens) of each level
        names = int(symbols.max()) + 1 if len(symbols) else 1
        loose = np.zeros(names, bool)
        loose[:bar] = True  # symbols that may be compressed
        s, turn = symbols.astype(np.int64), 0
        while True:
            free = loose[s]
            if turn > 0 and not (free[1:] & free[:-1]).any():
                break
            opens = np.ones(len(s), bool)
            if turn % 2 == 0:
                opens[1:] = s[1:] != s[:-1]
                begin = np.flatnonzero(opens)
                sizes = np.diff(np.append(begin, len(s)))
                joined = sizes > 1
                key = s[begin] * (int(sizes.max()) + 1) + sizes
            else:
                side = self._sides(names, turn)
                pair = np.zeros(len(s), bool)
                pair[:-1] = free[:-1] & free[1:] & side[s[:-1]] & ~side[s[1:]]
                opens[1:] = ~pair[:-1]
                begin = np.flatnonzero(opens)
                joined = pair[begin]
                key = s[begin] * names + s[np.minimum(begin + 1, len(s) - 1)]
            self.steps.append((s, opens))
            t = s[begin]
            kinds, which = np.unique(key[joined], return_inverse=True)
            t[joined] = names + which
            names += len(kinds)
            if names >= 1 << 31:
                raise ValueError("more symbols than two of them fit into one number")
            loose = np.append(loose, np.ones(len(kinds), bool))
            s, turn = t, turn + 1
        self.steps.append((s, np.ones(len(s), bool)))
        self.ahead = self._levels(backward=False)
        self.back = self._levels(backward=True)

    @staticmethod
    def _sides(names: int, turn: int) -> np.ndarray:
        """A class for each symbol, other ones each turn (multiplicative hashing)."""
        mixed = (np.arange(names, dtype=np.uint64) + np.uint64(turn << 32)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(63)).astype(bool)

    def _levels(self, backward: bool) -> list[_Level]:
        out, down = [], None
        for k, (s, opens) in enumerate(self.steps):
            level = _Level()
            if backward:  # what closes a symbol opens it from behind
                s, opens = s[::-1], np.append(opens[1:], True)[::-1]
            level.symbols, level.opens, level.down = s, opens, down
            level.up = np.cumsum(opens) - 1
            level.left = _places_from(opens) if k % 2 == 0 else None
            down = np.flatnonzero(opens)
            out.append(level)
        return out

    def common(self, i: np.ndarray, j: np.ndarray, backward: bool = False) -> np.ndarray:
        """For each pair of different places the length of the longest common
        extension to the right; with ``backward`` of what ends there, to the left."""
        levels, last = (self.back, len(self.steps[0][0]) - 1) if backward else (self.ahead, 0)
        p0 = (last - i) if backward else i
        q0 = (last - j) if backward else j
        p, q = p0.copy(), q0.copy()
        active = np.arange(len(p))
        stopped = []
        for level in levels:  # climb
            a, b = p[active], q[active]
            same = level.symbols[a] == level.symbols[b]
            step = same & ~(level.opens[a] & level.opens[b])
            # inside a symbol of the next level: on to its end, or to where the two differ
            far = np.minimum(level.left[a], level.left[b]) if level.left is not None else 1
            a, b = np.where(step, a + far, a), np.where(step, b + far, b)
            same &= (level.symbols[a] == level.symbols[b]) & level.opens[a] & level.opens[b]
            p[active], q[active] = a, b
            stopped.append(active[~same])
            active = active[same]
            p[active], q[active] = level.up[p[active]], level.up[q[active]]
        found = np.empty(0, np.int64)
        for k in range(len(levels) - 1, 0, -1):  # descend to where the symbols differ
            found = np.concatenate([found, stopped[k]])
            level = levels[k - 1]
            a, b = levels[k].down[p[found]], levels[k].down[q[found]]
            same = level.symbols[a] == level.symbols[b]
            far = np.minimum(level.left[a], level.left[b]) if level.left is not None else 1
            p[found], q[found] = np.where(same, a + far, a), np.where(same, b + far, b)
        return p - p0


def sequence_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in all words), length and period of every run in sequences that
    lie one after another; in the order of start, then period.

    The words are numbers from 0; the sequences' sizes add up to their count."""
    empty = np.empty(0, np.int64)
    longest = int(sizes.max()) if len(sizes) else 0
    if longest < LEAST_WORDS:
        return empty, empty, empty
    bar = int(words.max()) + 1
    ends = np.cumsum(sizes)
    # a bar before each sequence and one at the end: word i of sequence k is at i + k + 1
    s = np.insert(words, np.append(ends - sizes, len(words)), bar + np.arange(len(sizes) + 1))
    grammar, n = RunGrammar(s, bar), len(s)
    places, steps, waiting, results = [], [], 0, []

    def compare():
        g, q = np.concatenate(places), np.repeat([x[0] for x in steps], [x[1] for x in steps])
        right = grammar.common(g, g + q)
        left = grammar.common(g - 1, g + q - 1, backward=True)
        length = left + right + q
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        results.append(np.stack([g[good] - left[good], length[good], q[good]]))

    for q in range(1, longest // LEAST_PERIODS + 1):
        grid = (LEAST_PERIODS - 1) * q
        hits = np.flatnonzero(s[: n - q : grid] == s[q::grid]) * grid
        hits = hits[hits > 0]
        if len(hits):
            places.append(hits)
            steps.append((q, len(hits)))
            waiting += len(hits)
        if waiting > _CANDIDATES:
            compare()
            places, steps, waiting = [], [], 0
    if waiting:
        compare()
    if not results:
        return empty, empty, empty
    start, length, period = np.concatenate(results, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)  # the smallest period of each stretch
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    bars = np.cumsum(s >= bar)[start]  # so many bars lie before
    return start - bars, length, period


def _text_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array, pa.Array]:
    """Words, word counts, runs (lists of start, length, period) and the texts
    without repeats, of one block of texts."""
    flat, bounds = split_words(texts)
    sizes = np.diff(bounds)
    words = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = sequence_runs(words, sizes)
    owner = np.searchsorted(bounds, start, side="right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(start - bounds[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(sizes) + 1)), pa.int32()), runs)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, start + length, -1)
    kept = np.cumsum(covered)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds]
    rest = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
    return sizes, lists, pc.binary_join(rest, " ")


RUNS_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def document_runs(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_words, runs and the text collapsed.

    ``runs`` are by start, then period; ``collapsed`` are the words, joined by
    one space, that lie in the first period of every run that has them."""
    ship_package(docs.sparkSession)

    def find(batches):
        for batch in batches:
            for a, b in text_blocks(batch.column(1)):
                sizes, runs, collapsed = _text_runs(batch.column(1)[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(sizes, pa.int64()), runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"]
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(find, RUNS_SCHEMA)


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period; null
    without runs) as start, length, period and exponent_milli, and the digests
    of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = document_runs(docs).select("doc_id", "runs", "collapsed", best.alias("best"), F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"))
    period = -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.col("lines"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
