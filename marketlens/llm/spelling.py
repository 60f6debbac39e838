"""Spelling variants: words one edit apart, by composition of finite automata.

The vocabulary is an acceptor; composed with a transducer that makes exactly one
edit (a code point inserted, deleted or replaced) and with the acceptor again it
accepts the pairs of near words.  Spark deals the composition out by its initial
states: a pair whose shorter word has L code points either shares the first
L div 2 of them, that is the state reached by this prefix, or, its edit lying
before, all from there on: the state of the reversed acceptor reached by this
suffix.  The words of each such state are a group of their own: what lies between
prefix and suffix is made a minimised acceptor (one for words of L, one for words
of L + 1, with states in common) and its pairs are enumerated: both tapes read
the same up to the edit, and are intersected behind it.  An insertion within
equal code points counts at their end, so each pair comes up in one place.

A group of more than ``BOUND`` words is divided by the same rule again, on its
inner part, and so on down to one code point, where the alphabet bounds it: a
frequent prefix never makes a task hold an unbounded group, nor loses a pair.

Words are runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z in lower case.  Null and empty
texts have none; repeated rows count as often as they occur; rows without doc_id
count like others; other columns are ignored; an empty table gives no words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, stored
from .piece_cache import text_blocks

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: a form is at least so many times as frequent as the word
TIMES = 2
#: words of a group that are composed in one step
BOUND = 2000


def word_counts(docs: DataFrame, rewrite: Callable | None = None, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of all texts, words of ``least_length`` code points or more.

    ``rewrite`` takes a doc_id and that document's distinct runs, and returns
    what each is to count as."""
    ship_package(docs.sparkSession)

    def count(batches):
        for batch in batches:
            lower = pc.ascii_lower(batch.column(1))
            for a, b in text_blocks(lower, 1 << 23):
                total: Counter = Counter()
                for doc_id, text in zip(batch.column(0)[a:b].to_pylist(), lower[a:b].to_pylist()):
                    runs = Counter(RUN.findall(text))
                    words = rewrite(doc_id, list(runs)) if rewrite else runs
                    for word, n in zip(words, runs.values()):
                        if len(word) >= least_length:
                            total[word] += n
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# -- composition -------------------------------------------------------------------
class Acceptor:
    """Minimal acyclic acceptors of sets of equally long strings, with states
    in common: a state is the dict of its arcs, the final one has none."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self._known: dict[tuple, int] = {}

    def _state(self, arcs: dict[str, int]) -> int:
        key = tuple(arcs.items())
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
        return self._known[key]

    def add(self, strings: list[str], length: int) -> int | None:
        """The initial state of the acceptor of these strings; None without any."""
        if not strings:
            return None
        strings = sorted(set(strings))
        open_arcs: list[dict[str, int]] = [{} for _ in range(length + 1)]
        before = strings[0]
        for s in [*strings[1:], None]:
            shared = 0
            while s is not None and s[shared] == before[shared]:
                shared += 1
            # no later string passes through the states behind the shared part
            for d in range(length, shared if s is not None else 0, -1):
                open_arcs[d - 1][before[d - 1]] = self._state(open_arcs[d])
                open_arcs[d] = {}
            before = s
        return self._state(open_arcs[0])

    def both(self, p: int, q: int):
        """The strings that are accepted from p and from q."""
        stack = [(p, q, "")]
        while stack:
            p, q, s = stack.pop()
            if not self.arcs[p]:
                yield s
                continue
            other = self.arcs[q]
            stack.extend((p2, other[c], s + c) for c, p2 in self.arcs[p].items() if c in other)


def one_edit_pairs(short: list[str], long: list[str], length: int, at_end: bool = True):
    """All pairs of ``short`` strings that differ by one replacement, and all of
    a short and a long one that differ by one insertion.  Short strings have
    ``length`` code points and long ones one more; without ``at_end``, an
    insertion behind the whole short string is left out."""
    machine = Acceptor()
    root = machine.add(short, length)
    if root is None:
        return
    arcs = machine.arcs
    stack = [(root, machine.add(long, length + 1), "")]
    while stack:  # what both tapes have read is the same up to here
        s, t, read = stack.pop()
        own = list(arcs[s].items())
        for i, (a, p) in enumerate(own):
            for b, q in own[i + 1 :]:
                for rest in machine.both(p, q):
                    yield read + a + rest, read + b + rest
        inserted = {} if t is None or (len(read) == length and not at_end) else arcs[t]
        for b, q in inserted.items():
            for rest in machine.both(s, q):
                if rest[:1] != b:
                    yield read + rest, read + b + rest
        further = {} if t is None else arcs[t]
        stack.extend((p, further.get(a), read + a) for a, p in own)


def _group_pairs(key: str, words: list[str]):
    """Pairs of near words of one group; its key tells L and what is cut off."""
    size, a, b = map(int, key.split(",", 3)[:3])
    short = [w[a : size - b] for w in words if len(w) == size]
    long = [w[a : size + 1 - b] for w in words if len(w) > size]
    if not short or len(words) < 2:
        return
    head, tail = words[0][:a], words[0][len(words[0]) - b :]
    for x, y in one_edit_pairs(short, long, size - a - b, at_end=b == 0):
        yield head + x + tail, head + y + tail


# -- groups ------------------------------------------------------------------------
_KEY = "concat_ws(',', size, a, b, substring(word, 1, a), right(word, b))"


def _divided(rows: DataFrame) -> DataFrame:
    """Each row (word, n, size, a, b), a and b code points being cut off, as two:
    with the first half of its inner part cut off, and with the second."""
    half = F.expr("(size - a - b) div 2")
    prefix = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"))
    suffix = F.struct(F.col("a").alias("a"), (F.col("size") - F.col("a") - half).alias("b"))
    parts = F.explode(F.when(half > 0, F.array(prefix, suffix)).otherwise(F.array(prefix)))
    return rows.select("word", "n", "size", parts.alias("part")).select(
        "word", "n", "size", F.col("part.a").cast("int").alias("a"), F.col("part.b").cast("int").alias("b")
    )


def _grouped(words: DataFrame, least_length: int, bound: int) -> DataFrame:
    """(key, word, n): each word in the groups where it may have near words; a
    group with an inner part of more than one code point has ``bound`` rows at most."""
    length = F.length("word")
    sizes = F.filter(F.array(length, length - 1), lambda x: x >= least_length)
    rows = _divided(words.select("word", "n", F.explode(sizes).alias("size"), F.lit(0).alias("a"), F.lit(0).alias("b")))
    ready = None
    while True:
        rows = rows.withColumn("key", F.expr(_KEY))
        large = rows.where("size - a - b > 1").groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > bound)
        large = stored(large.select("key"), "large-groups")
        none = large.isEmpty()
        done = (rows if none else rows.join(large, "key", "left_anti")).select("key", "word", "n")
        ready = done if ready is None else ready.unionByName(done)
        if none:
            return ready
        rows = stored(_divided(rows.join(large, "key", "left_semi")), "divided-groups")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, bound: int = BOUND) -> DataFrame:
    """(word, near, near_n): every pair of near words of a table (word, n) of
    distinct words, in both directions."""
    ship_package(words.sparkSession)

    def pairs(batches):
        key, group = None, []

        def found(key, group):
            if len(group) < 2:
                return
            n = dict(group)
            some = list(_group_pairs(key, list(n)))
            if some:
                first, second = map(list, zip(*some))
                both = pa.array(first + second, pa.string()), pa.array(second + first, pa.string()), pa.array([n[w] for w in second + first], pa.int64())
                yield pa.RecordBatch.from_arrays(list(both), ["word", "near", "near_n"])

        for batch in batches:
            for k, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    yield from found(key, group)
                    key, group = k, []
                group.append((word, n))
        yield from found(key, group)

    groups = _grouped(words.where(F.length("word") >= least_length), least_length, bound)
    return groups.repartition("key").sortWithinPartitions("key").mapInArrow(pairs, "word string, near string, near_n long")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of words that have a form: forms are followed to the last by
    doubling the step.  A form is ``TIMES`` as frequent, so a chain of them has
    log(most) links at most, ``most`` being the largest count."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    links = max(1, int(math.log(most, TIMES)) + 1) if most else 1
    for _ in range((links - 1).bit_length()):
        further = found.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        found = stored(found.join(further, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root")), "roots")
    return found


def variants(words: DataFrame, least_length: int = LEAST_LENGTH, bound: int = BOUND) -> DataFrame:
    """For a table (word, n) of distinct words: word, form (its near word of
    largest n; ties: smallest in code-point order; null unless that is at least
    twice the word's), root (the last of the forms from here on, the word itself
    without one), n, n_near and form_n."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    near = near_words(words, least_length, bound).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    taken = -F.col("best.minus") >= TIMES * F.col("n")
    judged = stored(
        joined.select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("best.minus")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()), judged.agg(F.max("n")).first()[0])
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_report(docs: DataFrame, rewrite: Callable | None = None) -> DataFrame:
    """``variants`` of the words that have ``LEAST_LENGTH`` code points and occur
    ``LEAST_COUNT`` times at least."""
    return variants(word_counts(docs, rewrite).where(F.col("n") >= LEAST_COUNT))
