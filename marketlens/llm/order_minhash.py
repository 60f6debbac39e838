"""Near-duplicate documents by order MinHash and banded alignment.

K-mers are ``K`` consecutive words, labelled by their occurrence in the text
(first, second, ...).  For each of ``SKETCHES`` hash functions the ``TAKE``
labelled k-mers of smallest hash are taken and put in the order in which they
stand in the text; texts that agree in one such tuple are candidates.  Unlike a
set sketch this depends on the order of the words, so agreement follows the
edit similarity.  Candidates are verified by the similarity 1 - d / max(n, m)
with the edit distance d of the word sequences, found by an alignment inside a
band that is widened up to the largest distance allowed.  ``SIMILARITY`` or more
makes a link; classes are the connected components, named by their smallest
doc_id.

Equal texts are put together first, so a text with many copies is one text in
all that follows.  In a group of up to ``SMALL`` texts with an equal tuple all
are compared.  In a larger one each is first compared with the ``LEADERS`` texts
that share most tuples with others, and with its predecessor by length; this
joins most near copies of one text at a fixed number of pairs a text.  What is
left are groups whose texts lie in several components.  Their texts are compared
exactly (``open_pairs``): an edit changes at most two pairs of neighbouring words,
so texts of the wanted similarity have three fifths of their word pairs (labelled
by occurrence) in common, up to one.  Under one order of all word pairs, with those
of a single component first and then the rarest, they share one of their first
two fifths, so every pair of texts across components that may be a link is tested,
and no pair without such a word pair is made.  A text with more than two fifths of
its word pairs in its own component alone needs no comparison at all.  Where large
groups connect texts so alike that most of them meet (``_dense_families``), a row
for each pair would grow with the square of the family: such a family is dealt
into blocks by length, and each two blocks are compared whole in one task, first
by the words and word pairs in common, then by alignment (``links_between``); only
links that join components come out.  Word pairs find the other pairs.  Links stay
on the cluster, and components are found by repeated star contraction, written to
the shared folder each round.

Texts of fewer than ``K`` words have one k-mer, all their words; texts without
words (also null) are equal.  Rows without doc_id are left out; repeated rows
all stay; different texts under one doc_id are texts of their own, and classes
that have their smallest doc_id in common have the same class_id; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import symbols as sy
from .common import document_texts, partitions, ship_package, stored

K, TAKE, SKETCHES, SIMILARITY, SMALL, LEADERS, RUN = 5, 2, 12, 0.8, 5, 2, 100_000
#: Dense families: from so many pairs by word pair for each text and block on; texts and bytes of words a block;
#: columns of the matrix of common members; alignments at once; word pairs in one row.
DENSE, BLOCK, BLOCK_BYTES, COLUMNS, AT_ONCE, PIECE = 16, 128, 4 << 20, 4096, 256, 64
GROUP = ["sketch", "value"]
_POS = np.uint64((1 << 20) - 1)
_TOP = np.uint64(2**64 - 1)
_SEEDS = np.random.default_rng(4711).integers(1, 2**63, SKETCHES, dtype=np.uint64)


def sketches(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SKETCHES tuple hashes a text (zeros for texts without words).  ``h``:
    word hashes; ``first``: index of each text's first word, one entry more."""
    n = np.diff(first)
    out = np.zeros((len(n), SKETCHES), np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    count = np.maximum(n[some] - K + 1, 1)
    starts = np.cumsum(count) - count
    row = np.repeat(np.arange(len(some)), count)
    pos = np.arange(len(row)) - starts[row]
    at = first[some][row] + pos
    gram = sy.span_hash(sy.prefix_sums(h), at, np.minimum(at + K, first[some + 1][row]))
    # label by occurrence: equal k-mers of a text get different hashes
    key = sy.mix(gram + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    label = np.empty(len(key), np.uint64)
    label[order] = (np.arange(len(key)) - begin).astype(np.uint64)
    gram = sy.mix(gram + label * np.uint64(0xD1342543DE82EF95))
    place = np.minimum(pos, int(_POS)).astype(np.uint64)
    for i, seed in enumerate(_SEEDS):
        x = (sy.mix(gram ^ seed) & ~_POS) | place
        taken = []
        for _ in range(TAKE):
            least = np.minimum.reduceat(x, starts)
            taken.append(least)
            x = np.where(x == least[row], _TOP, x)
        taken = np.stack(taken, 1)
        text_order = np.argsort(taken & _POS, axis=1, kind="stable")
        taken = np.take_along_axis(taken & ~_POS, text_order, 1)
        value = np.full(len(some), np.uint64(i + 1))
        for j in range(TAKE):
            value = sy.mix(value * np.uint64(0x2545F4914F6CDD1D) + taken[:, j])
        out[some, i] = value
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text_key (128-bit hash), n_words, tuples (one hash a
    sketch) of rows (doc_id, text, text_hash)."""

    def run(batches):
        import xxhash

        for batch in batches:
            data, offsets = sy.utf8(batch.column(1))
            for a, b in sy.blocks(offsets):
                h, _, _, first = sy.words(data, offsets[a : b + 1])
                n = np.diff(first)
                tuples = sketches(h, first).view(np.int64)
                texts = (data[offsets[i] : offsets[i + 1]].tobytes() if n[i - a] else b"" for i in range(a, b))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(2)[a:b], pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                     pa.array(n, pa.int32()), pa.array(list(tuples), pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "text_key", "n_words", "tuples"],
                )

    return docs.mapInArrow(run, "doc_id long, text_hash long, text_key binary, n_words int, tuples array<long>")


def _distances(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> list[int]:
    """Edit distances of pairs of sequences, all in one pass; values above
    ``band`` mean just that."""
    n = np.array([len(x) for x, _ in pairs])
    m = np.array([len(y) for _, y in pairs])
    rows, width = len(pairs), 2 * band + 1
    x = np.full((rows, n.max() + 1), -1, np.int64)
    y = np.full((rows, max(n.max(), m.max()) + width + 1), -2, np.int64)
    for i, (a, b) in enumerate(pairs):
        x[i, : len(a)] = a
        y[i, band : band + len(b)] = b
    far = 1 << 20
    column = np.arange(width)
    # cell [k] of row i stands for (i, i + k - band)
    cost = np.where(column >= band, column - band, far) + np.zeros((rows, 1), np.int64)
    out = np.full(rows, far)
    end = m - n + band
    inside = (end >= 0) & (end < width)
    done = inside & (n == 0)
    out[done] = cost[done, end[done]]
    for i in range(1, int(n.max()) + 1):
        step = cost + (y[:, i - 1 : i - 1 + width] != x[:, i - 1 : i])
        step[:, : max(0, band - i + 1)] = far
        if i <= band:
            step[:, band - i] = i  # (i, 0)
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - column, axis=1) + column
        done = inside & (n == i)
        if done.any():
            out[done] = cost[done, end[done]]
    return out.tolist()


def _labelled(values: np.ndarray) -> np.ndarray:
    """Hashes labelled by occurrence, so that all differ; sorted."""
    values, at = np.sort(values), np.arange(len(values))
    begin = np.maximum.accumulate(np.where(np.append(True, values[1:] != values[:-1])[: len(values)], at, 0))
    return np.sort(sy.mix(values + (at - begin).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))


def word_pairs(words: np.ndarray) -> np.ndarray:
    """Hashes of all pairs of neighbouring words (of the word, if there is but
    one), labelled by occurrence, so that all differ."""
    sums = sy.prefix_sums(sy.mix(words.astype(np.uint64) + np.uint64(1)))
    at = np.arange(max(len(words) - 2, 0) + 1)
    return _labelled(sy.span_hash(sums, at, np.minimum(at + 2, len(words))))


def in_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each set on the left has in common with each one on the
    right.  Sets are hashes without repeats."""
    out = np.zeros((len(left), len(right)), np.float32)
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    word = np.concatenate(sets)
    both = np.intersect1d(word[row < len(left)], word[row >= len(left)])
    at = np.searchsorted(both, word)
    met = both[np.minimum(at, len(both) - 1)] == word if len(both) else np.zeros(len(word), bool)
    at, row = at[met], row[met]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    for a in range(0, len(both), COLUMNS):
        i, j = np.searchsorted(at, [a, a + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[i:j], at[i:j] - a] = 1
        out += has[: len(left)] @ has[len(left) :].T
    return out.astype(np.int64)


def links_between(left: list[tuple], right: list[tuple], similarity: float, spanning: bool = False) -> list[tuple]:
    """Links between texts (rep, root, word hashes) on the left and on the right
    that lie in different components; with ``spanning`` only as many of them as
    connect the same components."""
    n, m = (np.array([len(t[2]) for t in side]) for side in (left, right))
    label = np.unique([t[1] for t in (*left, *right)], return_inverse=True)[1]
    longest = np.maximum(n[:, None], m[None, :])
    limit = (longest * (1 - similarity) + 1e-9).astype(np.int64)
    # a distance is at least the number of words that the longer text has alone, and half that of its word pairs
    alone = longest - in_common(*([_labelled(sy.mix(t[2].astype(np.uint64))) for t in side] for side in (left, right)))
    pairs = np.maximum(longest - 1, 1) - in_common(*([word_pairs(t[2]) for t in side] for side in (left, right)))
    a, b = np.nonzero((alone <= limit) & (pairs <= 2 * limit) & (label[: len(left), None] != label[None, len(left) :]))
    order = np.argsort(alone[a, b] / longest[a, b], kind="stable")
    a, b, out = a[order], b[order], []
    while len(a):
        x, y, a, b = a[:AT_ONCE], b[:AT_ONCE], a[AT_ONCE:], b[AT_ONCE:]
        linked = edit_links([(left[i][2], right[j][2]) for i, j in zip(x, y)], similarity)
        for i, j in zip(x[linked], y[linked]):
            p, q = label[i], label[len(left) + j]
            if spanning and p == q:
                continue
            out.append((left[i][0], right[j][0]))
            if spanning:
                label[label == q] = p
        if spanning:
            apart = label[a] != label[len(left) + b]
            a, b = a[apart], b[apart]
    return out


def edit_links(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> list[bool]:
    """Whether 1 - distance / max(n, m) reaches ``similarity``, for each pair
    of word-hash sequences."""
    out = [False] * len(pairs)
    open_ = []
    for i, (a, b) in enumerate(pairs):
        longest = max(len(a), len(b))
        limit = int(longest * (1 - similarity) + 1e-9)
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        head = int(differ[0]) if len(differ) else m
        a, b = a[head:], b[head:]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[len(a) - m :][::-1] != b[len(b) - m :][::-1])
        tail = int(differ[0]) if len(differ) else m
        a, b = a[: len(a) - tail], b[: len(b) - tail]
        if min(len(a), len(b)) == 0:
            out[i] = max(len(a), len(b)) <= limit
            continue
        values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
        own = np.bincount(np.searchsorted(values, a), minlength=len(values))
        if max(len(a), len(b)) - np.minimum(own, counts - own).sum() <= limit:  # else too few common words
            open_.append((i, a, b, limit))
    band = 8
    while open_:
        open_.sort(key=lambda r: len(r[1]))
        later = []
        for at in range(0, len(open_), 64):
            part = open_[at : at + 64]
            for (i, a, b, limit), d in zip(part, _distances([(a, b) for _, a, b, _ in part], band)):
                if d <= band or band >= limit:
                    out[i] = d <= limit and d <= band
                else:
                    later.append((i, a, b, limit))
        open_, band = later, band * 4
    return out


def _read(words: pa.Scalar) -> np.ndarray:
    return np.frombuffer(words.as_buffer(), "<u4").astype(np.int64)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b, ...) with column ``linked``; texts: (rep, words)."""

    def check(batches):
        for batch in (b.slice(i, 4096) for b in batches for i in range(0, len(b), 4096)):
            a, b = batch.column("wa"), batch.column("wb")
            linked = edit_links([(_read(x), _read(y)) for x, y in zip(a, b)], similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked)], ["a", "b", "linked"])

    left = texts.select(F.col("rep").alias("a"), F.col("words").alias("wa"))
    right = texts.select(F.col("rep").alias("b"), F.col("words").alias("wb"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "wa", "wb")
    return both.mapInArrow(check, "a long, b long, linked boolean")


def _word_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Word hashes (32 bits a word) of the texts in ``ids`` (rep, text_key, and
    the doc_id of a document that has the text)."""

    def run(batches):
        import xxhash

        for batch in batches:
            data, offsets = sy.utf8(batch.column(1))
            out = []
            for a, b in sy.blocks(offsets):
                h, _, _, first = sy.words(data, offsets[a : b + 1])
                h = (h >> np.uint64(32)).astype("<u4")
                out += [h[first[i] : first[i + 1]].tobytes() for i in range(b - a)]
            # another text may stand under the same doc_id
            same = [xxhash.xxh3_128_digest(data[i:j].tobytes()) == k.as_py() for i, j, k in zip(offsets, offsets[1:], batch.column(2))]
            found = pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["rep", "words"])
            yield found.filter(pa.array(same, pa.bool_()))

    wanted = docs.join(ids, "doc_id").select("rep", "text", "text_key")
    return wanted.mapInArrow(run, "rep long, words binary").dropDuplicates(["rep"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component.  ``edges``:
    (a, b).  Alternating large-star and small-star contraction, written to the
    shared folder each round.  A node's least neighbour is its least parent (the
    smaller end of an edge), so the many children of a root meet in no window."""
    edges, last = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), None
    parents = Window.partitionBy("b")
    while True:
        least = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("m"))
        large = edges.join(least, F.col("a") == F.col("node"), "left").select(F.coalesce("m", "a").alias("a"), "b")
        # repeats go where the parents of a node meet; its least parent takes the node and its other parents
        small = large.withColumn("m", F.min("a").over(parents)).distinct()
        below = F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a"))
        edges = stored(small.select(F.col("m").alias("a"), below.alias("b")), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def links(docs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified links (a, b) between the ``texts`` (rep, text_key, doc_id,
    n_words, tuples); with them the members of the large groups and the word
    hashes of all texts in groups, for ``open_pairs``."""
    members = texts.where("n_words > 0").select("rep", "text_key", "doc_id", "n_words", F.posexplode("tuples").alias("sketch", "value"))
    sizes = members.groupBy(*GROUP).agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(sizes, GROUP), "groups")
    involved = members.select("rep", "text_key", "doc_id").dropDuplicates(["rep"])
    words = stored(_word_texts(docs, involved), "words")
    fits = F.least("n", "m") >= F.greatest("n", "m") * (similarity - 1e-9)
    small = members.where(F.col("size") <= SMALL)
    one = small.select(*GROUP, F.col("rep").alias("a"), F.col("n_words").alias("n"))
    two = small.select(*GROUP, F.col("rep").alias("b"), F.col("n_words").alias("m"))
    pairs = one.join(two, GROUP).where("a < b").where(fits).select("a", "b")
    large = members.where(F.col("size") > SMALL).select(*GROUP, "rep", "n_words", "size")
    common = members.groupBy("rep").agg(F.sum("size").alias("common"))
    best = Window.partitionBy(*GROUP).orderBy(F.desc("common"), "rep")
    first = large.join(common, "rep").withColumn("place", F.row_number().over(best)).where(F.col("place") <= LEADERS)
    first = first.select(*GROUP, F.col("rep").alias("a"), F.col("n_words").alias("n"))
    led = large.join(first, GROUP).where(F.col("a") != F.col("rep")).withColumn("m", F.col("n_words")).where(fits)
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / RUN))  # runs of bounded length
    by_length = Window.partitionBy(*GROUP, part).orderBy("n_words", "rep")
    chained = large.select(F.lag("rep").over(by_length).alias("a"), "rep").where("a is not null")
    near = led.select("a", "rep").unionByName(chained).select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b"))
    return _linked(pairs.unionByName(near).distinct(), words, similarity), large, words


def _linked(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    return stored(_verified(pairs, words, similarity), "links").where("linked").select("a", "b")


def _least_common(n, similarity: float):
    """Texts of n word pairs have at least so many in common with similar ones."""
    return F.greatest(F.ceil((2 * similarity - 1) * (n + 1) - 1 - 1e-9), F.lit(1))


def _ahead(grams: DataFrame, similarity: float) -> DataFrame:
    """The word pairs (``met``, in order, each with its number of texts) of each text
    of ``grams`` (rep, root, label, n, grams: pieces of its n word pairs, dealt out
    evenly before they become rows) by which it meets all similar texts under other
    labels; texts that can have none are left out.  One row a text; ``own``: word
    pairs that no other label has."""
    each = grams.repartition(partitions(grams.sparkSession)).select("rep", "root", "label", "n", F.explode("grams").alias("gram"))
    same = Window.partitionBy("gram")  # one exchange by word pair, where counts joined back would take two
    met = each.select("*", F.count("*").over(same).alias("texts"), F.min("label").over(same).alias("lo"), F.max("label").over(same).alias("hi")).where("lo < hi")
    # the order of all word pairs: those of one label, then by number of texts, then by hash
    met = met.groupBy("rep", "root", "label", "n").agg(F.array_sort(F.collect_list(F.struct("texts", "gram"))).alias("met"))
    own = F.col("n") - F.size("met")
    first = F.col("n") - _least_common(F.col("n"), similarity) + 1  # so many first word pairs must meet
    met = met.withColumn("own", own).withColumn("first", (first - own).cast("int")).where("first > 0")
    return stored(met.select("rep", "root", "label", "n", "own", F.slice("met", F.lit(1), F.col("first")).alias("met")), "ahead")


def _ahead_rows(ahead: DataFrame) -> DataFrame:
    """A row for each word pair (gram) ahead; ``rest``: word pairs from this one on,
    the most that can be common where it is the first in common."""
    each = ahead.select("rep", "root", "label", "n", "own", F.posexplode("met").alias("place", "x"))
    return each.select(F.col("x.gram").alias("gram"), "rep", "root", "label", "n", (F.col("n") - F.col("own") - F.col("place")).alias("rest"))


def _dense_families(open_groups: DataFrame, ahead: DataFrame) -> DataFrame:
    """(rep, family) of the texts to compare that large groups (GROUP, rep)
    connect, in families where many of them meet by the same word pairs: there a
    row for each two that meet is more than all their texts in blocks.  How many
    meet is counted from above, by all texts that have a word pair ahead, so no
    word pair becomes a row for it; either way finds the same links."""
    others = F.aggregate("met", F.lit(0).cast("long"), lambda total, x: total + x.texts - 1)
    texts = ahead.select("rep", others.alias("others"))
    edges = open_groups.join(texts, "rep", "left_semi").select(F.col("rep").alias("a"), F.xxhash64(*GROUP).alias("b"))
    found = components(edges)
    family = texts.join(found, F.col("rep") == F.col("node"), "left").select("rep", "others", F.coalesce("root", "rep").alias("family"))
    family = stored(family, "families")
    size = family.groupBy("family").agg(F.count("*").alias("texts"), (F.sum("others") / 2).alias("pairs"))
    dense = size.where(F.col("pairs") > DENSE * F.col("texts") * F.ceil(F.col("texts") / BLOCK))
    return stored(family.join(dense, "family", "left_semi").select("rep", "family"), "dense")


def _family_links(texts: DataFrame, similarity: float, spanning: bool) -> DataFrame:
    """Links (a, b) between texts (family, rep, root, words) of one family and
    different components.  Texts lie in blocks by length, those of a large
    component in blocks of their own; each two blocks that may hold links meet in
    one task, so it keeps two blocks at a time and no row is made for a pair."""
    step = float(-np.log(similarity)) + 1e-6  # similar texts lie at most one step of length apart
    sizes = texts.groupBy("family", "root").agg(F.count("*").alias("own"))
    length = F.floor(F.log(F.length("words") / 4) / step)
    texts = texts.join(sizes, ["family", "root"]).withColumn("alone", F.when(F.col("own") > BLOCK, F.col("root"))).withColumn("length", length)
    texts = texts.withColumn("part", F.xxhash64("alone", "length"))
    parts = texts.groupBy("family", "part").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("words")) / BLOCK_BYTES)).alias("blocks"))
    block = F.xxhash64("part", F.pmod(F.xxhash64("rep", F.lit(1)), "blocks"))
    texts = stored(texts.join(parts, ["family", "part"]).select("family", block.alias("block"), "alone", "length", "rep", "root", "words"), "blocks")
    blocks = texts.groupBy("family", "block").agg(F.first("alone").alias("alone"), F.first("length").alias("length"))
    one = blocks.select("family", F.col("block").alias("x"), F.col("alone").alias("x_alone"), F.col("length").alias("x_length"))
    two = blocks.select("family", F.col("block").alias("y"), F.col("alone").alias("y_alone"), F.col("length").alias("y_length"))
    meet = (F.col("x") <= F.col("y")) & (F.abs(F.col("x_length") - F.col("y_length")) <= 1)
    meet &= F.coalesce(F.col("x_alone") != F.col("y_alone"), F.lit(True))
    meet = one.join(two, "family").where(meet).select("family", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    sent = texts.select("family", "block", "rep", "root", "words").join(meet, ["family", "block"])

    def compare(met: pa.Table) -> pa.Table:
        x, y = met.column("x")[0].as_py(), met.column("y")[0].as_py()
        at = {x: [], y: []}
        for block, rep, root, words in zip(*(met.column(c) for c in ("block", "rep", "root", "words"))):
            at[block.as_py()].append((rep.as_py(), root.as_py(), _read(words)))
        found = links_between(at[x], at[y], similarity, spanning)
        found = sorted({(min(p), max(p)) for p in found})
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    sent = sent.repartition(partitions(texts.sparkSession), "family", "x", "y")  # little to read, much to compare
    return sent.groupBy("family", "x", "y").applyInArrow(compare, "a long, b long")


def open_links(large: DataFrame, roots: DataFrame, words: DataFrame, similarity: float = SIMILARITY, spanning: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """For texts of large groups, in different components (``roots``: node, root):
    pairs (a, b) still to be verified and, of dense families, links (None where
    there is no such family; with ``spanning`` as many as connect the same
    components).  Together they hold all pairs of the wanted edit similarity."""
    rooted = large.select(*GROUP, "rep").join(roots, F.col("rep") == F.col("node"), "left")
    rooted = stored(rooted.select(*GROUP, "rep", F.coalesce("root", "rep").alias("root")), "rooted")
    several = rooted.groupBy(*GROUP).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    open_groups = rooted.join(several.select(*GROUP), GROUP, "left_semi")
    waiting = open_groups.select("rep", "root").distinct()

    def run(batches):
        for batch in batches:
            out = []
            for rep, root, w in zip(*batch.columns):
                pairs = word_pairs(np.frombuffer(w.as_buffer(), "<u4")).view(np.int64)
                out += [(rep.as_py(), root.as_py(), len(pairs), pairs[i : i + PIECE]) for i in range(0, len(pairs), PIECE)]
            columns = zip(*out) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, columns), schema)], schema=schema)

    schema = pa.schema([("rep", pa.int64()), ("root", pa.int64()), ("n", pa.int32()), ("grams", pa.list_(pa.int64()))])
    grams = words.join(waiting, "rep").select("rep", "root", "words").mapInArrow(run, "rep long, root long, n int, grams array<long>")
    grams = stored(grams, "grams")
    ahead, found = _ahead(grams.withColumn("label", F.col("root")), similarity), None
    dense = _dense_families(open_groups, ahead)
    if not dense.isEmpty():
        found = _family_links(words.join(dense, "rep").join(waiting, "rep"), similarity, spanning)
        # what else they meet: texts of a family have its name for a label, others the one of their component
        labelled = grams.join(ahead, "rep", "left_semi").join(dense, "rep", "left")
        name = F.when(F.col("family").isNotNull(), F.xxhash64("family", F.lit("family")))  # not the name of a component
        ahead = _ahead(labelled.withColumn("label", F.coalesce(name, "root")), similarity)
    columns = ("rep", "root", "label", "n", "rest")
    rows = _ahead_rows(ahead)
    one = rows.select("gram", *(F.col(c).alias(f"a_{c}") for c in columns))
    two = rows.select("gram", *(F.col(c).alias(f"b_{c}") for c in columns))
    longer, shorter = F.greatest("a_n", "b_n"), F.least("a_n", "b_n")
    enough = (F.least("a_rest", "b_rest") >= _least_common(longer, similarity)) & (shorter + 1 >= (longer + 1) * similarity - 1e-6)
    apart = (F.col("a_root") != F.col("b_root")) & (F.col("a_label") != F.col("b_label"))
    pairs = one.join(two, "gram").where((F.col("a_rep") < F.col("b_rep")) & apart & enough)
    return pairs.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct(), found


def open_pairs(large: DataFrame, roots: DataFrame, words: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of texts of large groups, in different components (``roots``:
    node, root), that may have the edit similarity: all that have it, and few
    others."""
    pairs, found = open_links(large, roots, words, similarity, spanning=False)
    return pairs if found is None else pairs.unionByName(found).distinct()


def linked_components(docs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of the texts that have a link."""
    found, large, words = links(docs, texts, similarity)
    roots = components(found)
    pairs, more = open_links(large, roots, words, similarity)
    verified = _linked(pairs, words, similarity)
    more = verified if more is None else stored(verified.unionByName(more), "more")
    if more.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def _classified(docs: DataFrame, similarity: float) -> DataFrame:
    """doc_id, text_hash, root (one text of the class) and class_id of each row."""
    ship_package(docs.sparkSession)
    docs = document_texts(docs)
    signed = stored(signatures(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))), "signatures")
    texts = signed.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("tuples").alias("tuples"))
    texts = stored(texts.withColumn("rep", F.xxhash64("text_key")), "texts")
    roots = linked_components(docs, texts, similarity)
    named = texts.select("text_key", "doc_id", "rep").join(roots, F.col("rep") == F.col("node"), "left")
    named = named.select("text_key", "doc_id", F.coalesce("root", "rep").alias("root"))
    ids = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = named.join(ids, "root").select("text_key", "root", "class_id")
    return signed.select("doc_id", "text_hash", "text_key").join(named, "text_key").drop("text_key")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class) and kept (whether
    the document is that one)."""
    return _classified(docs, similarity).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def kept_documents(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class, with its columns: the one with the
    smallest doc_id (of several texts under it the one with the smallest hash)."""
    keep = _classified(docs, similarity).where("doc_id = class_id")
    keep = keep.groupBy("root").agg(F.min("class_id").alias("doc_id"), F.min("text_hash").alias("text_hash"))
    given = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("given")
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]
    rows = docs.select(given, *key).join(keep.drop("root"), ["doc_id", "text_hash"], "left_semi")
    rows = rows.dropDuplicates(["doc_id", "text_hash"])
    return rows.select(*(F.col("given").getField(c).alias(c) for c in docs.columns))
