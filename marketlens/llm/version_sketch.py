"""Document fingerprints that can be subtracted: invertible Bloom lookup tables.

DataFrame functions only.  A paragraph is a line, cut after each of its
sentences; a stretch of more than ``LONG`` characters without such an end is
cut after about one word in ``LONG_WORDS``, chosen by the word's hash (a cut
that only the text nearby decides).  The digests of a text's distinct
paragraphs are its set.  Each digest goes into
three cells of a table, one in each third; a cell keeps the number of digests,
their exclusive-or and that of their check hashes.  Subtracting the table of
another version cancels what both have; peeling then recovers the differing
digests from pure cells (with a single digest), one third of the table a round:
there each digest has one cell, so none is taken out twice.  Tables that don't
peel in ``ROUNDS`` rounds are built anew, twice as large and with other hash
functions, until all have.  The likeness of two texts is
(|A| + |B| - d) / (|A| + |B| + d) with d recovered digests, the Jaccard
similarity of their paragraph sets; two empty sets are alike (1.0).

The fingerprint is the text's own table of ``CELLS`` cells, as text.

Next documents: ids are divided into ranges at approximate quantiles; a window
runs inside each range, and the first document of the following range is added
to each.  Rows with one doc_id are ordered by text hash.  Null texts count as
empty, rows without doc_id are left out, an empty table gives no rows, extra
columns are ignored; a lone document is its own next.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_texts, partitions, stored

CELLS, ROUNDS, ROOM = 24, 6, 2.5
PARAGRAPH_END = "\n|(?<=[.!?]) "
LONG, LONG_WORDS = 16384, 64


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs that are not blank."""
    ends = lambda w: F.pmod(F.xxhash64(w), F.lit(LONG_WORDS)) == 0
    marked = lambda p: F.array_join(F.transform(F.split(p, " "), lambda w: F.concat(w, F.when(ends(w), "\n").otherwise(" "))), "")
    cut = lambda p: F.when(F.length(p) > LONG, F.split(marked(p), "\n")).otherwise(F.array(p))
    parts = F.flatten(F.transform(F.split(text, PARAGRAPH_END), cut))
    parts = F.filter(parts, lambda p: F.btrim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def _places(key: Column, cells: Column, salt: int) -> Column:
    """The cell of a digest in each third of a table."""
    third = F.floor(cells / 3).cast("long")
    return F.array(*(F.pmod(F.xxhash64(key, F.lit(salt * 3 + i)), third) + third * i for i in range(3)))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Number of bounds below a value, by two short searches."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda xs: F.size(F.filter(xs, lambda b: b < value))
    heads = F.array(*(F.lit(g[-1]) for g in groups)) if groups else F.array().cast("array<bigint>")
    coarse = below(heads)
    table = F.array(*(F.array(*map(F.lit, g)) for g in groups), F.array().cast("array<bigint>"))
    return (coarse * step + below(F.element_at(table, coarse + 1))).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text (of the next smaller doc_id; of the largest
    after the smallest)."""
    spark = docs.sparkSession
    n = 4 * partitions(spark)
    share = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx("doc_id", share, 10 * n).alias("b")).first().b or []
    bounds = sorted({int(b) for b in bounds})
    ranged = docs.withColumn("range", _range_of(F.col("doc_id"), bounds))
    # at most one row a range, on the driver
    tops = sorted((r.range, r.top) for r in ranged.select("range", "doc_id").groupBy("range").agg(F.max("doc_id").alias("top")).collect())
    follow = [(tops[i - 1][1], tops[i][0]) for i in range(len(tops))]  # (first id of the following range, range)
    helpers = spark.createDataFrame(follow, "doc_id long, range int")
    own = ranged.withColumn("helper", F.lit(False))
    added = docs.join(F.broadcast(helpers), "doc_id").withColumn("helper", F.lit(True))
    order = Window.partitionBy("range").orderBy("helper", F.desc("doc_id"), F.desc(F.xxhash64("text")))
    both = own.unionByName(added).withColumn("next_text", F.lead("text").over(order))
    return both.where(~F.col("helper")).select("doc_id", "text", "next_text")


def versions(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_chars, edited_sha256 and the digest sets own, edited, next."""
    n = F.length("text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - tail), F.substr("next_text", F.lit(1), tail))
    rows = with_next(document_texts(docs)).select("doc_id", "text", "next_text", edited.alias("edited"))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("edited"),
        digests(F.col("next_text")).alias("next"),
    )


def fingerprints(rows: DataFrame) -> DataFrame:
    """row, fingerprint, edited_fingerprint: tables of CELLS cells as text,
    ``cell:count:keys:checks`` for each cell in use, by cell."""
    marked = lambda c, side: F.transform(c, lambda d: F.struct(F.lit(side).alias("side"), d.alias("key")))
    sides = F.array(marked("own", 0), marked("edited", 1))
    # dealt out by row once: all that follows stays in its partition
    each = rows.repartition(4 * partitions(rows.sparkSession), "row").select("row", F.explode(F.flatten(sides)).alias("x")).select("row", "x.side", "x.key")
    cells = each.select("row", "side", "key", _check(F.col("key")).alias("check"), F.explode(_places(F.col("key"), F.lit(CELLS), 0)).alias("cell"))
    cells = cells.groupBy("row", "side", "cell").agg(F.count("*").alias("n"), F.expr("bit_xor(key)").alias("k"), F.expr("bit_xor(check)").alias("c"))
    text = F.concat_ws(":", F.lpad(F.col("cell").cast("string"), 2, "0"), "n", F.hex("k"), F.hex("c"))
    pick = lambda side: F.concat_ws(" ", F.array_sort(F.collect_list(F.when(F.col("side") == side, text))))
    return cells.groupBy("row").agg(pick(0).alias("fingerprint"), pick(1).alias("edited_fingerprint"))


def differences(pairs: DataFrame, salt: int, tasks: int) -> DataFrame:
    """Peel the difference of two tables a row of ``pairs`` (row, kind, a, b,
    cells), dealt out to ``tasks``.  Returns row, kind, found (recovered digests), done; pairs whose
    tables cancel altogether have no row.  Empty cells are left out."""
    signed = F.flatten(
        F.array(
            F.transform("a", lambda d: F.struct(d.alias("key"), F.lit(1).alias("n"))),
            F.transform("b", lambda d: F.struct(d.alias("key"), F.lit(-1).alias("n"))),
        )
    )
    group = ["row", "kind", "cells", "cell"]
    dealt = pairs.repartition(tasks, "row").select("row", "kind", "cells", F.explode(signed).alias("x"))
    zero = F.lit(0).cast("long")
    key = F.col("x.key")
    table = dealt.select(
        "row", "kind", "cells", key.alias("key"), _check(key).alias("check"), F.col("x.n").cast("long").alias("n"),
        F.explode(_places(key, F.col("cells"), salt)).alias("cell"),
    )
    table = table.groupBy(*group).agg(F.sum("n").alias("n"), F.expr("bit_xor(key)").alias("key"), F.expr("bit_xor(check)").alias("check"))
    rest = (F.col("n") != 0) | (F.col("key") != 0) | (F.col("check") != 0)
    table = table.where(rest).withColumn("found", zero)
    third = F.floor(F.col("cells") / 3)
    for i in range(ROUNDS):
        pure = (F.floor(F.col("cell") / third) == i % 3) & (F.abs("n") == 1) & (F.col("check") == _check(F.col("key")))
        places = _places(F.col("key"), F.col("cells"), salt)
        keep = F.struct("cell", "n", "key", "check", "found")
        take = lambda p: F.struct(p.alias("cell"), (-F.col("n")).alias("n"), F.col("key"), F.col("check"), zero.alias("found"))
        mine = F.struct("cell", zero.alias("n"), zero.alias("key"), zero.alias("check"), (F.col("found") + 1).alias("found"))
        others = F.transform(F.filter(places, lambda p: p != F.col("cell")), take)
        events = F.when(pure, F.concat(F.array(mine), others)).otherwise(F.array(keep))
        rows = table.select("row", "kind", "cells", F.explode(events).alias("e")).select("row", "kind", "cells", "e.*")
        table = rows.groupBy(*group).agg(
            F.sum("n").alias("n"), F.expr("bit_xor(key)").alias("key"), F.expr("bit_xor(check)").alias("check"), F.sum("found").alias("found")
        ).where(rest | (F.col("found") != 0))
    return table.groupBy("row", "kind").agg(F.sum("found").alias("found"), (~F.max(rest)).alias("done"))


def likenesses(rows: DataFrame) -> DataFrame:
    """row, near_edited, near_next."""
    kinds = F.array(
        *(F.struct(F.lit(k).alias("kind"), F.col("own").alias("a"), F.col(k).alias("b")) for k in ("edited", "next"))
    )
    pairs = rows.select("row", F.explode(kinds).alias("p")).select("row", "p.*")
    total = F.size("a") + F.size("b")
    left, results, attempt = pairs, [], 0
    all_pairs, most = 2 * rows.count(), 8 * partitions(rows.sparkSession)
    tasks = most
    while True:
        size = F.greatest(F.lit(CELLS), 3 * F.ceil(total * ROOM * 2**attempt / 3)).cast("long")
        got = stored(differences(left.withColumn("cells", size), attempt + 1, tasks), "peeled")
        results.append(got.where("done").drop("done"))
        failed = got.where(~F.col("done")).select("row", "kind")
        n = failed.count()
        if not n:
            break
        # each task has maps for all rounds, however few pairs it gets; those that are left are the larger ones
        tasks = min(most, ceil(2 * most * n / all_pairs))
        left, attempt = pairs.join(failed, ["row", "kind"], "left_semi"), attempt + 1
    peeled = results[0]
    for r in results[1:]:
        peeled = peeled.unionByName(r)
    sizes = rows.select("row", F.size("own").alias("own"), F.size("edited").alias("edited"), F.size("next").alias("next"))
    found = peeled.groupBy("row").agg(*(F.max(F.when(F.col("kind") == k, F.col("found"))).alias(f"d_{k}") for k in ("edited", "next")))

    def near(k):
        both, d = F.col("own") + F.col(k), F.coalesce(f"d_{k}", F.lit(0))
        return F.when(both == 0, F.lit(1.0)).otherwise((both - d) / (both + d))

    return sizes.join(found, "row", "left").select("row", near("edited").alias("near_edited"), near("next").alias("near_next"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    rows = stored(versions(docs), "versions")
    out = (
        rows.select("row", "doc_id", "n_chars", "edited_sha256")
        .join(fingerprints(rows), "row", "left")
        .join(likenesses(rows), "row", "left")
    )
    return out.select(
        "doc_id", "n_chars", "edited_sha256", *(F.coalesce(c, F.lit("")).alias(c) for c in ("fingerprint", "edited_fingerprint")),
        "near_edited", "near_next",
    )
