"""Quality rules for documents, with DataFrame functions only.

Base figures come from the text itself (see ``base_figures``).  The method then
looks across documents: lines are normalised and hashed, and for each host (the
``source`` column) the distinct documents with a line are counted; exact copies
of a text count once, so that a copied text does not condemn its own lines.  A
line, of any length, found in more than ``LINE_DOCS`` of a host's distinct documents is removed,
whatever the size of the host.
A document is rejected if less than ``KEPT_SHARE`` of its characters in lines
is left; the texts of the others lose these lines (with their line break), all
other lines stay as they are and in order.

A line may be in a third of all documents: lines are counted with map-side
partial sums, and the join of documents' lines with removed lines is an
equi-join that adaptive execution splits where it is skewed.  Rows are written
once with their figures and line hashes (and their columns, where texts are
wanted); from then on only hashes and the places of removed lines travel.  These
places are broadcast if they take at most ``BROADCAST_BYTES``, as counted before,
and else meet the rows in a shuffled join; the rows are the same.

Null texts count as empty and fail the base rules; a null source is a host of
its own; rows without doc_id are left out; repeated rows all stay; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LINE_DOCS, KEPT_SHARE = 20, 0.3
BROADCAST_BYTES = 32 << 20
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
_SPACES = "[\\x20\\x09-\\x0D]+"
_BLANK = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def quad_hashes(words: Column) -> Column:
    """Hash of 4 consecutive words at each word (fewer at the end): pairs, and pairs of pairs."""
    pairs = F.zip_with(words, _from(words, 1), lambda a, b: F.xxhash64(a, b))
    return F.zip_with(pairs, _from(pairs, 2), lambda a, b: F.xxhash64(a, b))


def window_hashes(quads: Column) -> Column:
    """Hash of each window of 8 consecutive words (none for texts of fewer words)."""
    return F.slice(F.zip_with(quads, _from(quads, 4), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.size(quads) - (WINDOW - 1), F.lit(0)))


def _from(values: Column, skipped: int) -> Column:
    return F.slice(values, F.lit(skipped + 1), F.greatest(F.size(values), F.lit(1)))


def base_figures(docs: DataFrame, columns: list[str]) -> DataFrame:
    """row (a number of its own), given (struct of these columns), text_key (hash
    of host and text), doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, line_chars and lines (hash of host and line, length and
    place among all lines, from 1, of each line with a word)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    host = F.col("source").cast("string")
    host = F.xxhash64(host.isNull(), F.coalesce(host, F.lit("")))
    given = [F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in columns)).alias("given")] if columns else []
    out = docs.where(F.col("doc_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        *given,
        F.col("doc_id").cast("long").alias("doc_id"),
        host.alias("host"),
        text.alias("text"),
        words_of(text).alias("words"),
        F.filter(
            F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("at"))),
            lambda line: F.btrim(line["x"], F.lit(_BLANK)) != "",
        ).alias("placed"),
    )
    out = out.withColumn("all_lines", F.transform("placed", lambda x: x["x"]))
    out = out.withColumn("quads", quad_hashes(F.col("words")))
    # 8 words can only repeat where 4 do; most texts need no more than that
    some = F.size(F.array_distinct("quads")) < F.size("quads")
    out = out.withColumn("windows", F.when(some, window_hashes(F.col("quads"))))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    out = out.withColumn("sorted", F.when(some, F.sort_array(placed))).withColumn("again", repeated_places(F.col("sorted")))
    line = lambda x: F.lower(F.regexp_replace(F.btrim(x, F.lit(_BLANK)), _SPACES, " "))
    return out.select(
        "row",
        *(["given"] if columns else []),
        "doc_id",
        F.xxhash64("host", "text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("all_lines") - F.size(F.array_distinct("all_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered_words(F.col("again")), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.length(F.array_join("all_lines", "")).cast("long").alias("line_chars"),
        F.transform(
            "placed",
            lambda p: F.struct(F.xxhash64("host", line(p["x"])).alias("line"), F.length(p["x"]).alias("chars"), p["at"].alias("at")),
        ).alias("lines"),
    )


def repeated_places(windows: Column) -> Column:
    """Ascending places of the windows (h, at), sorted, whose hash a neighbour has too."""
    same = F.zip_with(windows, _from(windows, 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    before = F.concat(F.array(F.lit(False)), same)
    either = F.zip_with(windows, F.zip_with(same, before, lambda a, b: a | F.coalesce(b, F.lit(False))), lambda w, d: F.when(d, w["at"]))
    return F.sort_array(F.filter(either, lambda at: at.isNotNull()))


def covered_words(at: Column) -> Column:
    """Words covered by windows at these ascending places."""
    covered = F.zip_with(at, _from(at, 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))


def frequent_lines(base: DataFrame) -> DataFrame:
    """Hashes (of host and line) above the limit."""
    texts = base.select("text_key", F.array_distinct(F.transform("lines", lambda x: x["line"])).alias("lines"))
    lines = texts.dropDuplicates(["text_key"]).select(F.explode("lines").alias("line"))
    return lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > LINE_DOCS).select("line")


def removed_lines(base: DataFrame) -> DataFrame:
    """row, removed_chars and removed_at (places in order) of the rows with a
    frequent line; broadcast where small."""
    own = base.select("row", F.inline("lines"))
    found = own.join(frequent_lines(base), "line").groupBy("row")
    found = found.agg(F.sum("chars").alias("removed_chars"), F.sort_array(F.collect_list("at")).alias("removed_at"))
    found = stored(found, "line-removed")
    n_rows, n_places = found.agg(F.count("*"), F.coalesce(F.sum(F.size("removed_at")), F.lit(0))).first()
    return F.broadcast(found) if 80 * n_rows + 4 * n_places <= BROADCAST_BYTES else found


def verdicts(docs: DataFrame, columns: list[str]) -> DataFrame:
    """One row per row of ``docs``: its ``columns`` as struct ``given``, doc_id,
    all figures and removed_at (places of the removed lines in order, null for none)."""
    base = stored(base_figures(docs, columns), "line-base")
    out = base.drop("lines", "text_key").join(removed_lines(base.drop("given")), "row", "left")
    out = out.withColumn("removed_chars", F.coalesce("removed_chars", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("line_chars") - F.col("removed_chars")) < KEPT_SHARE * F.col("line_chars")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def without_lines(text: Column, at: Column) -> Column:
    """``text`` without the lines at these places (ascending, from 1)."""
    lines = F.split(text, "\n")
    before = F.concat(F.array(F.lit(0)), at)
    after = F.concat(at, F.array(F.size(lines) + 1))
    runs = F.zip_with(before, after, lambda a, b: F.slice(lines, a + 1, b - a - 1))
    return F.when(at.isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n"))


def judged(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, line_chars, removed_chars; with ``with_text`` also
    kept_text, the text without the removed lines (null where not kept)."""
    figures = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "line_chars", "removed_chars",
    ]
    if not with_text:
        return verdicts(docs, []).select(*figures)
    text = without_lines(F.coalesce("given.text", F.lit("")), F.col("removed_at"))
    return verdicts(docs, ["text"]).select(*figures, F.when(F.col("kept"), text).alias("kept_text"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns; ``text`` is
    without the removed lines, and ``n_chars``, if there is one, is counted anew
    where lines went.  Where rows share a doc_id, each row is judged by itself."""
    rows = verdicts(docs, docs.columns).where("kept")
    gone = F.col("removed_at")
    types = dict(docs.dtypes)

    def column(name: str) -> Column:
        old = F.col("given").getField(name)
        if name == "text":
            return without_lines(old, gone).alias(name)
        if name == "n_chars":
            left = F.length(without_lines(F.col("given.text"), gone)).cast(types[name])
            return F.when(gone.isNull(), old).otherwise(left).alias(name)
        return old.alias(name)

    return rows.select(*map(column, docs.columns))
