"""Lookup of a hot or null key, without adaptive skew handling.

AQE splits a skewed join at run time.  Where it is off, ``look_up`` evens the
join out by itself:

* keys with more than 1 / ``SHARES`` of a shuffle partition's fair share are
  found by an exact count of the key column; there are fewer than ``SHARES`` x
  partitions of them, whatever the data, so their list is broadcast;
* the rows of such a key are dealt into pieces of at most 1 / ``FINE`` of a fair
  share by a hash of the row, and the one looked-up row of the key is repeated
  once a piece (at most ``FINE`` + ``SHARES`` copies a partition, all keys together);
* rows without a key match nothing and are dealt out by the hash alone.

The piece depends on the values of the row only, so a task that runs again deals
its rows out alike.  Equal rows share a piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARES, FINE = 4, 16


def splits_skew(spark: SparkSession) -> bool:
    """Whether Spark itself splits skewed joins in this session."""
    return all(
        spark.conf.get(name, "true").lower() == "true"
        for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with ``table``, whose ``key`` is unique: a plain
    join where AQE handles skew, else ``salted_look_up``."""
    if splits_skew(rows.sparkSession):
        return rows.join(table, key, "left")
    return salted_look_up(rows, table, key)


def heavy_keys(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """(key, pieces) of the keys with more than 1 / (``SHARES`` x ``parts``) of
    all rows that have a key: fewer than ``SHARES`` x ``parts`` rows."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    share = F.col("n") * parts / total
    return counts.where(share * SHARES > 1).select(key, F.ceil(share * FINE).cast("int").alias("pieces"))


def salted_look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """All columns of ``rows`` and the other columns of ``table``; every row
    once, with nulls where the key is null or not in ``table``.  An empty table
    on either side is fine; the helper columns' names avoid those given."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = {c.lower() for c in (*rows.columns, *table.columns)}
    pieces, piece = (_free(name, taken) for name in ("pieces", "piece"))
    heavy = F.broadcast(heavy_keys(rows, key, parts).withColumnRenamed("pieces", pieces))

    at = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns))
    dealt = F.when(F.col(key).isNull(), F.pmod(at, F.lit(parts * FINE))).otherwise(F.pmod(at, F.coalesce(pieces, F.lit(1))))
    left = rows.join(heavy, key, "left").withColumn(piece, dealt.cast("int")).drop(pieces)
    copies = F.sequence(F.lit(0), F.coalesce(pieces, F.lit(1)) - 1)
    right = table.join(heavy, key, "left").withColumn(piece, F.explode(copies)).drop(pieces)
    joined = left.join(right, [key, piece], "left")
    return joined.select(*(F.col(f"`{c}`") for c in [*rows.columns, *(c for c in table.columns if c != key)]))


def irregular_keys(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """(key, copies) of the keys in ``rows`` that ``table`` has not exactly once:
    0 where it lacks the key.  Only keys move, not the columns beside them."""
    wanted = rows.where(F.col(key).isNotNull()).select(key).distinct()
    found = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    both = wanted.join(found, key, "left").select(key, F.coalesce("copies", F.lit(0)).cast("int").alias("copies"))
    return both.where(F.col("copies") != 1)


def look_up_known(rows: DataFrame, irregular: DataFrame, key: str, known: str) -> DataFrame:
    """``rows`` and whether their key is known, as a left join with the table
    behind ``irregular_keys`` gives them: once a copy of the key there, once
    (with null) where it is unknown.  Where few keys are irregular their stored
    list is small, and Spark sends it to the rows."""
    copies, copy = (_free(name, {c.lower() for c in (*rows.columns, known)}) for name in ("copies", "copy"))
    marked = _with_copies(rows, irregular, key, copies)
    repeated = marked.withColumn(copy, F.explode(F.array_repeat(F.lit(True), F.greatest(copies, F.lit(1)))))
    return repeated.select(*(F.col(f"`{c}`") for c in rows.columns), F.when(F.col(copies) > 0, F.lit(True)).alias(known))


def blank_unknown(rows: DataFrame, irregular: DataFrame, key: str) -> DataFrame:
    """``rows``, each once, with null for a key that the table lacks."""
    copies = _free("copies", {c.lower() for c in rows.columns})
    return _with_copies(rows, irregular, key, copies).withColumn(key, F.when(F.col(copies) > 0, F.col(key))).select(*rows.columns)


def _with_copies(rows: DataFrame, irregular: DataFrame, key: str, copies: str) -> DataFrame:
    n = F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.coalesce(copies, F.lit(1)))
    return look_up(rows, irregular.select(key, F.col("copies").alias(copies)), key).withColumn(copies, n)


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name
