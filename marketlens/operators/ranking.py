"""Distributed global ranking: ROW_NUMBER / NTILE / PERCENT_RANK / running sums
over a whole relation *without* a single-partition window.

A window with no ``PARTITION BY`` makes Spark move every row into one task
(``Exchange SinglePartition``).  At person or seller grain that is the one
step that would not survive a large cluster, so every global ranking in the
library goes through this module instead:

1. ``repartitionByRange(n, order...)`` + ``sortWithinPartitions`` — Spark
   samples the sort key and cuts the relation into ``n`` contiguous ranges.
   Callers always end the order with a unique tie key, so even a tie group
   holding a third of all rows is split across ranges.
2. Each row records its range (``spark_partition_id``) and its position in
   the range (``monotonically_increasing_id`` minus the partition base) —
   both deterministic after a total sort — and the frame is written as a
   Parquet table under the cluster's checkpoint directory.  The written
   table freezes the ranges so the counting pass and the numbering pass see
   the same assignment, it cuts the lineage, and it survives executor loss.
3. Per-range counts (and sums) — one row per range — give each range its
   offset; that tiny table (bounded by ``n``) is broadcast back.

NTILE and PERCENT_RANK are closed-form functions of the global row number,
the total, and (for ties) a per-key count, matching the SQL definitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import checkpoint_root, drop_scratch, ensure_checkpoint_dir, shuffles_go, track_scratch

_PID = "__rk_pid"
_POS = "__rk_pos"
_CNT = "__rk_cnt"
_SUM = "__rk_sum"
_OFF = "__rk_off"
_SOFF = "__rk_soff"
_N = "__rk_n"
_TOT = "__rk_tot"
_LOCAL = "__rk_local"
_VAL = "__rk_val"

PARTITIONS_CONF = "marketlens.ranking.partitions"
PERSIST_CONF = "marketlens.ranking.persistInput"


def _num_ranges(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    spark = df.sparkSession
    conf = spark.conf.get(PARTITIONS_CONF, None)
    if conf:
        return int(conf)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _write(df: DataFrame, kind: str) -> str:
    path = track_scratch(df.sparkSession, f"{checkpoint_root(df.sparkSession)}/{kind}-{uuid.uuid4().hex}")
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return path


def _ranged(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _num_ranges(df, num_partitions)
    # Range partitioning samples its input in one job and shuffles it in the
    # next; the input is written for the duration of this build so the upstream
    # runs once, and its shuffles are gone before the ranges are dealt out.
    keep = str(spark.conf.get(PERSIST_CONF, "true")).lower() == "true"
    kept = _write(df, "to-rank") if keep else None
    src = spark.read.parquet(kept) if keep else df
    try:
        ranged = (
            src.repartitionByRange(n, *order)
            .sortWithinPartitions(*order)
            .withColumn(_PID, F.spark_partition_id())
            .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
        )
        # Written as a Parquet table in the checkpoint folder: the counting
        # pass then reads the range id column only.
        return spark.read.parquet(_write(ranged, "ranked"))
    finally:
        if keep:
            drop_scratch(spark, kept)


def _with_offsets(ranged: DataFrame, value: str | None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias(_CNT)]
    if value is not None:
        aggs.append(F.sum(value).alias(_SUM))
    per_range = ranged.groupBy(_PID).agg(*aggs)
    # One row per range: a window over it is bounded by the range count.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    cols = [
        F.col(_PID),
        F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF),
        F.sum(_CNT).over(everything).alias(_N),
    ]
    if value is not None:
        zero = F.lit(0).cast(per_range.schema[_SUM].dataType)
        cols += [
            F.coalesce(F.sum(_SUM).over(before), zero).alias(_SOFF),
            F.sum(_SUM).over(everything).alias(_TOT),
        ]
    offsets = per_range.select(*cols)
    return ranged.join(F.broadcast(offsets), _PID)


def rank_frame(
    df: DataFrame,
    order: list[Column],
    value: str | None = None,
    row_number: str = "row_number",
    total: str | None = None,
    running_sum: str | None = None,
    total_sum: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Append the global 1-based row number in ``order`` (ties must be broken
    by the caller), optionally the row count, and for ``value`` the
    inclusive running sum (ROWS UNBOUNDED PRECEDING) and the grand total."""
    base_cols = df.columns
    ranged = _ranged(df, order, num_partitions)
    out = _with_offsets(ranged, value)
    out = out.withColumn(row_number, (F.col(_OFF) + F.col(_POS) + 1).cast("bigint"))
    extra = [row_number]
    if total:
        out = out.withColumn(total, F.col(_N).cast("bigint"))
        extra.append(total)
    if value is not None:
        if running_sum:
            local = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            out = out.withColumn(running_sum, F.col(_SOFF) + F.sum(value).over(local))
            extra.append(running_sum)
        if total_sum:
            out = out.withColumn(total_sum, F.col(_TOT))
            extra.append(total_sum)
    return out.select(*base_cols, *extra)


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number", **kw) -> DataFrame:
    return rank_frame(df, order, row_number=out, **kw)


def ntile_of(row_number: Column, total: Column, k: int) -> Column:
    """SQL NTILE(k) from the row number and row count: the first ``n mod k``
    tiles hold one extra row."""
    n = total
    q = F.floor(n / F.lit(k)).cast("bigint")
    r = (n % F.lit(k)).cast("bigint")
    big = r * (q + 1)
    first = F.floor((row_number - 1) / (q + 1)).cast("bigint") + 1
    rest = F.floor((row_number - 1 - big) / F.nullif(q, F.lit(0))).cast("bigint") + r + 1
    return F.when(row_number <= big, first).otherwise(rest)


def global_ntile(df: DataFrame, k: int, order: list[Column], out: str, **kw) -> DataFrame:
    rn, n = f"{out}__rn", f"{out}__n"
    ranked = rank_frame(df, order, row_number=rn, total=n, **kw)
    return ranked.withColumn(out, ntile_of(F.col(rn), F.col(n), k).cast("bigint")).drop(rn, n)


def global_percent_rank(
    df: DataFrame,
    key: str,
    out: str,
    ascending: bool = True,
    nulls_last: bool = True,
    tie: str | None = None,
    **kw,
) -> DataFrame:
    """PERCENT_RANK() OVER (ORDER BY key): (rank - 1) / (n - 1), 0 for n = 1.

    Ties share a rank: the rank of a row is the global row number of the
    first row of its key group.

    * With a unique ``tie`` column the rows themselves are ranked once on
      ``(key, tie)`` (written once, so the upstream runs once); the first row
      number per key is a ``min`` over one row per key and range, and is joined
      back on range and key (null-safe), so a hot key is never in one task.
    * Without one, rows are counted per distinct key (partial aggregation
      absorbs hot keys), the distinct keys are ranked with a running count,
      and the rank is joined back on the key.
    """
    kcol = F.col(key)

    def ordered(c):
        if ascending:
            return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
        return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()

    if tie is not None:
        first, pid = "__rk_first", "__rk_in"
        ranged = _with_offsets(_ranged(df, [ordered(kcol), F.col(tie).asc()], kw.get("num_partitions")), None)
        # one row a key and range, then one a key; rows meet their rank by range
        # and key, so a value that many rows share stays spread over its ranges
        local = ranged.groupBy(F.col(_PID).alias(pid), kcol.alias(_VAL)).agg(F.min(F.col(_OFF) + F.col(_POS)).alias(first))
        whole = local.groupBy(F.col(_VAL).alias("__rk_key")).agg(F.min(first).alias(first))
        spread = local.drop(first).join(whole, F.col(_VAL).eqNullSafe(F.col("__rk_key"))).drop("__rk_key")
        joined = ranged.join(spread, (F.col(_PID) == F.col(pid)) & kcol.eqNullSafe(F.col(_VAL)))
        pr = F.when(F.col(_N) <= 1, F.lit(0.0)).otherwise(F.col(first).cast("double") / (F.col(_N) - 1).cast("double"))
        return joined.select(*df.columns, pr.alias(out))

    per_key = df.groupBy(kcol.alias(_VAL)).agg(F.count(F.lit(1)).alias(_CNT))
    ranked = rank_frame(
        per_key, [ordered(F.col(_VAL))], value=_CNT, row_number=f"{_VAL}_rn", running_sum=_LOCAL, total_sum=_TOT, **kw
    )
    ranks = ranked.select(
        F.col(_VAL),
        (F.col(_LOCAL) - F.col(_CNT)).alias("__rk_below"),
        F.col(_TOT).alias("__rk_total"),
    )
    joined = df.join(ranks, kcol.eqNullSafe(F.col(_VAL)), "inner")
    pr = F.when(F.col("__rk_total") <= 1, F.lit(0.0)).otherwise(
        F.col("__rk_below").cast("double") / (F.col("__rk_total") - 1).cast("double")
    )
    return joined.withColumn(out, pr).drop(_VAL, "__rk_below", "__rk_total")
