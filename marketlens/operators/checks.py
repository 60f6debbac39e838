"""Data-quality checks as DataFrame jobs.

Each ``*_violations`` function returns the failing rows of one check, with
the semantics of the public generic-test definitions:

* ``unique``            — duplicated non-null values (one row per value);
* ``not_null``          — rows whose column is null;
* ``accepted_values``   — distinct values outside the list (null passes);
* ``relationships``     — child rows with a non-null key missing in the parent;
* ``unique_combination``— duplicated column combinations (one row each);
* ``accepted_range``    — rows outside ``[min, max]`` (inclusive; null passes).

``fused_report`` evaluates many checks of one relation with few passes: all
null / value / range checks in one aggregate, and all uniqueness checks in a
single shuffle (each row emits one ``(check, key)`` pair per check, then a
two-level count).  No check collects rows to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.semantics import packed_key


@dataclass(frozen=True)
class Check:
    model: str
    kind: str  # unique | not_null | accepted_values | relationships | unique_combination | accepted_range
    columns: tuple[str, ...]
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    to_model: str | None = None
    to_column: str | None = None
    severity: str = "error"
    origin: str = "declared"  # declared | added
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)

    @property
    def name(self) -> str:
        return self.kind


# -- single checks returning failing rows ------------------------------------
def unique_violations(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.where(c.isNotNull()).groupBy(c.alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records")).where(
        F.col("n_records") > 1
    )


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values_violations(df: DataFrame, column: str, values) -> DataFrame:
    c = F.col(column)
    return (
        df.groupBy(c.alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(~F.col("value_field").isin(list(values)))
    )


def relationships_violations(child: DataFrame, column: str, parent: DataFrame, to_column: str) -> DataFrame:
    keys = parent.select(F.col(to_column).alias("__to_field"))
    return (
        child.select(F.col(column).alias("from_field"))
        .where(F.col("from_field").isNotNull())
        .join(keys, F.col("from_field") == F.col("__to_field"), "left_anti")
    )


def unique_combination_violations(df: DataFrame, columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def _out_of_range(c: Column, lo, hi) -> Column:
    cond = None
    if lo is not None:
        cond = c < F.lit(lo)
    if hi is not None:
        cond = (c > F.lit(hi)) if cond is None else (cond | (c > F.lit(hi)))
    return cond


def accepted_range_violations(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    return df.where(_out_of_range(F.col(column), min_value, max_value))


# -- fused evaluation ----------------------------------------------------------
_REPORT_COLS = ("table_name", "check_name", "column_name", "severity", "violations")


def _row(check: Check, count: Column) -> Column:
    return F.struct(
        F.lit(check.model).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.column_label).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        count.cast("bigint").alias("violations"),
    )


def _scan_checks(df: DataFrame, checks: list[Check]) -> DataFrame | None:
    """not_null / accepted_values / accepted_range in one aggregate pass."""
    rows = []
    for chk in checks:
        c = F.col(chk.columns[0])
        if chk.kind == "not_null":
            rows.append(_row(chk, F.count_if(c.isNull())))
        elif chk.kind == "accepted_values":
            bad = F.when(c.isNotNull() & ~c.isin(list(chk.values)), c)
            rows.append(_row(chk, F.count_distinct(bad)))
        elif chk.kind == "accepted_range":
            rows.append(_row(chk, F.count_if(F.coalesce(_out_of_range(c, chk.min_value, chk.max_value), F.lit(False)))))
    if not rows:
        return None
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def _uniqueness_checks(df: DataFrame, checks: list[Check]) -> DataFrame | None:
    """unique / unique_combination of one relation with a single shuffle."""
    pairs = []
    for i, chk in enumerate(checks):
        key = F.array(*[packed_key(F.col(c).cast("string")) for c in chk.columns])
        if chk.kind == "unique":
            key = F.when(F.col(chk.columns[0]).isNotNull(), key)
        pairs.append(F.struct(F.lit(i).alias("cid"), key.alias("k")))
    if not pairs:
        return None
    exploded = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.cid", "p.k").where(F.col("k").isNotNull())
    dup_keys = exploded.groupBy("cid", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    per_check = dup_keys.groupBy("cid").agg(F.count(F.lit(1)).alias("violations"))
    labels = F.array(*[_row(chk, F.lit(0)) for chk in checks])
    # Attach labels by position; checks without duplicates report 0.
    expanded = df.sparkSession.range(1).select(F.posexplode(labels).alias("cid", "r"))
    return (
        expanded.join(F.broadcast(per_check), "cid", "left")
        .select(
            F.col("r.table_name"),
            F.col("r.check_name"),
            F.col("r.column_name"),
            F.col("r.severity"),
            F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"),
        )
    )


def fused_report(df: DataFrame, checks: list[Check]) -> list[DataFrame]:
    parts = []
    scan = _scan_checks(df, [c for c in checks if c.kind in ("not_null", "accepted_values", "accepted_range")])
    if scan is not None:
        parts.append(scan)
    uniq = _uniqueness_checks(df, [c for c in checks if c.kind in ("unique", "unique_combination")])
    if uniq is not None:
        parts.append(uniq)
    return parts


def relationship_report(child: DataFrame, parent: DataFrame, chk: Check) -> DataFrame:
    v = relationships_violations(child, chk.columns[0], parent, chk.to_column)
    return v.agg(_row(chk, F.count(F.lit(1))).alias("r")).select("r.*")
