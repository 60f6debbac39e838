"""Mart export: Parquet (default), CSV with a header line, or both.

* Each mart is written as a directory of part files by the executors in
  parallel — no ``coalesce(1)`` funnel through one task.
* The row count printed per mart comes from an ``Observation`` attached to
  the write itself, not from a second ``count()`` scan.
* With both formats, a mart's Parquet is written first and its CSV copy is produced
  from the written Parquet, so the mart is computed once and the second
  write does not depend on cached blocks that a lost executor would take
  with it.
* Beside each table lies ``<name>.<fmt>.schema.json``: its schema, rows and, for
  each column, the number of values and an order-independent checksum, gathered
  by the same ``Observation``.  ``read_export`` takes the types of a CSV from
  there and fails on bad rows; ``verify_export`` reads the table and compares.
* CSV is lossless: white space is kept, nulls and empty texts stay apart, and a
  table whose texts hold line breaks is read back as such (then unsplit).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.session import shuffles_go
from marketlens.sources.mart_store import CODEC

CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",  # the fraction is kept
    "dateFormat": "yyyy-MM-dd",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}
FORMATS = ("parquet", "csv")


def _path(out_dir: str, name: str, fmt: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}.{fmt}"


class ExportMismatch(RuntimeError):
    """A stored export does not hold what was written."""


def _figures(df: DataFrame) -> list:
    """Aggregates over a table: rows, and for column i its values (``v<i>``) and
    the sum of their 64-bit hashes (``s<i>``), whatever the rows' order."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        out += [F.count(c).alias(f"v{i}"), F.coalesce(F.sum(F.when(c.isNotNull(), F.xxhash64(c).cast("decimal(38,0)"))), F.lit(0).cast("decimal(38,0)")).alias(f"s{i}")]
    return out


def column_checksums(df: DataFrame) -> DataFrame:
    """One row a column: column_name, n_rows, n_values and the checksum."""
    columns = [F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("n_rows"), F.col(f"v{i}").alias("n_values"), F.col(f"s{i}").alias("checksum")) for i, c in enumerate(df.columns)]
    return df.agg(*_figures(df)).select(F.explode(F.array(*columns)).alias("c")).select("c.*")


def write_table(df: DataFrame, path: str, fmt: str, name: str = "table", compression: str | None = None) -> int:
    """Write a table and, beside it, its schema file; returns the rows.  Parquet
    is compressed as stored tables are, CSV not; ``compression`` names another codec."""
    if fmt not in FORMATS:
        raise ValueError(f"{fmt!r} is none of {', '.join(FORMATS)}")
    texts = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    breaks = F.coalesce(F.max(F.greatest(F.lit(False), *[F.coalesce(c.rlike("[\r\n]"), F.lit(False)) for c in texts])), F.lit(False)) if texts else F.max(F.lit(False))
    obs = Observation(f"export_{name}_{fmt}")
    observed = df.observe(obs, *_figures(df), breaks.alias("breaks"))
    options = CSV_OPTIONS if fmt == "csv" else {"compression": CODEC}
    options = options | ({"compression": compression} if compression else {})
    with shuffles_go(df.sparkSession):
        observed.write.mode("overwrite").format(fmt).options(**options).save(path)
    found = obs.get
    columns = {c: {"values": int(found[f"v{i}"]), "checksum": str(found[f"s{i}"])} for i, c in enumerate(df.columns)}
    _write_text(df.sparkSession, f"{path}.schema.json", json.dumps({
        "schema": df.schema.jsonValue(), "rows": int(found["rows"]), "columns": columns, "line_breaks": bool(found["breaks"]),
    }, indent=1))
    return int(found["rows"])


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hadoop_path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def export_marts(
    w,
    out_dir: str,
    fmt: str = "parquet",
    marts: tuple[str, ...] | None = None,
    log=print,
    csv_compression: str | None = None,
    each: Callable[[str, str], None] | None = None,
) -> dict[str, dict[str, int]]:
    """Write the marts (dimensions first) and return ``{fmt: {mart: rows}}``.
    ``each`` is called with a mart's name and format when that table is there."""
    from marketlens.plans.pipeline import MART_NAMES

    marts = MART_NAMES if marts is None else marts
    formats = list(FORMATS) if fmt == "both" else [fmt]
    counts: dict[str, dict[str, int]] = {f: {} for f in formats}
    spark = w.spark
    for name in marts:
        for f in formats:
            if f == "csv" and "parquet" in formats:
                source = spark.read.parquet(_path(out_dir, name, "parquet"))
            else:
                source = w.relation(name)
            n = write_table(source, _path(out_dir, name, f), f, name, csv_compression if f == "csv" else None)
            counts[f][name] = n
            if log:
                log(f"{_path(out_dir, name, f)}: {n} rows")
            if each:
                each(name, f)
    return counts


def drop_export(spark: SparkSession, out_dir: str, name: str, fmt: str) -> None:
    """Delete an exported table and its schema file."""
    for path in (_path(out_dir, name, fmt), f"{_path(out_dir, name, fmt)}.schema.json"):
        fs, p = _hadoop_path(spark, path)
        fs.delete(p, True)


def export_entry(spark: SparkSession, out_dir: str, name: str, fmt: str) -> dict | None:
    """What the schema file of an exported table says; None without one."""
    text = _read_text(spark, f"{_path(out_dir, name, fmt)}.schema.json")
    return None if text is None else json.loads(text)


def read_export(
    spark: SparkSession, out_dir: str, name: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """An exported table.  A CSV's types come from its schema file, or from
    ``schema``; a row that does not fit them fails the read."""
    path = _path(out_dir, name, fmt)
    if fmt == "parquet":
        return spark.read.parquet(path)
    entry = export_entry(spark, out_dir, name, fmt)
    if schema is None:
        if entry is None:
            raise ValueError("CSV carries no types, and there is no schema file: pass the mart schema")
        schema = T.StructType.fromJson(entry["schema"])
    # an unquoted empty field takes this value, and is null; a quoted one is an empty text
    options = CSV_OPTIONS | {"nullValue": "\u0000", "mode": "FAILFAST", "enforceSchema": "false", "multiLine": str(bool(entry and entry["line_breaks"])).lower()}
    return spark.read.schema(schema).options(**options).csv(path)


def verify_export(spark: SparkSession, out_dir: str, name: str, fmt: str = "parquet") -> int:
    """Read an exported table and compare it with its schema file, column by
    column; returns the rows, raises ``ExportMismatch`` where they differ."""
    entry = export_entry(spark, out_dir, name, fmt)
    if entry is None:
        raise ExportMismatch(f"{name}.{fmt} has no schema file")
    back = read_export(spark, out_dir, name, fmt)
    if back.schema.simpleString() != T.StructType.fromJson(entry["schema"]).simpleString():
        raise ExportMismatch(f"{name}.{fmt}: columns or types differ: {back.schema.simpleString()}")
    found = {r.column_name: r for r in column_checksums(back).collect()}  # a row a column
    wrong = [c for c, e in entry["columns"].items() if (found[c].n_rows, found[c].n_values, str(found[c].checksum)) != (entry["rows"], e["values"], e["checksum"])]
    if wrong:
        raise ExportMismatch(f"{name}.{fmt}: {', '.join(wrong)} differ")
    return entry["rows"]
