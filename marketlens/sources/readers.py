"""Readers for the nine raw extracts.

``read_sources`` maps each source name to a path built from a template, with
per-source overrides (the category translation lives under its own file
name).  CSV is read with the pinned schema, a header line, and multi-line
quoted fields (review texts carry newlines and doubled quotes).  Parquet is
the production layout: the same schemas, column pruning and predicate
pushdown come for free.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.schemas import SOURCE_NAMES, SOURCE_SCHEMAS

# Default layout: one file (or directory of part files) per source, named
# after the source.  Extracts that carry a prefix or suffix in their file
# names set ``template`` (e.g. "{root}/prefix_{name}_suffix.{ext}"); single
# sources stored under another name go in ``overrides``.
DEFAULT_PATH_TEMPLATE = "{root}/{name}.{ext}"
# --- fixed values: the category lookup's own file name in the raw extract ----
DEFAULT_OVERRIDES = {"product_category_translation": "{root}/product_category_name_translation.{ext}"}
# ---------------------------------------------------------------------------

# Sources whose text can hold line breaks.  The files of all others are split
# into tasks; convert this one to Parquet once where it is large.
MULTILINE_SOURCES = frozenset({"order_reviews"})


@dataclass(frozen=True)
class SourceConfig:
    root: str
    fmt: str = "csv"
    template: str = DEFAULT_PATH_TEMPLATE
    overrides: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_OVERRIDES))
    multiline: frozenset[str] = MULTILINE_SOURCES

    def path(self, name: str) -> str:
        ext = "csv" if self.fmt == "csv" else self.fmt
        tmpl = self.overrides.get(name, self.template)
        return tmpl.format(root=self.root.rstrip("/"), name=name, ext=ext)


def read_source(spark: SparkSession, name: str, cfg: SourceConfig) -> DataFrame:
    schema = SOURCE_SCHEMAS[name]
    path = cfg.path(name)
    if cfg.fmt == "csv":
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", name in cfg.multiline)  # such files can't be split
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .csv(path)
        )
    elif cfg.fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported source format: {cfg.fmt}")
    # Project to the pinned schema (order and types), never inferring.
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_sources(spark: SparkSession, cfg: SourceConfig) -> dict[str, DataFrame]:
    return {name: read_source(spark, name, cfg) for name in SOURCE_NAMES}
